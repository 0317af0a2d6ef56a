"""Hourly station means from raw documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.weather import missing, zero_if_missing


def recent_documents(df: DataFrame, now: Column, *, hours_back: int = 1) -> DataFrame:
    """Documents measured at or after ``now`` minus ``hours_back``."""
    limit = F.unix_micros(now) / F.lit(1_000_000.0) - F.lit(hours_back * 3600)
    return df.filter(F.col("dt") >= limit)


def flatten(df: DataFrame, *kept: str) -> DataFrame:
    """The readings inside a document as flat columns, after the ``kept`` ones.

    A dry document has no rain object; its rain is 0, while any other missing
    field stays missing.
    """
    return df.select(
        *kept,
        F.col("coord.lon").alias("lon"),
        F.col("coord.lat").alias("lat"),
        "dt",
        missing(F.col("main.temp")).alias("temperature"),
        missing(F.col("main.humidity")).alias("humidity"),
        zero_if_missing(missing(F.col("rain.`1h`"))).alias("precipitation"),
        missing(F.col("wind.speed")).alias("wind_speed"),
        missing(F.col("clouds.all")).alias("clouds"),
        missing(F.col("main.pressure")).alias("pressure"),
        missing(F.col("main.feels_like")).alias("feels_like"),
    )


def coordinate_means(
    df: DataFrame, *, bucket: str | None = None, time: str = "observed_at", digits: int = 2
) -> DataFrame:
    """Rounded means per coordinate cell of 0.01 degrees.

    ``bucket=None`` takes the whole batch as one period; ``"1 hour"`` keeps the
    hours apart (``time`` defaults to the document's own ``dt``).  Sums and
    counts are combined before the shuffle, so a busy station costs one row per
    task.
    """
    keys = [F.round("lon", 2).alias("lon"), F.round("lat", 2).alias("lat")]
    if bucket:
        moment = F.col(time) if time in df.columns else F.timestamp_seconds("dt")
        keys.append(F.window(moment, bucket).alias("period"))
    measures = ["temperature", "humidity", "precipitation", "wind_speed", "clouds", "pressure", "feels_like"]
    means = [F.round(F.avg(m), digits).alias(f"avg_{m}") for m in measures if m in df.columns]
    out = df.groupBy(*keys).agg(
        *means, F.count("*").alias("measurement_count"), F.max("dt").alias("latest_measurement")
    )
    return out.withColumn("period", F.col("period.start")) if bucket else out


def with_city(means: DataFrame, city: DataFrame, country: DataFrame | None = None) -> DataFrame:
    """Attach every city whose rounded coordinates fall in the same cell.

    Means are already one row per cell, so the join has no hot key; Spark
    broadcasts the city table while its measured size allows it.
    """
    if country is not None:
        city = city.join(country.withColumnRenamed("country_name", "country"), "country_id", "left")
    cells = city.withColumns({"lon": F.round("lon", 2), "lat": F.round("lat", 2)})
    return means.join(cells, ["lon", "lat"])


def previous_hour(now: Column) -> Column:
    return F.date_trunc("hour", now) - F.expr("interval 1 hour")


def hourly_fact(joined: DataFrame, now: Column | None = None) -> DataFrame:
    """Project to the stored hourly table.

    With ``now`` every row is stamped with the hour before it; otherwise the
    row's own ``period`` gives date and hour.
    """
    moment = previous_hour(now) if now is not None else F.col("period")
    return joined.select(
        F.col("city_id").alias("idCity"),
        F.to_date(moment).alias("Date"),
        F.hour(moment).alias("Hour"),
        F.col("avg_temperature").alias("Temp"),
        F.col("avg_feels_like").alias("FeelsLike"),
        F.col("avg_clouds").alias("Clouds"),
        F.col("avg_precipitation").alias("Rain"),
        F.col("avg_wind_speed").alias("Wind"),
        F.col("avg_pressure").alias("Pressure"),
        F.col("avg_humidity").alias("Humidity"),
        "measurement_count",
        F.current_timestamp().alias("created_at"),
    )
