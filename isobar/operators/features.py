"""The feature table built from cleaned observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.calendar import day_of_week, season, to_time
from isobar.functions.weather import dew_point, rain_flag
from isobar.operators.ordered import BLOCK_ROWS
from isobar.operators.series import tendency


def calendar_features(df: DataFrame, time: str = "date") -> DataFrame:
    """Hour (kept if present), weekday, month and season; bad times give NULL."""
    moment = to_time(F.col(time))
    added = {"day_of_week": day_of_week(moment), "month": F.month(moment), "season": season(F.month(moment))}
    if "hour" not in df.columns:
        added["hour"] = F.hour(moment)
    return df.withColumns(added)


def interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "temp_humidity_interaction": F.col("temperature") * F.col("humidity"),
            "wind_pressure_interaction": F.col("wind_speed") * F.col("pressure"),
        }
    )


def observed_at(df: DataFrame) -> DataFrame:
    """One sortable time from the stored date and hour."""
    moment = F.make_dt_interval(F.lit(0), F.col("hour")) + to_time(F.col("date"))
    return df.withColumn("observed_at", moment)


def engineer(
    df: DataFrame,
    *,
    partition_by: list[str] = ("city_id",),
    time: str = "date",
    order: list[str | Column] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every derived feature and the rain target.

    The pressure tendency stays within a city; ``partition_by=[]`` takes the
    difference along the whole table instead.  Without an ``order`` rows come
    by time and hour; rows that agree in both (a batch appended twice) by a
    hash of the whole row, so the result does not depend on where they lie.
    """
    keys = [c for c in partition_by if c in df.columns]
    if order is None:
        hashable = [F.to_json(F.col(c)) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in df.columns]
        order = [time] + [c for c in ("hour",) if c in df.columns] + [F.xxhash64(*hashable)]
    out = tendency(df, "pressure", keys, order, name="pressure_tendency", block_rows=block_rows)
    out = interactions(calendar_features(out, time))
    return out.withColumns(
        {
            "dew_point": dew_point(F.col("temperature"), F.col("humidity")),
            "rain_flag": rain_flag(F.col("precipitation")),
        }
    )
