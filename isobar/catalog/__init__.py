"""Named queries over the benchmark tables, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables below one folder, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Sensor readings: event type as city, user as station, event as reading.
    @property
    def readings(self) -> DataFrame:
        value = F.col("value")
        return self.events.select(
            "event_id",
            "ts",
            "user_id",
            F.col("event_type").alias("city"),
            value.alias("temperature"),
            F.get_json_object("props", "$.k").cast("double").alias("humidity"),
            (F.lit(1000) + F.col("event_id") % 30).cast("double").alias("pressure"),
            (F.col("user_id") % 40).cast("double").alias("wind_speed"),
            F.when(value > 100, value - 100).otherwise(0.0).alias("precipitation"),
        )

    @property
    def gappy(self) -> DataFrame:
        """Readings with missing values at fixed places."""
        return self.readings.withColumns(
            {
                "temperature": F.when(F.col("event_id") % 7 != 0, F.col("temperature")),
                "humidity": F.when(F.col("event_id") % 5 != 1, F.col("humidity")),
                "pressure": F.when(F.col("event_id") % 9 != 2, F.col("pressure")),
                "label": F.when(F.col("event_id") % 4 != 3, F.col("city")),
            }
        )

    @property
    def documents_nested(self) -> DataFrame:
        """Readings as the nested documents of the collector."""
        r = self.readings
        return r.select(
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
            F.struct(
                (F.col("user_id") + (F.col("event_id") % 4) * 0.001).alias("lon"),
                (F.col("user_id") % 90 + (F.col("event_id") % 3) * 0.001).alias("lat"),
            ).alias("coord"),
            F.struct(
                F.col("temperature").alias("temp"),
                (F.col("temperature") + 1).alias("feels_like"),
                "humidity",
                "pressure",
            ).alias("main"),
            F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
            F.struct(F.col("humidity").alias("all")).alias("clouds"),
            # Dry readings have no rain object.
            F.when(F.col("precipitation") > 0, F.struct(F.col("precipitation").alias("1h"))).alias("rain"),
            (F.col("event_id") % 3 == 0).alias("processed"),
            "event_id",
        )

    @property
    def cities(self) -> DataFrame:
        """Two customers per coordinate cell as cities."""
        cell = F.floor(F.col("c_custkey") / 2)
        return self.customer.select(
            F.col("c_custkey").alias("city_id"),
            F.col("c_name").alias("city_name"),
            F.col("c_nationkey").cast("long").alias("country_id"),
            (cell + 0.003).alias("lon"),
            (cell % 90 + 0.002).alias("lat"),
        )

    @property
    def countries(self) -> DataFrame:
        return self.nation.select(
            F.col("n_nationkey").cast("long").alias("country_id"), F.col("n_name").alias("country_name")
        )

    @property
    def hourly(self) -> DataFrame:
        """One row per city and hour, every column exact whatever the summing order."""
        mean = F.sum(F.col("temperature").cast("decimal(18,2)")).cast("double") / F.count("*")
        return self.readings.groupBy("city", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("observed_at")).agg(
            mean.alias("temperature"),
            F.avg("humidity").alias("humidity"),
            F.count("*").cast("double").alias("pressure"),
            F.min("temperature").alias("wind_speed"),
            F.max("precipitation").alias("precipitation"),
        )


# The same tables as SQL, to be put after WITH.
READINGS = """
r AS (
  SELECT event_id, ts, user_id, event_type AS city, value AS temperature,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS humidity,
         CAST(1000 + event_id % 30 AS DOUBLE) AS pressure,
         CAST(user_id % 40 AS DOUBLE) AS wind_speed,
         CASE WHEN value > 100 THEN value - 100 ELSE 0 END AS precipitation
  FROM events)"""

GAPPY = (
    READINGS
    + """,
g AS (
  SELECT event_id, ts, user_id, city,
         CASE WHEN event_id % 7 <> 0 THEN temperature END AS temperature,
         CASE WHEN event_id % 5 <> 1 THEN humidity END AS humidity,
         CASE WHEN event_id % 9 <> 2 THEN pressure END AS pressure,
         wind_speed, precipitation,
         CASE WHEN event_id % 4 <> 3 THEN city END AS label
  FROM r)"""
)

DOCUMENTS = (
    READINGS
    + """,
d AS (
  SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS dt, ts,
         round(user_id + (event_id % 4) * 0.001, 2) AS lon,
         round(user_id % 90 + (event_id % 3) * 0.001, 2) AS lat,
         temperature, temperature + 1 AS feels_like, humidity, pressure, wind_speed, humidity AS clouds,
         CASE WHEN precipitation > 0 THEN precipitation ELSE 0 END AS precipitation,
         event_id % 3 = 0 AS processed
  FROM r)"""
)

CITIES = """
cities AS (
  SELECT c_custkey AS city_id, c_name AS city_name, CAST(c_nationkey AS BIGINT) AS country_id,
         c_custkey // 2 + 0.003 AS lon, (c_custkey // 2) % 90 + 0.002 AS lat
  FROM customer)"""

HOURLY = (
    READINGS
    + """,
h AS (
  SELECT city, date_trunc('hour', ts) AS observed_at,
         CAST(sum(CAST(temperature AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS temperature,
         avg(humidity) AS humidity, CAST(count(*) AS DOUBLE) AS pressure,
         min(temperature) AS wind_speed, max(precipitation) AS precipitation
  FROM r GROUP BY 1, 2)"""
)


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of ``Tables`` under ``name``, with its SQL if it has any."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return build

    return register
