"""Hourly sums that can be merged: any split of the readings into parts gives the same means.

A cell's hour keeps a sum and a count per measure, its readings and the latest
one.  Sums are decimals with ten digits after the point, so the order of adding
does not matter, not even in the last digit; a value that is no such decimal
counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The flat readings' columns that are averaged, and the decimal their values are summed as.
AVERAGED = ("temperature", "humidity", "precipitation", "wind_speed", "clouds", "pressure", "feels_like")
EXACT = "decimal(28,10)"
CELL = ["lon", "lat", "hour"]

SUMS_SCHEMA = ", ".join(
    ["lon double", "lat double", "hour long", *[f"sum_{m} decimal(38,10), n_{m} long" for m in AVERAGED], "readings long, latest long"]
)


def cell_sums(flat: DataFrame, *more: Column) -> DataFrame:
    """Sums of flat readings by cell of 0.01 degrees and hour (counted from the epoch), and by ``more``; combined before the shuffle."""
    cell = [F.round("lon", 2).alias("lon"), F.round("lat", 2).alias("lat"), F.floor(F.col("dt") / 3600).alias("hour")]
    facts = [f(F.col(m).try_cast(EXACT)).alias(n) for m in AVERAGED for f, n in ((F.sum, f"sum_{m}"), (F.count, f"n_{m}"))]
    return flat.groupBy(*cell, *more).agg(*facts, F.count(F.lit(1)).alias("readings"), F.max("dt").cast("long").alias("latest"))


def merged_sums(parts: DataFrame, *more: str) -> DataFrame:
    """Parts of the same cell and hour added up."""
    facts = [F.sum(n).cast(parts.schema[n].dataType).alias(n) for m in AVERAGED for n in (f"sum_{m}", f"n_{m}")]
    return parts.groupBy(*CELL, *more).agg(*facts, F.sum("readings").alias("readings"), F.max("latest").alias("latest"))


def means_of(sums: DataFrame, *, digits: int = 2) -> DataFrame:
    """The rounded means as ``coordinate_means`` with hourly buckets has them."""
    means = [F.round(F.col(f"sum_{m}").cast("double") / F.col(f"n_{m}"), digits) for m in AVERAGED]
    return sums.select(
        "lon",
        "lat",
        F.timestamp_seconds(F.col("hour") * 3600).alias("period"),
        *[F.when(F.col(f"n_{m}") > 0, v).alias(f"avg_{m}") for m, v in zip(AVERAGED, means)],
        F.col("readings").alias("measurement_count"),
        F.col("latest").alias("latest_measurement"),
    )
