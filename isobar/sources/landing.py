"""Stamps and counters for newly landed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.calendar import iso_format
from isobar.schema import CORRUPT


def stamp(df: DataFrame, city: DataFrame, on: list[str], now: Column | None = None) -> DataFrame:
    """Add fetch time, an unset processed flag and the nested city of each document.

    ``city`` has ``city, country, lat, lon`` and the columns to join on.
    """
    info = city.select(*[F.col(c).alias(f"__{c}") for c in on], F.struct("city", "country", "lat", "lon").alias("city_info"))
    joined = df.drop("city_info").join(info, [df[c] == info[f"__{c}"] for c in on], "left").drop(*[f"__{c}" for c in on])
    return joined.withColumns(
        {"fetch_timestamp": iso_format(F.current_timestamp() if now is None else now), "processed": F.lit(False)}
    )


def landing_counts(landed: DataFrame, saved: Column, *, corrupt: str = CORRUPT) -> DataFrame:
    """Documents asked for, readable, unreadable, saved and not saved."""
    read = F.col(corrupt).isNull()
    return landed.agg(
        F.count("*").alias("total_cities"),
        F.count_if(read).alias("successful_fetches"),
        F.count_if(~read).alias("failed_fetches"),
        F.count_if(read & saved).alias("successful_saves"),
        F.count_if(read & ~saved).alias("failed_saves"),
    )
