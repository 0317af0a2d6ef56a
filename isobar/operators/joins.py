"""Membership, lookup and dimension upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.operators.ordered import BLOCK_ROWS, positions


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str, *, skip_nulls: bool = False) -> DataFrame:
    """SQL ``NOT IN``: a NULL among the other keys empties the result.

    Spark runs a literal NOT IN by broadcasting the whole other side.  The same
    rule is an ordinary anti join plus two scalars (are there keys, is one of
    them NULL), which shuffles both sides when neither is small.
    ``skip_nulls`` ignores NULL keys on the other side.
    """
    keys = other.select(F.col(other_column).alias("__key"))
    if skip_nulls:
        keys = keys.filter(F.col("__key").isNotNull())
    found = keys.agg(F.struct(F.count("*").alias("n"), F.count_if(F.col("__key").isNull()).alias("nulls"))).scalar()
    # A NULL compares with nothing: it stays only if there is no key at all, and never travels into one task.
    known = df.filter(F.col(column).isNotNull()).join(keys.distinct(), F.col(column) == F.col("__key"), "left_anti")
    unknown = df.filter(F.col(column).isNull() & (found["n"] == 0))
    return known.filter(found["nulls"] == 0).unionByName(unknown)


def not_existing(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet (do nothing on conflict)."""
    return df.join(existing.select(*keys).distinct(), keys, "left_anti")


def lookup(df: DataFrame, dimension: DataFrame, natural: list[str], surrogate: str) -> DataFrame:
    """Surrogate key for a natural key."""
    return df.join(dimension.select(*natural, surrogate), natural, "inner")


def with_referenced(df: DataFrame, foreign: str, other: DataFrame, primary: str) -> DataFrame:
    """Follow a foreign key; AQE splits a key that many rows refer to."""
    return df.join(other, df[foreign] == other[primary], "inner")


def upsert_keys(
    new: DataFrame,
    existing: DataFrame,
    natural: list[str],
    surrogate: str,
    *,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The dimension after inserting the unseen natural keys of ``new``.

    Surrogates continue after the highest stored one, in natural-key order.
    Stored rows are never changed.  Among new rows with the same natural key the
    smallest one (by its remaining columns) is kept.
    """
    others = [c for c in existing.columns if c not in natural and c != surrogate]
    unseen = not_existing(new.select(*natural, *others), existing, natural)
    if others:
        picked = unseen.groupBy(*natural).agg(F.min(F.struct(*others)).alias("__row"))
        unseen = picked.select(*natural, *[F.col("__row")[c].alias(c) for c in others])
    else:
        unseen = unseen.distinct()
    highest = existing.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    numbered = positions(unseen, [], natural, name="__at", block_rows=block_rows)
    kind = existing.schema[surrogate].dataType
    added = numbered.withColumn(surrogate, (highest + F.col("__at")).cast(kind))
    return existing.unionByName(added.select(*existing.columns))


def upsert_cities(
    listed: DataFrame, country: DataFrame, city: DataFrame, *, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Insert the listed (city, country, lat, lon) rows; returns (country, city)."""
    countries = upsert_keys(
        listed.select(F.col("country").alias("country_name")),
        country,
        ["country_name"],
        "country_id",
        block_rows=block_rows,
    )
    named = listed.select(
        F.col("city").alias("city_name"), F.col("country").alias("country_name"), "lon", "lat"
    )
    keyed = lookup(named, countries, ["country_name"], "country_id").drop("country_name")
    return countries, upsert_keys(keyed, city, ["city_name", "country_id"], "city_id", block_rows=block_rows)


def unprocessed(df: DataFrame, limit: Column) -> Column:
    """True for documents measured since ``limit`` (epoch seconds) and not yet processed."""
    return (F.col("dt") >= limit) & ~F.coalesce(F.col("processed"), F.lit(False))


def mark_processed(df: DataFrame, limit: Column, now: Column) -> DataFrame:
    """A new snapshot with those documents marked and stamped."""
    due = unprocessed(df, limit)
    stamp = F.col("processed_at") if "processed_at" in df.columns else F.lit(None).cast("timestamp")
    return df.withColumns(
        {"processed": due | F.coalesce(F.col("processed"), F.lit(False)), "processed_at": F.when(due, now).otherwise(stamp)}
    )
