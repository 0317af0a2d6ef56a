"""Repeatable train/test and fold assignment.

Membership is a function of a row's key and the seed, so it survives retries,
repartitioning and re-reads, which a random draw does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.operators.ordered import BLOCK_ROWS, positions

SEED = 42


def shuffled(key: str | list[str], seed: int = SEED) -> Column:
    names = [key] if isinstance(key, str) else key
    return F.xxhash64(*[F.col(c) for c in names], F.lit(seed))


def portable_share(key: str) -> Column:
    """A share in [0, 1) from an integer key by multiplication, the same in every SQL engine."""
    return (F.col(key) % 2147483648) * F.lit(2654435761) % F.lit(4294967296) / F.lit(4294967296.0)


def plain_split(
    df: DataFrame,
    key: str | list[str],
    *,
    test_percent: int = 20,
    share: Column | None = None,
    seed: int = SEED,
    name: str = "is_test",
) -> DataFrame:
    """About ``test_percent`` of the rows are test rows; no shuffle.

    ``share`` draws them (a number in [0, 1) per row; default: from a hash of the key).
    """
    drawn = F.pmod(shuffled(key, seed), F.lit(100)) if share is None else F.floor(share * 100)
    return df.withColumn(name, drawn < test_percent)


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    *,
    test_size: float = 0.2,
    draw: Column | None = None,
    seed: int = SEED,
    name: str = "is_test",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exactly ``floor(test_size * n)`` test rows of every class.

    Rows are drawn in the order of ``draw`` (default: a hash of the key).  A
    class can be most of the table, so the ranking goes through ``positions``.
    """
    drawn = df.withColumn("__draw", shuffled(key, seed) if draw is None else draw)
    ranked = positions(
        drawn, [label], ["__draw", key], name="__at", total="__n", block_rows=block_rows
    )
    cut = F.floor(F.lit(test_size) * F.col("__n"))
    return ranked.withColumn(name, F.col("__at") <= cut).drop("__draw", "__at", "__n")


def with_folds(
    df: DataFrame, key: str | list[str], *, folds: int = 5, share: Column | None = None, seed: int = SEED, name: str = "fold"
) -> DataFrame:
    """Assign each row to one of ``folds`` folds, drawn as in ``plain_split``; no shuffle."""
    drawn = F.pmod(shuffled(key, seed), F.lit(folds)) if share is None else F.floor(share * folds)
    return df.withColumn(name, drawn.cast("int"))


def with_stratified_folds(
    df: DataFrame,
    label: str,
    key: str,
    *,
    folds: int = 5,
    seed: int = SEED,
    name: str = "fold",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Folds whose class counts differ by at most one row."""
    drawn = df.withColumn("__draw", shuffled(key, seed))
    ranked = positions(drawn, [label], ["__draw", key], name="__at", block_rows=block_rows)
    return ranked.withColumn(name, F.pmod(F.col("__at") - 1, F.lit(folds)).cast("int")).drop("__draw", "__at")
