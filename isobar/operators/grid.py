"""Series on a regular grid of times.

Lags and seasons count rows, so they mean hours only if no hour is missing.
Every series gets a spine of times from its first to its last step, made in
chunks that are dealt over tasks, and its rows are joined to it by (keys,
time): a long series meets its spine in many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.operators.ordered import BLOCK_ROWS
from isobar.operators.series import interpolate

#: Steps a spine chunk holds.
CHUNK = 10_000
UNITS = ("minute", "hour", "day")


def spine(df: DataFrame, keys: list[str], time: str, *, unit: str = "hour", chunk: int = CHUNK) -> DataFrame:
    """``(keys, time)`` for every step between the first and the last one of each series."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}, not {unit!r}")
    ends = df.groupBy(*keys).agg(F.min(F.date_trunc(unit, time)).alias("__first"), F.max(F.date_trunc(unit, time)).alias("__last"))
    kind = df.schema[time].dataType
    starts = F.sequence(F.col("__first"), F.col("__last"), F.expr(f"interval {chunk} {unit}"))
    chunks = ends.filter("__first is not null").select(*keys, "__last", F.explode(starts).alias("__start")).repartition(*keys, "__start")
    stop = F.least(F.col("__last"), F.col("__start") + F.expr(f"interval {chunk - 1} {unit}"))
    steps = F.explode(F.sequence(F.col("__start"), stop, F.expr(f"interval 1 {unit}")))
    return chunks.select(*keys, steps.alias(time)).withColumn(time, F.col(time).cast(kind))


def regular(df: DataFrame, keys: list[str], time: str, *, unit: str = "hour", chunk: int = CHUNK) -> DataFrame:
    """``df`` with its times cut to whole steps, and for each step without a row one that holds keys and time alone.

    A series begins with its first and ends with its last row; rows of one step
    all stay.  Rows without a time belong to no step and are left out.  NULL
    is a key like any other.
    """
    rows = df.withColumn(time, F.date_trunc(unit, time).cast(df.schema[time].dataType)).filter(F.col(time).isNotNull())
    names = [*keys, time]
    steps = spine(df, keys, time, unit=unit, chunk=chunk).select(*[F.col(n).alias(f"__s_{n}") for n in names])
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__s_{n}")) for n in names])
    joined = steps.join(rows, same, "left")
    return joined.select(*[F.col(f"__s_{c}").alias(c) if c in names else F.col(c) for c in df.columns])


def without_holes(
    df: DataFrame, keys: list[str], time: str, columns: list[str], *, unit: str = "hour", chunk: int = CHUNK, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``regular``, with straight lines through the holes of ``columns``; other columns stay missing there."""
    return interpolate(regular(df, keys, time, unit=unit, chunk=chunk), keys, [time], columns, block_rows=block_rows)
