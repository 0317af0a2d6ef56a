"""Rows at given places of a table's order, without sorting the table.

Counts over a grid of the order's values say which cells hold a wanted place.
Only the rows of those cells are looked at again, on a finer grid of each cell's
own, until few enough are left to be sorted.  No step shuffles rows but
the last; the tables of cells are bounded by the grid and the number of places.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.operators.ordered import BLOCK_ROWS, positions
from isobar.staging import discard, stage

#: Cells of the first grid, and of the grid inside each later cell.
FIRST, FINER = 1 << 16, 64
#: Wanted places up to which the cells of all of them are one small table.
PLACES = 100_000


def as_number(df: DataFrame, column: str) -> Column | None:
    """A long in the order of ``column``, distinct for distinct values; None for types without one."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return value.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):  # by its fields: a cast would go through the session's time zone
        minutes = (F.unix_date(F.to_date(value)).cast("long") * 24 + F.hour(value)) * 60 + F.minute(value)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
    return None


def _cell(value: Column, low: Column, high: Column, cells: int) -> Column:
    """Ascending in ``value``; -1 for NULL.  The ends of a range never share a cell."""

    def distance(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_subtract(a, b).cast("double"), a.cast("double") - b.cast("double"))

    share = distance(value, low) / F.nullif(distance(high, low), F.lit(0.0))
    inside = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * cells), F.lit(cells - 1))
    return F.when(value.isNull(), F.lit(-1)).otherwise(inside).cast("long")


def _facts(levels: list[Column]) -> list[Column]:
    out = [F.count(F.lit(1)).alias("__rows")]
    for k, v in enumerate(levels):
        out += [F.min(v).alias(f"__min{k}"), F.max(v).alias(f"__max{k}"), F.count(v).alias(f"__known{k}")]
    return out


def _described(depth: int) -> list[Column]:
    """The first level that tells a cell's rows apart (``depth`` if none does) and its range."""
    varied = [
        (F.col(f"__min{k}") < F.col(f"__max{k}")) | ((F.col(f"__known{k}") > 0) & (F.col(f"__known{k}") < F.col("__rows")))
        for k in range(depth)
    ]

    def of_level(values: list[Column]) -> Column:
        return F.coalesce(*[F.when(varied[k], values[k]) for k in range(depth)])

    return [
        F.coalesce(of_level([F.lit(k) for k in range(depth)]), F.lit(depth)).alias("__level"),
        of_level([F.col(f"__min{k}") for k in range(depth)]).alias("__low"),
        of_level([F.col(f"__max{k}") for k in range(depth)]).alias("__high"),
    ]


def _met(rows: DataFrame, state: DataFrame, levels: list[Column], cells: int) -> DataFrame:
    """Rows of the cells in ``state``, each with its cell on the grid inside."""
    small = F.broadcast(state.drop("__rows"))  # at most a row per wanted place, of which there are PLACES
    met = rows.join(small, ["__start", "__cell"]).drop("__start", "__cell").withColumnRenamed("__new", "__start")
    value = reduce(lambda rest, k: F.when(F.col("__level") == k, levels[k]).otherwise(rest), range(len(levels)), F.lit(None).cast("long"))
    cell = F.when(F.col("__level") < len(levels), _cell(value, F.col("__low"), F.col("__high"), cells)).otherwise(F.lit(0).cast("long"))
    return met.withColumn("__cell", cell).drop("__level", "__low", "__high")


def every(
    df: DataFrame,
    order: list[str],
    step: int,
    *,
    total: int | None = None,
    exact_rows: int = BLOCK_ROWS,
    first: int = FIRST,
    finer: int = FINER,
) -> DataFrame:
    """The rows at places 0, ``step``, 2 ``step``, ... of the order by ``order`` (NULL first).

    ``df`` is read once per round, mostly two or three times.  Tables of at most
    ``exact_rows`` rows, more than ``PLACES`` places, orders by text or
    fractions, and more than ``exact_rows`` rows of one order value go
    by numbered positions, with the same result.
    """
    total = df.count() if total is None else total
    levels = [as_number(df, c) if isinstance(c, str) else None for c in order]
    if total <= exact_rows or total > step * PLACES or not levels or any(v is None for v in levels):
        return _by_position(df, order, step, exact_rows, total)
    depth, names = len(levels), df.columns
    # A cell is named by the first place in it; a state's row says which cell of which earlier cell it is.
    root = {"__start": F.lit(0).cast("long"), "__cell": F.lit(0).cast("long")}
    whole = df.agg(*_facts(levels)).withColumns(root | {"__new": root["__start"]})
    states = [stage(whole.select(*root, "__new", "__rows", *_described(depth)), "cells")]
    rows = _met(df.withColumns(root), states[0], levels, first)
    while True:
        upto = Window.partitionBy("__start").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
        counted = rows.groupBy("__start", "__cell").agg(*_facts(levels))
        before = F.coalesce(F.sum("__rows").over(upto), F.lit(0))
        found = counted.withColumn("__new", F.col("__start") + before)
        wanted = F.ceil(F.col("__new") / step) * step < F.col("__new") + F.col("__rows")
        found = found.filter(wanted).select("__start", "__cell", "__new", "__rows", *_described(depth))
        states.append(stage(found, "cells"))
        left, tied = states[-1].agg(
            F.sum(F.when(F.col("__level") < depth, F.col("__rows"))), F.max(F.when(F.col("__level") == depth, F.col("__rows")))
        ).first()
        if (tied or 0) > exact_rows:
            for s in states:
                discard(s)
            return _by_position(df, order, step, exact_rows, total)
        rows = _met(rows, states[-1], levels, finer)
        if (left or 0) <= exact_rows:
            break
    place = F.col("__start") + F.row_number().over(Window.partitionBy("__start").orderBy(*order)) - 1
    return rows.withColumn("__place", place).filter(F.col("__place") % step == 0).select(*names)


def _by_position(df: DataFrame, order: list[str | Column], step: int, block_rows: int, total: int) -> DataFrame:
    numbered = positions(df, [], order, name="__at", block_rows=block_rows, longest=total)
    return numbered.filter((F.col("__at") - 1) % step == 0).drop("__at")
