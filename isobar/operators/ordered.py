"""Order-dependent work on series of any length.

A window partitioned by city puts one city into one task.  That is the right
plan while every series is short, and wrong once one city holds a large share
of the table.  ``arrange`` looks at the longest series first:

* at most ``block_rows`` rows: one ordinary window per series;
* otherwise the table is range-partitioned on (keys, order), which splits a hot
  series over many tasks, numbered globally, and cut into blocks of
  ``block_rows`` rows.  Windows then run per (series, block); what has to cross
  a block border travels as a halo (bounded look-back) or as one carried row
  per block (running values).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from isobar.staging import stage

BLOCK_ROWS = 1_000_000
BLOCK, HALO, SEQ = "__block", "__halo", "__seq"


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the biggest group; one partially aggregated pass over the keys."""
    if not keys:
        return df.count()
    sizes = df.groupBy(*keys).count()
    return sizes.agg(F.max("count")).first()[0] or 0


def number_rows(df: DataFrame, sort: list[str | Column]) -> DataFrame:
    """Add ``__seq``, the 0-based position in the global sort order.

    Two passes: sort within range partitions, then add per-partition offsets.
    The numbering depends on sampled range bounds, so the sorted table is
    written once and both passes read the same files.
    """
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    written = stage(ranged.withColumn("__id", F.monotonically_increasing_id()), "ranged")
    written = written.withColumn("__part", F.shiftrightunsigned("__id", 33))
    # One row per range partition, whatever the table size.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy("__part")
        .agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    local = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        written.join(F.broadcast(offsets), "__part")
        .withColumn(SEQ, F.col("__offset") + local)
        .drop("__id", "__part", "__offset")
    )


def attach(df: DataFrame, facts: DataFrame, names: list[str]) -> DataFrame:
    """Left-join per-group facts; Spark broadcasts them when they measure small."""
    renamed = facts.select(*[F.col(n).alias(f"__k_{n}") if n in names else F.col(n) for n in facts.columns])
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__k_{n}")) for n in names])
    return df.join(renamed, on, "left").drop(*[f"__k_{n}" for n in names])


@dataclass(frozen=True)
class Series:
    """A table cut into (keys, block) groups that each fit one task."""

    frame: DataFrame
    keys: list[str]
    order: list[str | Column]
    split: bool
    wider: bool = False  # blocks than the table's own, for a look back beyond them

    @property
    def groups(self) -> list[str]:
        return [*self.keys, BLOCK] if self.split else list(self.keys)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.groups).orderBy(*self.order)

    @property
    def backward(self) -> WindowSpec:
        """The window in reverse, for looking ahead.

        A frame that runs to the end of the partition is evaluated anew for
        every row; the same frame over the reversed order is a running one.
        """
        return Window.partitionBy(*self.groups).orderBy(*[F.col(c).desc() for c in self.order])

    def with_frame(self, frame: DataFrame) -> Series:
        return replace(self, frame=frame)

    def rows(self) -> DataFrame:
        """The table without halo rows and helper columns."""
        if not self.split:
            return self.frame
        return self.frame.filter(~F.col(HALO)).drop(BLOCK, HALO, SEQ)

    def around(self, before: dict[str, Column], after: dict[str, Column]) -> DataFrame | None:
        """Per block, the nearest non-null fact of the blocks before it and of those after it.

        One aggregation gives both and is written, a row per block: the plan of
        the rows is in it, and would else be in every later operator's twice.
        Returns None when every series is a single block.
        """
        if not self.split:
            return None
        facts = before | after
        own = self.frame.filter(~F.col(HALO)).groupBy(*self.groups).agg(*[c.alias(f"__own_{n}") for n, c in facts.items()])
        summary = stage(own, "blocks")

        def picked(names: dict[str, Column], near_first: Column) -> list[Column]:
            passed = Window.partitionBy(*self.keys).orderBy(near_first).rowsBetween(Window.unboundedPreceding, -1)
            return [F.last(f"__own_{n}", ignorenulls=True).over(passed).alias(n) for n in names]

        return summary.select(*self.groups, *picked(before, F.col(BLOCK)), *picked(after, F.col(BLOCK).desc()))


@dataclass(frozen=True)
class Numbered:
    """A table whose series are numbered, to be cut into blocks by any number of operators in turn.

    Where one series is too long for a task, ``frame`` reads the one sorted copy
    and has ``__seq`` and its block; operators add columns to it and neither
    sort nor write it again.  An operator that looks at no other block finds the
    partitioning of the one before.  Rows may only go by ``keep``.
    """

    frame: DataFrame
    keys: list[str]
    order: list[str | Column]
    size: int | None = None  # rows of a block where series are cut

    @classmethod
    def of(
        cls, df: DataFrame, keys: list[str], order: list[str | Column], *, block_rows: int = BLOCK_ROWS, longest: int | None = None
    ):
        """``order`` should end in a unique column; ``longest`` bounds the rows of a series where that is known."""
        if (largest_group(df, keys) if longest is None else longest) <= block_rows:
            return cls(df, keys, order)
        size = max(block_rows, 1)
        numbered = number_rows(df, [*keys, *order])
        return cls(numbered.withColumn(BLOCK, F.floor(F.col(SEQ) / size)), keys, [SEQ], size)

    @property
    def split(self) -> bool:
        return self.size is not None

    def with_frame(self, frame: DataFrame):
        return replace(self, frame=frame)

    def rows(self) -> DataFrame:
        return self.frame.drop(BLOCK, SEQ) if self.split else self.frame

    def cut(self, look_back: int = 0) -> Series:
        """Blocks that also see the ``look_back`` rows before them, flagged as halo."""
        if not self.split:
            return Series(self.frame, self.keys, self.order, False)
        frame = self.frame
        if look_back:
            size = max(self.size, look_back)
            block = F.floor(F.col(SEQ) / size)
            near_end = F.col(SEQ) % size >= size - look_back
            seen = F.explode(F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block)))
            frame = frame.withColumn(BLOCK, seen).withColumn(HALO, F.col(BLOCK) != block)
        else:
            frame = frame.withColumn(HALO, F.lit(False))
        return Series(frame, self.keys, self.order, True, look_back > self.size)

    def joined(self, series: Series):
        """The blocks of ``cut``, with the columns added to them, as one table again."""
        if not self.split:
            return self.with_frame(series.frame)
        frame = series.frame.filter(~F.col(HALO)).drop(HALO)
        return self.with_frame(frame.withColumn(BLOCK, F.floor(F.col(SEQ) / self.size)) if series.wider else frame)

    def keep(self, condition: Column | str):
        """The rows that meet ``condition``, numbered anew by block counts instead of a sort."""
        kept = self.frame.filter(condition)
        if not self.split:
            return self.with_frame(kept)
        counts = stage(kept.groupBy(BLOCK).agg(F.count("*").alias("__n")), "blocks")
        before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
        starts = counts.select(BLOCK, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
        place = F.row_number().over(Window.partitionBy(BLOCK).orderBy(SEQ)) - 1
        frame = kept.withColumn("__place", place).join(starts, BLOCK).withColumn(SEQ, F.col("__start") + F.col("__place"))
        return self.with_frame(frame.drop("__place", "__start").withColumn(BLOCK, F.floor(F.col(SEQ) / self.size)))

    def positions(self, name: str = "position", total: str | None = None):
        """With the 1-based position in each series and, if asked, the series length."""
        frame = self.frame
        if not self.split:
            out = frame.withColumn(name, F.row_number().over(self.cut().window).cast("long"))
            if total:
                out = out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*self.keys)))
            return self.with_frame(out)
        if not self.keys:
            out = frame.withColumn(name, F.col(SEQ) + 1)
            if total:
                out = out.withColumn(total, frame.agg(F.max(SEQ) + 1).scalar())  # of the numbered copy
            return self.with_frame(out)
        facts = [F.min(SEQ).alias("__first")]
        if total:
            facts.append(F.count("*").alias(total))
        starts = stage(frame.groupBy(*self.keys).agg(*facts), "starts")
        out = attach(frame, starts, self.keys).withColumn(name, F.col(SEQ) - F.col("__first") + 1)
        return self.with_frame(out.drop("__first"))


def arrange(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    *,
    look_back: int = 0,
    block_rows: int = BLOCK_ROWS,
    longest: int | None = None,
) -> Series:
    """Prepare ``df`` for windows over ``keys`` ordered by ``order``.

    With ``look_back`` = L each block also sees the L rows before it, flagged as
    halo.  ``order`` should end in a unique column: rows tied on all of it
    cannot be separated by the range partitioning, nor ordered repeatably.
    Pass ``longest``, a bound of the longest series' rows, where one is known:
    operators in a chain then count once, not once each.
    """
    return Numbered.of(df, keys, order, block_rows=block_rows, longest=longest).cut(look_back)


def positions(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    *,
    name: str = "position",
    total: str | None = None,
    block_rows: int = BLOCK_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Add the 1-based position in each series and, if asked, the series length."""
    return Numbered.of(df, keys, order, block_rows=block_rows, longest=longest).positions(name, total).rows()


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    sums: dict[str, Column],
    *,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add inclusive running sums ``{name: column}`` along each series."""
    series = arrange(df, keys, order, block_rows=block_rows)
    upto = series.window.rowsBetween(Window.unboundedPreceding, 0)
    if not series.split:
        return df.withColumns({n: F.sum(c).over(upto) for n, c in sums.items()})
    totals = series.frame.groupBy(*series.groups).agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *series.groups,
        *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__c_{n}") for n in sums],
    )
    out = series.frame.withColumns({n: F.sum(c).over(upto) for n, c in sums.items()})
    out = attach(out, carried, series.groups)
    out = out.withColumns({n: F.col(n) + F.col(f"__c_{n}") for n in sums})
    return out.drop(BLOCK, HALO, SEQ, *[f"__c_{n}" for n in sums])
