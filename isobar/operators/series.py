"""Lags, moving means, fills, splits, samples and resampling along a series.

All of these order rows by ``order`` within ``keys`` and hold for series of any
length (see ``ordered``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.weather import missing, rain_flag
from isobar.operators.ordered import BLOCK, BLOCK_ROWS, SEQ, Numbered, Series, attach
from isobar.operators.ranks import every

MOVING = (3, 6)


def lag_columns(columns: list[str], lags: int) -> list[str]:
    """Names of the lagged features of ``columns``, in model order."""
    return [
        name
        for c in columns
        for name in [*[f"{c}_lag_{i}" for i in range(1, lags + 1)], *[f"{c}_ma_{w}" for w in MOVING]]
    ]


def lag_expressions(series: Series, columns: list[str], lags: int) -> dict[str, Column]:
    return {f"{c}_lag_{i}": F.lag(c, i).over(series.window) for c in columns for i in range(1, lags + 1)}


def moving_expressions(series: Series, columns: list[str]) -> dict[str, Column]:
    """Means of the previous 3 and 6 rows, NULL unless every one of them has a value."""
    out = {}
    for c in columns:
        for w in MOVING:
            before = series.window.rowsBetween(-w, -1)
            out[f"{c}_ma_{w}"] = F.when(F.count(c).over(before) == w, F.avg(c).over(before))
    return out


def _known(column: str, *what: str | Column) -> Column:
    return F.when(F.col(column).isNotNull(), F.struct(*what))


def _nearest(series: Series, fact: Column, *, ahead: bool) -> Column:
    along = series.backward if ahead else series.window
    return F.last(fact, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))


class Chain(Numbered):
    """Series operators one after the other on one numbered table.

    ``Chain.of(df, keys, order).fill_gaps(["pressure"]).lagged(["pressure"], lags=3).rows()`` counts, sorts
    and writes the table once at most, whatever the number of operators; an
    operator that carries values over block borders writes a row per block.
    The functions of the same names are chains of one.
    """

    def with_columns(self, columns: dict[str, Column]) -> Chain:
        """Columns of a row's own values."""
        return self.with_frame(self.frame.withColumns(columns))

    def lagged(self, columns: list[str], *, lags: int = 1, moving: bool = True) -> Chain:
        columns = [c for c in columns if c in self.frame.columns]
        series = self.cut(max(lags, max(MOVING) if moving else 0))
        added = lag_expressions(series, columns, lags)
        if moving:
            added |= moving_expressions(series, columns)
        return self.joined(series.with_frame(series.frame.withColumns(added)))

    def tendency(self, column: str, *, name: str | None = None) -> Chain:
        series = self.cut(1)
        change = F.coalesce(F.col(column) - F.lag(column).over(series.window), F.lit(0.0))
        return self.joined(series.with_frame(series.frame.withColumn(name or f"{column}_tendency", change)))

    def complete_rows(self, columns: list[str] | None = None) -> Chain:
        named = [c for c in self.frame.columns if c not in (BLOCK, SEQ)] if columns is None else columns
        whole = [missing(F.col(c)).isNotNull() if self.frame.schema[c].dataType.typeName() in ("float", "double") else F.col(c).isNotNull() for c in named]
        return self.keep(reduce(lambda a, b: a & b, whole, F.lit(True)))

    def fill_gaps(self, columns: list[str]) -> Chain:
        series = self.cut()
        before = {f"__b_{c}": _nearest(series, F.col(c), ahead=False) for c in columns}
        after = {f"__a_{c}": _nearest(series, F.col(c), ahead=True) for c in columns}
        frame = series.frame.withColumns(before | after)
        places = {c: F.when(F.col(c).isNotNull(), F.col(SEQ)) for c in columns}
        carried = series.around(
            {f"__cb_{c}": F.max_by(c, places[c]) for c in columns}, {f"__ca_{c}": F.min_by(c, places[c]) for c in columns}
        )
        if carried is not None:
            frame = attach(frame, carried, series.groups)
        tags = ("b", "cb", "a", "ca") if series.split else ("b", "a")
        filled = {c: F.coalesce(*[F.col(f"__{tag}_{c}") for tag in tags]) for c in columns}
        frame = frame.withColumns(filled).drop(*[f"__{tag}_{c}" for c in columns for tag in tags])
        return self.joined(series.with_frame(frame))

    def interpolate(self, columns: list[str]) -> Chain:
        series = self.with_columns({c: missing(F.col(c).cast("double")) for c in columns}).cut()
        at = F.col(SEQ) if series.split else F.row_number().over(series.window)
        series = series.with_frame(series.frame.withColumn("__at", at))
        facts = {c: _known(c, F.col("__at").alias("at"), F.col(c).alias("v")) for c in columns}
        frame = series.frame.withColumns(
            {f"__b_{c}": _nearest(series, facts[c], ahead=False) for c in columns}
            | {f"__a_{c}": _nearest(series, facts[c], ahead=True) for c in columns}
        )
        carried = series.around(
            {f"__cb_{c}": F.max_by(facts[c], facts[c]["at"]) for c in columns},
            {f"__ca_{c}": F.min_by(facts[c], facts[c]["at"]) for c in columns},
        )
        if carried is not None:
            frame = attach(frame, carried, series.groups).withColumns(
                {f"__{tag}_{c}": F.coalesce(f"__{tag}_{c}", f"__c{tag}_{c}") for c in columns for tag in ("b", "a")}
            )
        filled = {}
        for c in columns:
            b, a = F.col(f"__b_{c}"), F.col(f"__a_{c}")
            line = b["v"] + (a["v"] - b["v"]) * (F.col("__at") - b["at"]) / (a["at"] - b["at"])
            filled[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(a.isNull(), b["v"]).otherwise(line)
        helpers = [f"__{tag}_{c}" for c in columns for tag in ("b", "a", "cb", "ca")]
        return self.joined(series.with_frame(frame.withColumns(filled).drop("__at", *helpers)))

    def time_split(self, *, test_size: float = 0.2, name: str = "is_train") -> Chain:
        numbered = self.positions("__at", "__n")
        cut = F.floor(F.lit(1 - test_size) * F.col("__n"))
        return numbered.with_frame(numbered.frame.withColumn(name, F.col("__at") <= cut).drop("__at", "__n"))


def lagged(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    *,
    lags: int = 1,
    moving: bool = True,
    block_rows: int = BLOCK_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Lags 1..``lags`` and, if asked, the lagged moving means of ``columns``."""
    return Chain.of(df, keys, order, block_rows=block_rows, longest=longest).lagged(columns, lags=lags, moving=moving).rows()


def tendency(
    df: DataFrame,
    column: str,
    keys: list[str],
    order: list[str],
    *,
    name: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Change since the previous row, 0 where there is none."""
    return Chain.of(df, keys, order, block_rows=block_rows).tendency(column, name=name).rows()


def complete_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a missing value."""
    return df.na.drop("any", subset=columns)


def fill_gaps(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], *, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Last known value, and for leading gaps the first known one."""
    return Chain.of(df, keys, order, block_rows=block_rows).fill_gaps(columns).rows()


def interpolate(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], *, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Straight line by row position between known values.

    Leading gaps stay missing; trailing ones repeat the last known value.
    """
    return Chain.of(df, keys, order, block_rows=block_rows).interpolate(columns).rows()


def time_split(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    test_size: float = 0.2,
    name: str = "is_train",
    block_rows: int = BLOCK_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Mark the first ``floor((1 - test_size) * n)`` rows of each series as training rows."""
    return Chain.of(df, keys, order, block_rows=block_rows, longest=longest).time_split(test_size=test_size, name=name).rows()


def enough_rows(df: DataFrame, keys: list[str], minimum: int) -> DataFrame:
    """Drop series shorter than ``minimum``; counted with map-side combining, then a semi join."""
    if not keys:
        return df.filter(df.agg(F.count("*")).scalar() >= minimum)
    long_enough = df.groupBy(*keys).count().filter(F.col("count") >= minimum).select(*keys)
    return df.join(long_enough, keys, "left_semi")


def systematic_sample(
    df: DataFrame, order: list[str], *, size: int = 1000, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every ``n // size``-th row in time order; everything if there are at most ``size``.

    A table beyond ``block_rows`` is not sorted: counts find where the wanted rows stand (``ranks``).
    """
    total = df.count()
    return every(df, order, max(total // size, 1), total=total, exact_rows=block_rows)


def resample(
    df: DataFrame, time: str, *, width: str = "6 hours", keys: list[str] | None = None
) -> DataFrame:
    """Means, total rain and rain flag per period; periods with a missing mean are dropped."""
    flag = F.col("rain_flag") if "rain_flag" in df.columns else rain_flag(F.col("precipitation"))
    means = ["temperature", "humidity", "pressure", "wind_speed"]
    out = df.groupBy(*(keys or []), F.window(time, width).alias("__w")).agg(
        *[F.avg(c).alias(c) for c in means if c in df.columns],
        F.coalesce(F.sum("precipitation"), F.lit(0.0)).alias("precipitation"),
        F.max(flag).alias("rain_flag"),
    )
    return out.withColumn(time, F.col("__w.start")).drop("__w").na.drop("any")
