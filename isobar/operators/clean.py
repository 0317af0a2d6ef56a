"""Cleaning: duplicates, missing values, outliers, types.

Fill values and outlier bounds are global scalars.  They are computed first
(exactly, see ``quantiles``) and then used as literals, so the cleaned table is
a single narrow pass whose filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.weather import clip, missing, to_number
from isobar.operators.groupquantiles import GROUP_ROWS, group_quantiles, group_sizes
from isobar.operators.ordered import attach
from isobar.operators.quantiles import EXACT_ROWS, exact_quantiles
from isobar.schema import MEASURES
from isobar.staging import discard, stage

UNKNOWN = "Unknown"


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row duplicates; copies collapse inside each map task first."""
    return df.dropDuplicates()


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: missing(F.col(c)) for c in floats}) if floats else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    """Strings, and dates, which arrive as objects where this rule comes from."""
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.DateType))]


def incomplete(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns with at least one missing value; one counting pass."""
    if not columns:
        return []
    counts = df.agg(*[F.count_if(_gap(df, c)) for c in columns]).first()
    return [c for c, gaps in zip(columns, counts) if gaps]


def _gap(df: DataFrame, column: str) -> Column:
    floating = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    return F.col(column).isNull() | F.isnan(column) if floating else F.col(column).isNull()


def medians(df: DataFrame, columns: list[str], *, exact_rows: int = EXACT_ROWS) -> dict[str, float]:
    found = exact_quantiles(df, columns, [0.5], exact_rows=exact_rows)
    return {c: q[0] for c, q in found.items() if q[0] is not None}


def medians_by_key(df: DataFrame, keys: list[str], columns: list[str], *, group_rows: int = GROUP_ROWS, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """A row per key with the exact median of every column; a key without a value of a column has the whole table's."""
    sizes = stage(group_sizes(df, keys, columns), "sizes")
    fewest = sizes.agg(*[F.min(c) for c in columns]).first()
    whole = medians(df, [c for c, n in zip(columns, fewest) if n == 0], exact_rows=exact_rows)
    found = group_quantiles(df, keys, columns, [0.5], group_rows=group_rows, sizes=sizes)
    return found.select(*keys, *[F.coalesce(F.get(c, F.lit(0)), F.lit(whole.get(c)).cast("double")).alias(c) for c in columns])


def fill_median(
    df: DataFrame, columns: list[str] | None = None, *, keys: list[str] | None = None, exact_rows: int = EXACT_ROWS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Fill missing numbers with the column median (default: every numeric column but the keys).

    With ``keys`` a row takes the median of its own key (of the whole table
    where the key has no value at all; NULL is a key like any other).  Columns
    without a gap are not ranked.  A filled column keeps its type if it is
    fractional; integers become double whether or not there is a gap, since a
    median may lie between two of them.
    """
    columns = [c for c in numeric_columns(df) if c not in (keys or [])] if columns is None else columns
    types = {f.name: f.dataType for f in df.schema}
    gaps = incomplete(df, columns)
    if keys and gaps:
        own = medians_by_key(df, keys, gaps, group_rows=group_rows, exact_rows=exact_rows)
        order = df.columns
        df = attach(df, own.withColumnsRenamed({c: f"__m_{c}" for c in gaps}), keys)
        filled = {}
        for c in columns:
            value = missing(F.col(c)) if isinstance(types[c], (T.FloatType, T.DoubleType)) else F.col(c)
            kind = T.DoubleType() if isinstance(types[c], T.IntegralType) else types[c]
            filled[c] = F.coalesce(value.cast(kind), F.col(f"__m_{c}").cast(kind)) if c in gaps else value.cast(kind)
        return df.withColumns(filled).select(*order)
    middle = medians(df, gaps, exact_rows=exact_rows)
    filled = {}
    for c in columns:
        value = missing(F.col(c)) if isinstance(types[c], (T.FloatType, T.DoubleType)) else F.col(c)
        kind = T.DoubleType() if isinstance(types[c], T.IntegralType) else types[c]
        if c in middle:
            filled[c] = F.coalesce(value.cast(kind), F.lit(middle[c]).cast(kind))
        elif kind != types[c]:
            filled[c] = value.cast(kind)
    return df.withColumns(filled) if filled else df


def modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent value per column, ties to the smallest; all columns in one pass.

    Counted as (column, value) groups, so no task holds a column's distinct
    values, and each map task keeps one candidate per column.
    """
    if not columns:
        return {}
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])).alias(
            "pair"
        )
    ).select("pair.*")
    counts = pairs.filter(F.col("value").isNotNull()).groupBy("name", "value").count()
    best = Window.partitionBy("name").orderBy(F.col("count").desc(), "value")
    winners = counts.withColumn("rank", F.row_number().over(best)).filter("rank = 1")
    return {r["name"]: r["value"] for r in winners.collect()}  # one row per column


def fill_mode(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill missing text with the column mode; a column without values gets 'Unknown'."""
    columns = incomplete(df, text_columns(df) if columns is None else columns)
    if not columns:
        return df
    common = modes(df, columns)
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(common.get(c, UNKNOWN)).try_cast(types[c])) for c in columns}
    )


def iqr_bounds(
    df: DataFrame, columns: list[str], *, factor: float = 1.5, exact_rows: int = EXACT_ROWS, at_most: int | None = None
) -> dict[str, tuple[float, float]]:
    found = exact_quantiles(df, columns, [0.25, 0.75], exact_rows=exact_rows, at_most=at_most)
    out = {}
    for c, (low, high) in found.items():
        if low is not None:
            spread = high - low
            out[c] = (low - factor * spread, high + factor * spread)
    return out


def drop_outliers(
    df: DataFrame,
    columns: list[str] = MEASURES,
    *,
    factor: float = 1.5,
    simultaneous: bool = False,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Keep rows within the quartile fences of every listed column that exists.

    By default column k's fences are taken after columns 1..k-1 have filtered;
    ``simultaneous`` takes all of them from the unfiltered table in one pass.
    Missing values are dropped.  On a mostly-zero column both fences are 0, so
    leave such columns out to keep their non-zero rows.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    # The passes read a narrow copy; the table itself is filtered once, by literals.
    written = narrow = stage(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "measures")
    most = narrow.count()
    for group in [columns] if simultaneous else [[c] for c in columns]:
        bounds = iqr_bounds(narrow, group, factor=factor, exact_rows=exact_rows, at_most=most)
        for c in group:
            # No value at all lies within no fence.
            inside = missing(F.col(c).cast("double")).between(*bounds[c]) if c in bounds else F.lit(False)
            df, narrow = df.filter(inside), narrow.filter(inside)
    discard(written)
    return df


def coerce_types(df: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    """Measures as double (bad text becomes NULL), humidity limited to 0..100."""
    df = df.withColumns({c: to_number(F.col(c)) for c in columns if c in df.columns})
    if "humidity" in df.columns:
        df = df.withColumn("humidity", clip(F.col("humidity"), 0.0, 100.0))
    return df


def clean(
    df: DataFrame,
    *,
    outlier_columns: list[str] = MEASURES,
    fill_columns: list[str] | None = None,
    fill_keys: list[str] | None = None,
    mode_columns: list[str] | None = None,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Duplicates, fills, outliers and types, in that order.

    ``fill_columns`` get their median (with ``fill_keys`` that of their key),
    ``mode_columns`` their mode; by default all numeric and all text columns,
    so a table with keys names its measures.
    The distinct rows are written once: the later steps take several narrow
    passes over single columns, which then skip the duplicate shuffle.
    """
    df = stage(drop_duplicates(nan_to_null(df)), "distinct")
    df = fill_mode(fill_median(df, fill_columns, keys=fill_keys, exact_rows=exact_rows), mode_columns)
    return coerce_types(drop_outliers(df, outlier_columns, exact_rows=exact_rows))
