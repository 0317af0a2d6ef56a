"""Exact quantiles of many groups at once.

A group of at most ``group_rows`` values is sorted as one array.  Larger ones
never meet in a task: each wanted rank has a bracket of values around it, a row
of a small table that is joined to the values.  A mergeable sketch per bracket
proposes points near the rank, exact counts (combined before the shuffle) close
the bracket around them, and this repeats until what is left of it is small.
Spark broadcasts the brackets while they measure small and splits hot keys of a
shuffled join otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.weather import missing
from isobar.operators.ordered import attach
from isobar.staging import discard, stage

GROUP_ROWS = 100_000
#: Points a sketch proposes between the ends of a bracket, and the ranks' accuracy (1 / that) of the sketch.
GRID, ACCURACY = 63, 1000


def _number(column: str) -> Column:
    return missing(F.col(column).cast("double"))


def interpolated(values: Column, share: float) -> Column:
    """The linear quantile of a sorted array, from the nearer end; NULL if it is empty."""
    at = (F.size(values) - 1) * F.lit(share)
    low, high = F.get(values, F.floor(at).cast("int")), F.get(values, F.ceil(at).cast("int"))
    return F.when(F.size(values) > 0, between(low, high, at - F.floor(at)))


def between(low: Column, high: Column, part: Column) -> Column:
    return F.when(part < 0.5, low + (high - low) * part).otherwise(high - (high - low) * (1 - part))


def group_sizes(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A row per group: the number of values of every column."""
    return df.groupBy(*keys).agg(*[F.count(_number(c)).alias(c) for c in columns])


def _small(df: DataFrame, keys: list[str], columns: list[str], probs: list[float]) -> DataFrame:
    lists = df.groupBy(*keys).agg(*[F.sort_array(F.collect_list(_number(c))).alias(c) for c in columns])
    return lists.select(*keys, *[F.array(*[interpolated(F.col(c), p) for p in probs]).alias(c) for c in columns])


def _inside(values: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """Every value beside each bracket of its group that it lies strictly inside."""
    renamed = brackets.select(*[F.col(n).alias(f"__b_{n}") for n in [*keys, "__c"]], *[c for c in brackets.columns if c not in [*keys, "__c"]])
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__b_{n}")) for n in [*keys, "__c"]])
    met = values.join(renamed, same).drop(*[f"__b_{n}" for n in [*keys, "__c"]])
    return met.filter((F.col("__above").isNull() | (F.col("__v") > F.col("__above"))) & (F.col("__below").isNull() | (F.col("__v") < F.col("__below"))))


def _closed(values: DataFrame, open_: DataFrame, keys: list[str], accuracy: int) -> DataFrame:
    """The brackets after one round of proposals and counts."""
    group = [*keys, "__c", "__rank"]
    state = ["__at", "__rows", "__above", "__below"]
    steps = [(k + 1) / (GRID + 1) for k in range(GRID)]
    sketch = _inside(values, open_, keys).groupBy(*group, *state).agg(F.percentile_approx("__v", steps, accuracy).alias("__grid"))
    near = F.round((F.col("__at") + 0.5) / F.col("__rows") * (GRID + 1)).cast("int") - 1  # of the grid
    points = [F.get("__grid", F.least(F.greatest(near + d, F.lit(0)), F.lit(GRID - 1))) for d in (-1, 0, 1)]
    proposed = stage(sketch.select(*group, *state, *[p.alias(f"__p{k}") for k, p in enumerate(points)]), "proposals")
    counted = _inside(values, proposed, keys).groupBy(*group, *state, "__p0", "__p1", "__p2").agg(
        *[F.count_if(F.col("__v") < F.col(f"__p{k}")).alias(f"__less{k}") for k in range(3)],
        *[F.count_if(F.col("__v") == F.col(f"__p{k}")).alias(f"__equal{k}") for k in range(3)],
    )
    at = F.col("__at")
    less, upto = [F.col(f"__less{k}") for k in range(3)], [F.col(f"__less{k}") + F.col(f"__equal{k}") for k in range(3)]
    point = [F.col(f"__p{k}") for k in range(3)]
    answer = F.coalesce(*[F.when((less[k] <= at) & (at < upto[k]), point[k]) for k in range(3)])
    # Points ascend: the last one that lies wholly before the rank and the first one that lies after it.
    before = [F.when(at >= upto[k], F.struct(point[k].alias("v"), upto[k].alias("n"))) for k in (2, 1, 0)]
    after = [F.when(at < less[k], F.struct(point[k].alias("v"), less[k].alias("n"))) for k in range(3)]
    counted = counted.withColumns({"__answer": answer, "__lower": F.coalesce(*before), "__upper": F.coalesce(*after)})
    smaller = F.coalesce(F.col("__lower.n"), F.lit(0))
    return counted.select(
        *group,
        (at - smaller).alias("__at"),
        (F.coalesce(F.col("__upper.n"), F.col("__rows")) - smaller).alias("__rows"),
        F.coalesce(F.col("__lower.v"), F.col("__above")).alias("__above"),
        F.coalesce(F.col("__upper.v"), F.col("__below")).alias("__below"),
        "__answer",
    )


def _large(df: DataFrame, sizes: DataFrame, keys: list[str], columns: list[str], probs: list[float], group_rows: int, accuracy: int) -> DataFrame:
    """``(keys, __c, __n, __ranks)``: per group and column the values at the ranks next to the quantiles, by bracket."""
    one = F.array(*[F.struct(F.lit(k).alias("__c"), _number(c).alias("__v")) for k, c in enumerate(columns)])
    values = stage(df.select(*keys, F.inline(one)).filter("__v is not null"), "values")
    counts = F.array(*[F.struct(F.lit(k).alias("__c"), F.col(c).alias("__n")) for k, c in enumerate(columns)])
    ranks = F.array_distinct(F.array(*[f((F.col("__n") - 1) * F.lit(p)).cast("long") for p in probs for f in (F.floor, F.ceil)]))
    wanted = sizes.select(*keys, F.inline(counts)).filter("__n > 0").select(*keys, "__c", F.col("__n").alias("__rows"), F.explode(ranks).alias("__rank"))
    none = F.lit(None).cast("double")
    state = wanted.select(*keys, "__c", "__rank", F.col("__rank").alias("__at"), "__rows", none.alias("__above"), none.alias("__below"), none.alias("__answer"))
    state = stage(state, "brackets")
    while (state.filter("__answer is null").agg(F.max("__rows")).first()[0] or 0) > group_rows:
        wide = (F.col("__answer").isNull()) & (F.col("__rows") > group_rows)
        closed = _closed(values, state.filter(wide).drop("__answer"), keys, accuracy)
        narrower = stage(state.filter(~wide).unionByName(closed), "brackets")
        discard(state)
        state = narrower
    last = state.filter("__answer is null").drop("__answer")
    picked = _inside(values, last, keys).groupBy(*keys, "__c", "__rank", "__at").agg(F.sort_array(F.collect_list("__v")).alias("__left"))
    picked = picked.select(*keys, "__c", "__rank", F.get("__left", F.col("__at").cast("int")).alias("__answer"))
    answered = state.filter("__answer is not null").select(*keys, "__c", "__rank", "__answer")
    found = stage(answered.unionByName(picked), "ranks")
    discard(values)
    discard(state)
    return found


def group_quantiles(
    df: DataFrame, keys: list[str], columns: list[str], probs: list[float], *, group_rows: int = GROUP_ROWS, accuracy: int = ACCURACY, sizes: DataFrame | None = None
) -> DataFrame:
    """A row per group of ``keys`` (NULL is a group): for each column the array of its exact linear quantiles.

    Missing and NaN values are ignored; a group without values of a column has
    NULLs.  No task holds more than ``group_rows`` values of a column of a
    group.  ``sizes`` is ``group_sizes`` where the caller has it.
    """
    sizes = stage(group_sizes(df, keys, columns), "sizes") if sizes is None else sizes
    most = F.greatest(*[F.col(c) for c in columns], F.lit(0))
    if (sizes.agg(F.max(most)).first()[0] or 0) <= group_rows:
        return _small(df, keys, columns, probs)
    rows = df.select(*keys, *columns)
    large = sizes.filter(most > group_rows)
    names = large.select(*[F.col(k).alias(f"__l_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__l_{k}")) for k in keys])
    found = _large(rows.join(names, same, "left_semi"), large, keys, columns, probs, group_rows, accuracy)
    ends = found.groupBy(*keys, "__c").agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__answer"))).alias("__ranks"))
    by_group = ends.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__c", "__ranks"))).alias("__all"))
    joined = attach(large, by_group, keys)

    def quantile(k: int, c: str, share: float) -> Column:
        at = (F.col(c) - 1) * F.lit(share)
        ranks = F.col("__all")[k]
        return F.when(F.col(c) > 0, between(ranks[F.floor(at).cast("long")], ranks[F.ceil(at).cast("long")], at - F.floor(at)))

    heavy = joined.select(*keys, *[F.array(*[quantile(k, c, p) for p in probs]).alias(c) for k, c in enumerate(columns)])
    return _small(rows.join(names, same, "left_anti"), keys, columns, probs).unionByName(heavy)
