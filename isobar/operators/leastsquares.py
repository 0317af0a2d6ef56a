"""Least squares per key from summed, centred cross products.

Each task keeps, per key, the number of rows, the mean of every column and the
cross products around that mean; such parts merge exactly and without the
cancellation that raw sums of squares suffer on long series.  A key gives one
row per task, so what is shuffled is keys times tasks, and what reaches the
solver is p*p numbers per key, however many rows the key has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A task passes its parts on when they fill this many bytes, so unclustered keys cost rows, not memory.
HELD_BYTES = 128 << 20
#: Parts of a key are merged in so many groups before the last one.
MERGES = 32

FIT_FIELDS = [
    T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("std_errors", T.ArrayType(T.DoubleType())),
    T.StructField("p_values", T.ArrayType(T.DoubleType())),
    T.StructField("sigma2", T.DoubleType()),
    T.StructField("n_obs", T.LongType()),
    T.StructField("n_params", T.IntegerType()),
    T.StructField("llf", T.DoubleType()),
    T.StructField("aic", T.DoubleType()),
    T.StructField("bic", T.DoubleType()),
]


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, v: total + v)


class Moments:
    """Rows, column means and cross products around them; ``+`` merges two."""

    def __init__(self, n: int, mean: np.ndarray, spread: np.ndarray):
        self.n, self.mean, self.spread = n, mean, spread

    @staticmethod
    def of(z: np.ndarray) -> Moments:
        mean = z.mean(axis=0)
        return Moments(len(z), mean, (z - mean).T @ (z - mean))

    def __add__(self, other: Moments) -> Moments:
        n, apart = self.n + other.n, other.mean - self.mean
        spread = self.spread + other.spread + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), spread)

    def row(self) -> np.ndarray:
        """[n, means, upper triangle]."""
        return np.concatenate(([self.n], self.mean, self.spread[np.triu_indices(len(self.mean))]))

    @staticmethod
    def read(row: np.ndarray, size: int) -> Moments:
        spread = np.zeros((size, size))
        spread[np.triu_indices(size)] = row[1 + size :]
        return Moments(int(round(row[0])), np.asarray(row[1 : 1 + size]), spread + np.triu(spread, 1).T)


def _merged(parts: Iterator[tuple[tuple, Moments]], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Parts added up per key, handed on whenever they fill ``HELD_BYTES``."""
    held: dict[tuple, Moments] = {}
    size = 0

    def out() -> pd.DataFrame:
        names = pd.DataFrame(list(held), columns=keys)
        return names.assign(part=[m.row().tolist() for m in held.values()])

    for key, part in parts:
        if key in held:
            held[key] = held[key] + part
        else:
            held[key] = part
            size += part.spread.nbytes
        if size >= HELD_BYTES:
            yield out()
            held, size = {}, 0
    if held:
        yield out()


def moments(df: DataFrame, keys: list[str], x: str, y: str, width: int) -> DataFrame:
    """``(keys, part)``: moments of [x, y] per key and task.

    ``x`` is an array column of ``width`` numbers; rows where it or ``y`` is
    NULL are left out.
    """

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts():
            for pdf in batches:
                for key, rows in pdf.groupby(keys, sort=False):
                    design = np.stack(rows[x].to_numpy()) if width else np.empty((len(rows), 0))
                    yield key, Moments.of(np.column_stack([design, rows[y].to_numpy(float)]))

        yield from _merged(parts(), keys)

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts():
            for pdf in batches:
                names = pdf[keys].itertuples(index=False, name=None)
                for key, part in zip(names, pdf["part"]):
                    yield key, Moments.read(part, width + 1)

        yield from _merged(parts(), keys)

    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("part", T.ArrayType(T.DoubleType()))])
    parts = df.select(*keys, x, y).na.drop().mapInPandas(first, schema)
    # A key that fills many tasks is merged in groups, so the last merge sees few rows.
    group = F.pmod(F.spark_partition_id(), F.lit(MERGES))
    grouped = parts.withColumn("__group", group).repartition(*keys, "__group").drop("__group")
    return grouped.mapInPandas(again, schema)


def solve_from(found: Moments, constant: bool) -> dict:
    """Minimum-norm solution and Gaussian summary statistics of y on x.

    With fewer rows than coefficients plus one there is no model: all results
    but the counts are None.  Information criteria use the conditional
    likelihood of the rows given, not an exact one.
    """
    n, p = found.n, len(found.mean) - 1
    used = p + 1 if constant else p
    k = used + 1
    if n < used + 1:
        empty = dict.fromkeys([f.name for f in FIT_FIELDS])
        return {**empty, "n_obs": n, "n_params": k}
    # Around the means with a constant, around zero without.
    gram = found.spread if constant else found.spread + n * np.outer(found.mean, found.mean)
    a, b = gram[:p, :p], gram[:p, p]
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    inverse = np.linalg.pinv(a / np.outer(scale, scale), rcond=1e-11, hermitian=True) if p else a
    beta = inverse @ (b / scale) / scale
    sse = max(float(gram[p, p] - 2 * beta @ b + beta @ a @ beta), 0.0)
    sigma2 = sse / n
    cover = inverse / np.outer(scale, scale)
    variance = np.diag(cover)
    if constant:
        center = found.mean[:p]
        beta = np.append(beta, found.mean[p] - beta @ center)
        variance = np.append(variance, 1 / n + center @ cover @ center)
    spread = np.sqrt(np.maximum(variance, 0.0) * sigma2)
    z = np.divide(np.abs(beta), spread, out=np.full_like(beta, np.inf), where=spread > 0)
    llf = -0.5 * n * (math.log(2 * math.pi * sigma2) + 1) if sigma2 > 0 else None
    return {
        "coefficients": beta.tolist(),
        "std_errors": spread.tolist(),
        "p_values": [math.erfc(v / math.sqrt(2)) for v in z],
        "sigma2": sigma2,
        "n_obs": n,
        "n_params": k,
        "llf": llf,
        "aic": None if llf is None else 2 * k - 2 * llf,
        "bic": None if llf is None else k * math.log(n) - 2 * llf,
    }


def least_squares(df: DataFrame, keys: list[str], x: str, y: str, width: int, *, constant: bool = False) -> DataFrame:
    """One row per key: coefficients in the order of ``x`` (then the constant) and fit statistics.

    A key with too few rows for the coefficients has NULL coefficients.
    """

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        found = None
        for part in pdf["part"]:
            read = Moments.read(part, width + 1)
            found = read if found is None else found + read
        fit = solve_from(found, constant)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, **{c: [v] for c, v in fit.items()}})

    sums = moments(df, keys, x, y, width)
    return sums.groupBy(*keys).applyInPandas(solve, T.StructType([*[df.schema[k] for k in keys], *FIT_FIELDS]))
