import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import centroids
from isobar.llm.centroids import Bisectors, Clustering
from isobar.llm.queries import QUERIES, SQL

from .helpers import SMALL, duck, same_rows


def test_query_equals_sql(spark):
    same_rows(QUERIES["op11_centroids"](spark, SMALL), SQL["op11_centroids"], duck(SMALL))


def plain(rows, how):
    """Every step by definition, over Python integers."""
    kept = [(i, [math.floor(c * how.scale) for c in v]) for i, v in rows if v is not None and len(v) == how.size and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{how.seed}:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[: how.count]]
    if not middle:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middle))

    for _ in range(how.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        middle = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(middle)]
    last = [(i, *nearest(v)) for i, v in kept]
    return sorted(
        [
            (i, n, d, sum(e for _, e, m in last if m == n), sum(e for _, e, _ in last), hashlib.sha256(",".join(map(str, middle[n])).encode()).hexdigest())
            for i, d, n in last
        ],
        key=str,
    )


def found(frame, how):
    return sorted(map(tuple, centroids.clusters(frame, how).collect()), key=str)


@pytest.mark.parametrize("seed, count, rounds", [(1, 5, 3), (2, 1, 2), (3, 8, 0), (4, 400, 2)])
def test_equals_plain(spark, seed, count, rounds):
    rng = np.random.default_rng(seed)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=4) * (i % 5)]) for i in range(200)]
    data += [(1000 + i, [0.5, -0.5, 0.25, 0.0]) for i in range(40)]  # ties
    data += [(7, [1.0, 2.0, 3.0, 4.0])] * 3 + [(None, [3.0, 3.0, 3.0, 3.0]), (None, [-9.0] * 4)]
    data += [(2000, None), (2001, []), (2002, [1.0] * 3), (2003, [1.0] * 5), (2004, [1.0, None, 1.0, 1.0])]
    data += [(2005, [1.0, float("nan"), 0.0, 0.0]), (2006, [float("inf"), 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(6)
    frame = frame.select("*", *[F.lit("?").alias(c) for c in ("id", "x", "cluster", "distance", "n")])
    how = Clustering(count=count, rounds=rounds, size=4, scale=64, seed=seed)
    assert found(frame, how) == plain(data, how)


def test_tournament_equals_smallest_distance():
    rng = np.random.default_rng(5)
    for reach in (3, 1 << 20, 1 << 40):  # floating point, 64-bit and Python integers
        middle = rng.integers(-reach, reach, (9, 3))
        middle[4] = middle[2]  # the smaller number wins
        x = np.concatenate((rng.integers(-reach, reach, (300, 3)), middle, (middle[0] + middle[1])[None] // 2))
        square = ((x.astype(object)[:, None] - middle[None]) ** 2).sum(axis=2)
        wanted = [min(range(9), key=lambda c: (row[c], c)) for row in square]
        pairs = Bisectors(middle)
        assert pairs.winners(x).tolist() == wanted
        assert pairs.distances(x, np.array(wanted)).tolist() == [row[c] for row, c in zip(square, wanted)]


def test_same_rows_in_any_partitioning(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    how = Clustering(count=6, rounds=2)
    assert found(frame.repartition(1), how) == found(frame.repartition(13), how)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert found(frame, Clustering()) == []
    assert centroids.fit(frame).shape == (0, 64)
