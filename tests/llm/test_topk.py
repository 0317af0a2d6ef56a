import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import topk
from isobar.llm.queries import QUERIES, SQL

from .helpers import SMALL, duck, same_rows


def test_query_equals_sql(spark):
    same_rows(QUERIES["op7_topk"](spark, SMALL), SQL["op7_topk"], duck(SMALL))


def plain(vectors, asked, k, scale=1024):
    out = set()
    points = [(i, [int(np.floor(float(c) * scale)) for c in v]) for i, v in vectors if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    for q, v in points:
        if asked(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in points if i != q and len(w) == len(v))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("block, query_block, few", [(8192, 512, 64), (17, 3, 4), (50, 5, 10)])
def test_blocks_ties_and_structure(spark, block, query_block, few):
    rng = np.random.default_rng(block)
    base = rng.normal(size=(6, 8))
    data = [(i, [float(x) for x in base[i % 6] + (rng.normal(size=8) * 0.1 if i % 3 else 0)]) for i in range(240)]
    data += [(1000 + i, [0.25] * 8) for i in range(60)]  # one vector many times: ties go to the smaller id
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    exact = [(i, [float(np.float32(c)) for c in v]) for i, v in data]
    got = topk.nearest(frame, F.col("vec_id") % 20 == 0, k=5, block=block, query_block=query_block, few=few)
    assert found(got) == plain(exact, lambda i: i % 20 == 0, 5)


def test_odd_rows(spark):
    data = [(0, [1.0, 2.0]), (1, [1.0, -2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, []), (7, [3.0]), (100, [0.5, 0.5]), (200, [9.0]), (300, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 as size", "'x' as block", "2 as score")
    got = topk.nearest(frame, F.col("vec_id") % 100 == 0, k=10)
    assert found(got) == plain(data, lambda i: i % 100 == 0, 10)
    assert topk.nearest(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.nearest(frame, F.lit(None).cast("boolean")).count() == 0


def test_large_components_stay_exact(spark):
    data = [(i, [float(2**28 + i), float(i % 7) * 2**28]) for i in range(90)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert found(topk.nearest(frame, F.col("vec_id") == 3, k=4, scale=1, few=5)) == plain(data, lambda i: i == 3, 4, 1)


def test_repeated_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (5, [2.0]), (5, [2.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.nearest(frame, F.col("vec_id") == 0, k=3, scale=1).collect())
    assert got == [(0, 1, 5, 2), (0, 2, 5, 2)]


def test_pairs_of_blocks_are_tasks_of_their_own(spark):
    frame = spark.createDataFrame([(i, [float(i % 13), float(i % 7)]) for i in range(400)], "vec_id long, embedding array<double>")
    got = topk.nearest(frame, F.col("vec_id") % 4 == 0, k=3, scale=1, block=50, query_block=50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("hashpartitioning(size") == plan.count("hashpartitioning(size#") and ", 32)" in plan


def test_copies_beyond_k_change_nothing(spark):
    data = [(5, [2.0, 1.0])] * 300 + [(5, [3.0, 1.0])] + [(6, [1.0, 1.0])] * 50 + [(0, [1.0, 0.0]), (0, [0.0, 1.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.nearest(frame, F.col("vec_id") == 0, k=4, scale=1, block=20, query_block=1).collect())
    # The query's smaller vector is (0, 1): every candidate scores 1, ties go to the smaller key.
    assert got == [(0, 1, 5, 1), (0, 2, 5, 1), (0, 3, 5, 1), (0, 4, 5, 1)]


def test_candidates_no_query_wants_are_read_no_further(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.integers(0, 1000, (400, 6)), rng.integers(0, 30, (4000, 6))))
    lists, read = topk.Lists(np.arange(len(x)), x), []
    bounds = topk.Lists.bounds
    monkeypatch.setattr(topk.Lists, "bounds", lambda self, w, depth, kind, live: read.append(len(live)) or bounds(self, w, depth, kind, live))
    weights = rng.integers(1, 50, (20, 6))
    found = lists.best(np.full(20, -1), weights, 5, 5)
    assert len(read) > 1 and read[0] == len(x) and read[-1] < 400
    for ids, w in zip([f[1] for f in found], [weights[i] for i in range(20)]):
        assert len(ids) == 5
    wanted = {tuple(sorted((x @ w).tolist())[-5:]) for w in weights}
    assert {tuple(sorted(f[2].tolist())) for f in found} == wanted
