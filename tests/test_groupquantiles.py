"""Quantiles of groups equal plain ones, whatever size a task may hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import clean
from isobar.operators import groupquantiles as g


def plain(rows, probs):
    out = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        lists = []
        for c in (1, 2):
            values = np.array([r[c] for r in mine if r[c] is not None and not np.isnan(r[c])])
            lists.append([float(np.quantile(values, p)) for p in probs] if len(values) else [None] * len(probs))
        out[key] = lists
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    data = [("hot", float(v), float(k % 4)) for k, v in enumerate(rng.normal(size=6000))]  # many rows; few values
    data += [("flat", 2.5, float(v)) for v in rng.integers(0, 3000, 2500)]
    data += [(None, float(v), None) for v in rng.exponential(size=900)]
    data += [("one", 7.0, float("nan")), ("none", None, None), ("two", 1.0, 4.0), ("two", 2.0, None)]
    return data


@pytest.mark.parametrize("group_rows, accuracy", [(100_000, 1000), (500, 1000), (40, 200)])
def test_group_quantiles(spark, rows, group_rows, accuracy):
    frame = spark.createDataFrame(rows, "city string, a double, b double").repartition(6)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = g.group_quantiles(frame, ["city"], ["a", "b"], probs, group_rows=group_rows, accuracy=accuracy).collect()
    found = {r.city: [list(r.a), list(r.b)] for r in got}
    wanted = plain(rows, probs)
    assert found.keys() == wanted.keys()
    for key, lists in wanted.items():
        for mine, other in zip(found[key], lists):
            assert mine == pytest.approx(other, rel=1e-14) if None not in other else mine == other


def test_no_task_sorts_a_large_group(spark, rows):
    """What is sorted at the end is what the brackets left."""
    frame = spark.createDataFrame(rows, "city string, a double, b double")
    sizes = g.group_sizes(frame, ["city"], ["a", "b"]).filter("city = 'hot'")
    picked = g._large(frame.filter("city = 'hot'"), sizes, ["city"], ["a", "b"], [0.3], 30, 50)
    values = np.sort([r[1] for r in rows if r[0] == "hot"])
    found = {(r["__c"], r["__rank"]): r["__answer"] for r in picked.collect()}
    assert {k[1] for k in found} == {1799, 1800}
    assert found[0, 1799] == values[1799] and found[0, 1800] == values[1800]


@pytest.mark.parametrize("group_rows", [100_000, 30])
def test_fill_by_key(spark, group_rows):
    data = [("a", 1, float(v), v) for v in range(99)] + [("a", 2, None, None), ("b", 3, None, 7), ("b", 4, float("nan"), None), (None, 5, None, None), (None, 6, 3.0, 4)]
    frame = spark.createDataFrame(data, "city string, row int, x double, n int")
    got = {r.row: (r.x, r.n) for r in clean.fill_median(frame, ["x", "n"], keys=["city"], group_rows=group_rows).collect()}
    everyone = float(np.median([*range(99), 3.0]))
    assert (got[2], got[3], got[4], got[5], got[6]) == ((49.0, 49.0), (everyone, 7.0), (everyone, 7.0), (3.0, 4.0), (3.0, 4.0))
    plain_fill = {r.row: r.x for r in clean.fill_median(frame, ["x", "n"]).collect()}
    assert plain_fill[2] == everyone


def test_default_columns_leave_keys_alone(spark):
    frame = spark.createDataFrame([(1, 2.0), (1, None), (None, 5.0)], "city int, x double")
    got = clean.fill_median(frame, keys=["city"])
    assert got.schema["city"].dataType.simpleString() == "int"
    assert sorted(got.collect(), key=str) == sorted(spark.createDataFrame([(1, 2.0), (1, 2.0), (None, 5.0)], frame.schema).collect(), key=str)


def test_cleaning_by_city(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 9.0), ("b", None)], "city string, temperature double").withColumn("row", F.monotonically_increasing_id())
    got = clean.clean(frame, fill_columns=["temperature"], fill_keys=["city"], outlier_columns=[], mode_columns=[])
    assert sorted(r.temperature for r in got.collect()) == [1.0, 2.0, 3.0, 9.0, 9.0]
