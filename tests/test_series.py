"""Order-dependent operators: results do not depend on how a series is cut."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isobar.operators import columns, ordered, ranks, series

BLOCKS = [1_000_000, 7]


@pytest.fixture(scope="module")
def hot(spark):
    """One city holds most rows, one a single row; some values are missing."""
    rng = np.random.default_rng(3)
    city = np.where(rng.random(400) < 0.7, "big", rng.choice(["a", "b", "c"], 400)).astype(object)
    city[0] = "single"
    v = rng.integers(0, 1000, 400) / 10
    frame = pd.DataFrame({"id": range(400), "city": city, "at": rng.permutation(400), "v": v})
    frame["gap"] = frame["v"].where(rng.random(400) < 0.6)
    df = spark.createDataFrame(
        [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in frame.itertuples(index=False)],
        "id long, city string, at long, v double, gap double",
    ).repartition(5)
    return df, frame.sort_values("at")


def by_id(df, *names):
    out = df.select("id", *names).toPandas().set_index("id").sort_index()
    return out


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_lags_and_moving_means(hot, block_rows):
    df, frame = hot
    got = by_id(
        series.lagged(df, ["city"], ["at"], ["v"], lags=3, block_rows=block_rows),
        "v_lag_1", "v_lag_3", "v_ma_3", "v_ma_6",
    )
    groups = frame.groupby("city")["v"]
    expected = pd.DataFrame({
        "v_lag_1": groups.shift(1),
        "v_lag_3": groups.shift(3),
        "v_ma_3": groups.transform(lambda s: s.shift(1).rolling(3).mean()),
        "v_ma_6": groups.transform(lambda s: s.shift(1).rolling(6).mean()),
    }).set_index(frame["id"]).sort_index()
    pd.testing.assert_frame_equal(got, expected, check_names=False, rtol=1e-9)


@pytest.mark.parametrize("block_rows", BLOCKS)
@pytest.mark.parametrize("keys", [["city"], []])
def test_tendency(hot, block_rows, keys):
    df, frame = hot
    got = by_id(series.tendency(df, "v", keys, ["at"], block_rows=block_rows), "v_tendency")["v_tendency"]
    change = frame.groupby("city")["v"].diff() if keys else frame["v"].diff()
    expected = change.fillna(0).set_axis(frame["id"]).sort_index()
    assert np.allclose(got, expected)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_fills(hot, block_rows):
    df, frame = hot
    got = by_id(series.fill_gaps(df, ["city"], ["at"], ["gap"], block_rows=block_rows), "gap")["gap"]
    expected = frame.groupby("city")["gap"].transform(lambda s: s.ffill().bfill()).set_axis(frame["id"]).sort_index()
    assert np.allclose(got, expected, equal_nan=True)
    got = by_id(series.interpolate(df, ["city"], ["at"], ["gap"], block_rows=block_rows), "gap")["gap"]
    expected = frame.groupby("city")["gap"].transform(lambda s: s.reset_index(drop=True).interpolate().to_numpy())
    assert np.allclose(got, expected.set_axis(frame["id"]).sort_index(), equal_nan=True)


def test_interpolation_ends(spark):
    df = spark.createDataFrame([(0, None), (1, 1.0), (2, None), (3, 3.0), (4, None)], "at int, v double")
    out = series.interpolate(df, [], ["at"], ["v"]).orderBy("at").collect()
    assert [r.v for r in out] == [None, 1.0, 2.0, 3.0, 3.0]


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_positions_split_and_sample(hot, block_rows):
    df, frame = hot
    got = by_id(ordered.positions(df, ["city"], ["at"], total="n", block_rows=block_rows), "position", "n")
    assert (got["position"] == (frame.groupby("city").cumcount() + 1).set_axis(frame["id"]).sort_index()).all()
    assert (got["n"] == frame.groupby("city")["id"].transform("size").set_axis(frame["id"]).sort_index()).all()
    parts = series.time_split(df, ["city"], ["at"], block_rows=block_rows).groupBy("city").agg(
        F.count_if("is_train").alias("train"), F.count("*").alias("n"),
        F.max(F.when(F.col("is_train"), F.col("at"))).alias("last_train"),
        F.min(F.when(~F.col("is_train"), F.col("at"))).alias("first_test"),
    ).collect()
    for r in parts:
        assert r.train == int(0.8 * r.n)
        assert r.last_train is None or r.last_train < r.first_test
    sample = series.systematic_sample(df, ["at"], size=100, block_rows=block_rows)
    assert sorted(r.id for r in sample.collect()) == sorted(frame["id"].iloc[::4])
    assert series.systematic_sample(df, ["at"], size=400, block_rows=block_rows).count() == 400


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_running_sums(hot, block_rows):
    df, frame = hot
    got = by_id(ordered.running_sums(df, ["city"], ["at"], {"s": F.col("id")}, block_rows=block_rows), "s")["s"]
    assert (got == frame.groupby("city")["id"].cumsum().set_axis(frame["id"]).sort_index()).all()


def test_no_task_sees_more_than_a_block(hot):
    """The hot city is really cut: no (series, block) group exceeds block and halo."""
    df, _ = hot
    cut = ordered.arrange(df, ["city"], ["at"], look_back=3, block_rows=20)
    assert cut.split and cut.frame.groupBy(*cut.groups).count().agg(F.max("count")).first()[0] <= 23
    assert cut.rows().count() == 400


def test_independent_of_shuffle_partitions(spark, hot):
    df, _ = hot
    seen = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(by_id(series.lagged(df, ["city"], ["at"], ["v"], block_rows=11), "v_lag_1", "v_ma_6"))
    pd.testing.assert_frame_equal(*seen)


def test_null_key_is_a_series(spark):
    df = spark.createDataFrame([(None, i, float(i)) for i in range(20)], "city string, at int, v double")
    out = series.fill_gaps(df.withColumn("v", F.when(F.col("at") != 10, F.col("v"))), ["city"], ["at"], ["v"], block_rows=5)
    assert [r.v for r in out.orderBy("at").collect()][10] == 9.0


def test_last_n_small_and_large(hot):
    df, frame = hot
    expected = sorted(frame.groupby("city").tail(4)["id"])
    assert sorted(r.id for r in columns.last_n(df, ["city"], ["at"], 4).collect()) == expected
    columns_limit, columns.PREFILTERED = columns.PREFILTERED, 2
    try:
        assert sorted(r.id for r in columns.last_n(df, ["city"], ["at"], 4).collect()) == expected
    finally:
        columns.PREFILTERED = columns_limit


def test_minimum_rows(hot):
    df, frame = hot
    kept = series.enough_rows(df, ["city"], 30).count()
    sizes = frame.groupby("city").size()
    assert kept == sizes[sizes >= 30].sum()
    assert series.enough_rows(df, [], 400).count() == 400 and series.enough_rows(df, [], 401).count() == 0


def test_resample_drops_empty_periods(spark):
    df = spark.sql(
        """SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h) AS ts, t AS temperature, 1.0D AS humidity,
           1.0D AS pressure, 1.0D AS wind_speed, p AS precipitation
           FROM VALUES (0, 1.0D, 0.0D), (5, 3.0D, 2.0D), (13, 5.0D, 0.0D), (30, CAST(NULL AS DOUBLE), 1.0D) AS v(h, t, p)"""
    )
    rows = series.resample(df, "ts").orderBy("ts").collect()
    assert [(r.temperature, r.precipitation, r.rain_flag) for r in rows] == [(2.0, 2.0, 1), (5.0, 0.0, 0)]


def _five(df, block_rows, keep=False):
    out = series.Chain.of(df, ["city"], ["at"], block_rows=block_rows).fill_gaps(["gap"]).tendency("gap")
    out = out.with_columns({"hole": F.when(F.col("id") % 3 != 0, F.col("v"))}).interpolate(["hole"])
    out = out.lagged(["gap_tendency", "hole"], lags=2)
    if keep:
        out = out.complete_rows(["hole", "hole_lag_2"])
    return out.tendency("hole", name="step").time_split().rows()


def _one_by_one(df, block_rows, keep=False):
    at = (["city"], ["at"])
    out = series.tendency(series.fill_gaps(df, *at, ["gap"], block_rows=block_rows), "gap", *at, block_rows=block_rows)
    out = series.interpolate(out.withColumn("hole", F.when(F.col("id") % 3 != 0, F.col("v"))), *at, ["hole"], block_rows=block_rows)
    out = series.lagged(out, *at, ["gap_tendency", "hole"], lags=2, block_rows=block_rows)
    if keep:
        out = series.complete_rows(out, ["hole", "hole_lag_2"])
    return series.time_split(series.tendency(out, "hole", *at, name="step", block_rows=block_rows), *at, block_rows=block_rows)


@pytest.mark.parametrize("keep", [False, True])
@pytest.mark.parametrize("block_rows", [1_000_000, 40, 2])
def test_chain_gives_the_rows_of_its_operators(hot, block_rows, keep):
    df, _ = hot
    got, expected = _five(df, block_rows, keep), _one_by_one(df, 1_000_000, keep)
    assert got.columns == expected.columns
    names = [c for c in expected.columns if c != "id"]
    pd.testing.assert_frame_equal(by_id(got, *names), by_id(expected, *names), rtol=1e-9)


def test_chain_writes_the_table_once(hot, monkeypatch):
    """One sorted copy; everything else that is written has at most a row per block and series."""
    df, _ = hot
    written = []
    true_stage = ordered.stage

    def counted(frame, label):
        out = true_stage(frame, label)
        written.append((label, out.count()))
        return out

    monkeypatch.setattr(ordered, "stage", counted)
    assert _five(df, 20, keep=True).count() > 300
    assert [n for label, n in written if label == "ranged"] == [400]
    assert all(n <= 400 // 20 + 5 for label, n in written if label != "ranged") and len(written) > 1


def test_chain_of_no_rows(hot):
    df, _ = hot
    assert _five(df.limit(0), 5, keep=True).count() == 0


# ---- places without a sort ------------------------------------------------


def _places(df, order, step, **limits):
    return sorted(r.id for r in ranks.every(df, order, step, **limits).collect())


@pytest.mark.parametrize("order, steps, limits", [
    (["far", "id"], [7], {"exact_rows": 60}),
    (["day", "flag", "id"], [1, 699, 5000], {"exact_rows": 60, "first": 16, "finer": 16}),
    (["at", "id"], [7], {"exact_rows": 3}),
    (["local", "id"], [7], {"exact_rows": 60, "first": 32, "finer": 8}),
    (["flag", "far", "day", "local", "id"], [7], {"exact_rows": 30}),
])
def test_places_by_counting(spark, order, steps, limits):
    """Heavy ties, gaps, NULL and the ends of the number range in several types of columns."""
    rng = np.random.default_rng(8)
    n = 700
    day = rng.integers(0, 4, n)
    far = rng.choice([-(2**63), 2**63 - 1, 0, 1, 2, 10**15], n)
    frame = [
        (i, None if i % 50 == 7 else int(far[i]), int(day[i]), int(rng.integers(0, 10**9)) * 10**6 + 123_456, None if i % 9 == 2 else bool(i % 2)) for i in range(n)
    ]
    df = spark.createDataFrame(frame, "id long, far long, day int, us long, flag boolean").repartition(5).select(
        "id", "far", "flag",
        F.date_add(F.lit("2024-01-30").cast("date"), F.col("day")).alias("day"),
        F.timestamp_micros("us").alias("at"), F.timestamp_micros("us").cast("timestamp_ntz").alias("local"),
    )
    ids = [r.id for r in df.orderBy(*order).collect()]
    for step in steps:
        assert _places(df, order, step, **limits) == sorted(ids[::step])


def test_places_of_other_tables(spark, monkeypatch):
    def no_sort(*_, **__):
        raise AssertionError("sorted")

    df = spark.range(500).select("id", (F.col("id") % 2).alias("half"), F.col("id").cast("string").alias("text"))
    assert _places(df, ["text"], 10, exact_rows=20) == sorted(int(t) for t in sorted(map(str, range(500)))[::10])
    assert len(_places(df, ["half"], 10, exact_rows=20)) == 50  # 250 rows of one value: numbered
    assert _places(df.limit(0), ["id"], 10, exact_rows=0) == []
    monkeypatch.setattr(ranks, "positions", no_sort)
    assert _places(df, ["half", "id"], 10, exact_rows=20) == sorted([*range(0, 500, 20), *range(1, 500, 20)])
