"""Feature formulas, encodings, quality and scores against hand-checked values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.functions.weather import dew_point, feels_like
from isobar.operators import encode, metrics, quality, split
from isobar.operators.features import engineer, observed_at
from isobar.plans.models import rain_features, temperature_features


def test_engineered_literals(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, timestamp_ntz'2023-01-01 00:00:00', 25D, 60D, 1013D, 10D, 0D),
           (1, timestamp_ntz'2023-01-01 01:00:00', 30D, 70D, 1015D, 15D, 2D),
           (1, timestamp_ntz'2023-01-01 02:00:00', 20D, 50D, 1010D, 5D, 0D)
           AS t(city_id, date, temperature, humidity, pressure, wind_speed, precipitation)"""
    )
    out = engineer(df).withColumn("feels", feels_like(F.col("temperature"), F.col("humidity")))
    rows = out.orderBy("date").collect()
    assert [r.dew_point for r in rows] == pytest.approx([16.6842496, 23.91497929, 9.25429428])
    assert [r.feels for r in rows] == pytest.approx([28.15, 35.425, 21.375])
    assert [r.pressure_tendency for r in rows] == [0, 2, -5]
    assert [r.rain_flag for r in rows] == [0, 1, 0] and [r.hour for r in rows] == [0, 1, 2]
    assert {(r.day_of_week, r.month, r.season) for r in rows} == {(6, 1, "Summer")}
    assert [r.temp_humidity_interaction for r in rows] == [1500, 2100, 1000]
    assert [r.wind_pressure_interaction for r in rows] == [10130, 15225, 5050]


def test_formula_edges(spark):
    df = spark.createDataFrame([(20.0, 0.0), (-237.7, 50.0), (None, 50.0)], "t double, h double")
    assert [r[0] for r in df.select(dew_point(F.col("t"), F.col("h"))).collect()] == [None, None, None]


def test_observed_at(spark):
    df = spark.sql("SELECT date'2024-03-05' AS date, 7 AS hour")
    assert str(observed_at(df).first().observed_at) == "2024-03-05 07:00:00"


def test_label_encoding_is_kept(spark):
    train = spark.createDataFrame([("N",), ("E",), ("S",), (None,)], "wind_direction string")
    mapping = encode.label_mapping(train, "wind_direction")
    got = {r[0]: r[1] for r in encode.encode_labels(train, "wind_direction", mapping).collect()}
    assert got == {"N": 1, "E": 0, "S": 2, None: None}
    other = spark.createDataFrame([("S",), ("W",)], "wind_direction string")
    assert {r[0]: r[1] for r in encode.encode_labels(other, "wind_direction", mapping).collect()} == {"S": 2, "W": None}


def test_feature_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3, "N", "Summer")], "temperature double, humidity double, month int, wind_direction string, season string")
    assert rain_features(df).names == ["temperature", "humidity", "month", "wind_direction_encoded"]
    assert temperature_features(df).names == ["humidity", "month", "wind_direction_encoded", "season_encoded"]


def test_one_hot_and_scaling(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), (None, 5.0, 5.0)], "k string, v double, c double")
    rows = encode.one_hot(df, ["k"]).collect()
    assert [(r.k_a, r.k_b) for r in rows] == [(1, 0), (0, 1), (0, 0)]
    assert encode.one_hot(df, ["k"], {"k": ["b"]}).columns == ["v", "c", "k_b"]
    wide = spark.range(3000).selectExpr("concat('x', id) as k")
    assert len(encode.one_hot(wide, ["k"]).columns) == 3000
    sparse = encode.one_hot_vector(wide, ["k"])
    assert sparse.select("k_at").distinct().count() == 3000 and sparse.first().k_size == 3000
    known = {"k": encode.label_mapping(df, "k")}
    assert [(r.k_at, r.k_size) for r in encode.one_hot_vector(df, ["k"], known).orderBy("v").collect()] == [(0, 2), (1, 2), (None, 2)]
    scaled = encode.standardise(df, ["v", "c"]).collect()
    assert [r.v_scaled for r in scaled] == pytest.approx(((np.array([1, 3, 5]) - 3) / np.std([1, 3, 5])).tolist())
    assert {r.c_scaled for r in scaled} == {0.0}


def test_quality(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (float("nan"), 2.0, 1.0)], "temperature double, humidity double, pressure double")
    assert quality.completeness(df).first()[0] == pytest.approx(1 - 2 / 6)
    assert quality.completeness(df.limit(0)).first()[0] == 1.0
    assert quality.verdict(quality.null_counts(df)).first().verdict == "low_quality"
    assert quality.verdict(quality.null_counts(df.limit(0))).first().verdict == "no_data"
    report = quality.stage_report({"a": df, "b": df.limit(1)}, {"a": 2.0}).orderBy("step").collect()
    assert [(r.stage, r.records, r.seconds) for r in report] == [("a", 2, 2.0), ("b", 1, None)]


@pytest.mark.parametrize("block_rows", [1_000_000, 9])
def test_auc_equals_pair_count(spark, block_rows):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 40, 300) / 40
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1][:, None], s[y == 0][None, :]
    expected = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert metrics.auc(df, "label", "score", block_rows=block_rows).first().auc == pytest.approx(expected, abs=1e-12)


def test_reports(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)], "label int, prediction int")
    row = metrics.binary_report(df).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 2) and row.accuracy == pytest.approx(4 / 6)
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert report["1"].precision == pytest.approx(2 / 3) and report["0"].support == 3
    assert report["macro avg"].recall == pytest.approx(2 / 3) and report["weighted avg"].support == 6


def test_residual_moments(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 4.0, 9.0, 3.0]], "e double")
    row = metrics.residual_stats(df, "e").first()
    assert (row.skew, row.kurtosis) == (pytest.approx(1.5491, abs=1e-4), pytest.approx(2.6751, abs=1e-4))


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "actual double, prediction double")
    row = metrics.regression_metrics(df).first()
    assert row.mae == pytest.approx(0.5) and row.rmse == pytest.approx((1.25 / 3) ** 0.5)
    assert row.r2 == pytest.approx(1 - 1.25 / (3 * np.var([1, 2, 4])))


@pytest.mark.parametrize("block_rows", [1_000_000, 50])
def test_splits(spark, block_rows):
    df = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    parts = split.stratified_split(df, "label", "key", block_rows=block_rows)
    counts = {(r.label, r.is_test): r["count"] for r in parts.groupBy("label", "is_test").count().collect()}
    assert counts == {(0, False): 720, (0, True): 180, (1, False): 80, (1, True): 20}
    again = split.stratified_split(df.repartition(3), "label", "key", block_rows=block_rows)
    assert parts.filter("is_test").select("key").exceptAll(again.filter("is_test").select("key")).count() == 0
    folds = split.with_stratified_folds(df, "label", "key", block_rows=block_rows).groupBy("label", "fold").count()
    assert {r["count"] for r in folds.collect()} == {180, 20}
    assert 150 < split.plain_split(df, "key").filter("is_test").count() < 250


def test_tied_times_have_one_order(spark):
    rows = [(1, "2024-01-01", h // 2, float(h * 7 % 11), 20.0, 50.0, 1.0, 0.0) for h in range(24)]
    df = spark.createDataFrame(rows, "city_id long, date string, hour int, pressure double, temperature double, humidity double, wind_speed double, precipitation double")
    made = [sorted(map(str, engineer(df.repartition(n, "pressure"), block_rows=b).collect())) for n, b in ((1, 1000), (5, 1000), (3, 4))]
    assert made[0] == made[1] == made[2]
