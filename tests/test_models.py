"""Forests on seeded random weather, forecasts against numpy, and the stream against the batch."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isobar import schema
from isobar.operators import hourly, leastsquares
from isobar.operators.leastsquares import least_squares
from isobar.operators.quality import StageCounts
from isobar.plans import models
from isobar.plans.forecast import Forecaster, Orders, _psi, _recur, as_single_series, single_series
from isobar.plans.runs import train_and_forecast
from isobar.staging import stage
from isobar.streaming import hourly as streaming


@pytest.fixture(scope="module")
def weather(spark):
    rng = np.random.default_rng(42)
    n = 1000
    frame = pd.DataFrame(
        {
            "id": range(n),
            "temperature": rng.normal(25, 5, n),
            "humidity": rng.normal(65, 15, n),
            "pressure": rng.normal(1013, 10, n),
            "wind_speed": rng.exponential(8, n),
            "hour": rng.integers(0, 24, n),
            "wind_direction": rng.choice(list("NESW"), n),
        }
    )
    frame["rain_flag"] = (frame["humidity"] + rng.normal(0, 10, n) > 72).astype(int)
    return spark.createDataFrame([tuple(map(lambda v: v.item() if hasattr(v, "item") else v, r)) for r in frame.itertuples(index=False)], list(frame.columns))


def small(features):
    return models.scaled(features, models.rain_forest(trees=10, depth=4))


def test_rain_model(spark, weather, tmp_path):
    features = models.rain_features(weather)
    model = models.fit(small(features), features, weather, "rain_flag")
    scored = model.score(weather)
    report = models.classifier_report(scored, "rain_flag").first()
    assert 0.5 < report.auc < 1 and {r[0] for r in scored.select("prediction").distinct().collect()} == {0, 1}
    low, high = scored.agg(F.min("probability"), F.max("probability")).first()
    assert 0 <= low <= high <= 1
    importance = model.importance().collect()
    assert importance[0].feature == "humidity" and sum(r.importance for r in importance) == pytest.approx(1)
    model.save(str(tmp_path / "m"), models.classifier_report(scored, "rain_flag"))
    loaded, meta = models.load(spark, str(tmp_path / "m"))
    again = loaded.score(weather)
    assert scored.select("id", "probability").exceptAll(again.select("id", "probability")).count() == 0
    row = meta.first()
    assert row.version == "1.0.0" and json.loads(row.metrics)["auc"] == pytest.approx(report.auc)


def test_models_train_and_score_in_a_session_that_has_observed_rows(spark, weather, tmp_path):
    counts = StageCounts()
    counts.watch(spark.range(5), "five").write.parquet(str(tmp_path / "five"))
    assert counts.records("five") == 5
    features = models.rain_features(weather)
    model = models.fit(small(features), features, weather, "rain_flag")
    assert model.score(weather).filter("probability is not null").count() == weather.count()
    learner = models.rain_forest(trees=3, depth=2)
    assert 0 < models.rain_cross_validation(weather, features, "id", folds=2, learner=learner).first().cv_mean <= 1


def test_cross_validation(weather):
    features = models.rain_features(weather)
    row = models.rain_cross_validation(weather, features, "id", folds=3, learner=models.rain_forest(trees=5, depth=3)).first()
    assert 0.5 < row.cv_mean < 1 and row.cv_std >= 0


def test_cross_validation_trains_once_for_each_fold(spark, weather, monkeypatch):
    fitted, fit = [], models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, rows, *more: fitted.append(rows.count()) or fit(self, rows, *more))
    learner = models.rain_forest(trees=2, depth=2)
    models.rain_cross_validation(weather, models.rain_features(weather), "id", folds=3, learner=learner)
    assert len(fitted) == 3 and sum(fitted) == 2 * weather.count()
    marked = weather.withColumn("fold", F.lit(0))
    with pytest.raises(ValueError, match="folds"):
        models.cross_validate(models.scaled(models.rain_features(weather), learner), marked, None, folds=2)


def test_batch_scoring(spark, weather):
    features = models.rain_features(weather)
    model = models.fit(small(features), features, weather, "rain_flag")
    now = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    readings = weather.withColumn("recorded_at", now - F.expr("make_dt_interval(0, 0, id)"))
    made = spark.sql("SELECT 3L AS weather_data_id, timestamp_ntz'2024-01-01 11:50:00' AS predicted_at")
    out = models.score_unscored(readings, made, model, now)
    assert sorted(r.weather_data_id for r in out.collect()) == [i for i in range(61) if i != 3]
    assert out.schema.simpleString() == schema.PREDICTION.simpleString()
    unknown = spark.sql("SELECT CAST(NULL AS BIGINT) AS weather_data_id, timestamp_ntz'2024-01-01 11:50:00' AS predicted_at")
    assert models.score_unscored(readings, unknown, model, now).count() == 0


def test_logit_penalty(spark):
    """The penalised fit is the minimum of the summed loss plus half the squared weights."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = (x[:, 0] + rng.normal(size=200) > 0).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, rain_flag int")
    features = models.Features(["a", "b"])
    fitted = models.rain_logit(features, 200).fit(df).stages[-1]
    w = np.array([*fitted.coefficients, fitted.intercept])
    p = 1 / (1 + np.exp(-(x @ w[:2] + w[2])))
    gradient = np.append(x.T @ (p - y) + w[:2], (p - y).sum())
    assert np.abs(gradient).max() < 0.05


# ---- least squares and forecasts ---------------------------------------------


def test_sparse_one_hot_is_kept_with_the_model(spark, tmp_path):
    rows = [(i, ["N", "E", "S", None][i % 4], float(i % 7), int(i % 4 == 1 or i % 11 == 0)) for i in range(400)]
    train = spark.createDataFrame(rows, "row int, wind string, speed double, rain_flag int")
    chosen = models.Features.fit(train, ["speed"], levels=["wind"])
    model = models.fit(models.rain_logit(chosen, 400), chosen, train, "rain_flag")
    weights = model.pipeline.stages[-1].coefficients.toArray()
    assert len(weights) == 1 + 4  # E, N, S, and a place for the rest
    assert weights[1] == max(weights[1:])
    fresh = spark.createDataFrame([(0, "E", 1.0), (1, "W", 1.0), (2, None, 1.0)], "row int, wind string, speed double")
    before = {r.row: r.probability for r in model.score(fresh).collect()}
    assert before[0] > 0.9 and before[1] == before[2]
    assert set(model.score(fresh).columns) == {"row", "wind", "speed", "probability", "prediction"}
    model.save(str(tmp_path / "m"))
    loaded, meta = models.load(spark, str(tmp_path / "m"))
    assert meta.first().levels == ["wind"]
    assert {r.row: r.probability for r in loaded.score(fresh).collect()} == before


def test_unclustered_keys_give_one_row_per_key_and_task(spark):
    rows = spark.range(0, 20_000, 1, 4).selectExpr("id % 5000 as k", "array(cast(id % 7 as double), cast(id % 11 as double)) as x", "cast(id % 13 as double) as y")
    parts = leastsquares.moments(rows, ["k"], "x", "y", 2)
    assert parts.count() <= 5000 * 4
    assert leastsquares.least_squares(rows, ["k"], "x", "y", 2, constant=True).count() == 5000


def test_merging_is_exact_and_does_not_cancel():
    rng = np.random.default_rng(2)
    z = np.column_stack([rng.normal(size=5000), rng.normal(size=5000)])
    z[:, 1] = 1e9 + 2 * z[:, 0] + 1e-3 * z[:, 1]  # far from zero, tiny errors
    whole = leastsquares.Moments.of(z[:7])
    for at in range(7, 5000, 613):
        whole = whole + leastsquares.Moments.of(z[at : at + 613])
    read = leastsquares.Moments.read(whole.row(), 2)
    fit = leastsquares.solve_from(read, True)
    slope, intercept = np.polyfit(z[:, 0], z[:, 1] - 1e9, 1)
    assert fit["coefficients"] == pytest.approx([slope, intercept + 1e9])
    assert fit["sigma2"] == pytest.approx(1e-6, rel=0.1) and fit["aic"] is not None


def test_too_few_rows_are_flagged_not_refitted(spark):
    rows = spark.createDataFrame([("short", [1.0, 2.0], 3.0)] * 2 + [("long", [float(i), float(i * i)], float(i)) for i in range(9)], "k string, x array<double>, y double")
    got = {r.k: r for r in least_squares(rows, ["k"], "x", "y", 2, constant=True).collect()}
    assert got["short"].coefficients is None and got["short"].n_obs == 2 and len(got["long"].coefficients) == 3


def test_forests_do_not_depend_on_the_partitions(weather):
    features = models.rain_features(weather)
    scores = []
    for parts in (1, 2, 8):
        model = models.fit(small(features), features, weather.repartition(parts), "rain_flag")
        scores.append({r.id: r.probability for r in model.score(weather).select("id", "probability").collect()})
    assert scores[0] == scores[1] == scores[2]


def test_forests_keep_the_node_of_each_row(weather):
    """Passes don't walk the trees from their roots, and the trees are those of a forest that does."""
    assert models.rain_forest().getCacheNodeIds() and models.temperature_forest().getCacheNodeIds()
    features, seen = models.rain_features(weather), []
    for learner in (models.rain_forest(trees=10, depth=4), models.rain_forest(trees=10, depth=4).setCacheNodeIds(False)):
        model = models.fit(models.scaled(features, learner), features, weather, "rain_flag")
        seen.append([t.toDebugString.split("\n", 1)[1] for t in model.pipeline.stages[-1].trees])
    assert seen[0] == seen[1] and len(seen[0]) == 10


def test_training_tables_spread_with_their_rows(spark, weather, monkeypatch):
    assert [models.partitions_of(n) for n in (0, 400_000, 400_001, 10_000_000)] == [4, 4, 5, 100]
    same = spark.range(5000).select(F.lit(1.0).alias("x"), F.lit(None).cast("int").alias("y"))
    placed = models.spread(same.unionByName(spark.createDataFrame([(2.0, 3)], same.schema)), 8)
    assert placed.count() == 5001 and placed.filter("x = 2.0 and y = 3").count() == 1
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) <= 4001  # lots of a thousand, wherever they fall
    monkeypatch.setattr(models, "PARTITION_ROWS", 100)
    assert models.spread(same).rdd.getNumPartitions() == 50


def test_deep_forests_take_fewer_partitions(spark, weather, monkeypatch):
    asked, spread = [], models.spread
    monkeypatch.setattr(models, "PARTITION_ROWS", 10)
    monkeypatch.setattr(models, "DEEP_PARTITION_ROWS", 100)
    monkeypatch.setattr(models, "temperature_forest", lambda label: models.RandomForestRegressor(labelCol=label, numTrees=1, maxDepth=1))
    monkeypatch.setattr(models, "spread", lambda *how: asked.append(spread(*how).rdd.getNumPartitions()) or spread(*how))
    models.train_temperature(weather, "id")
    models.temperature_cross_validation(weather, models.temperature_features(weather), "id", folds=2)
    assert asked[0] <= 10 and asked[1] == 10


def test_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x, key = rng.normal(size=(500, 3)), rng.choice(["a", "b"], 500)
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=500)
    df = spark.createDataFrame([(k, r.tolist(), float(v)) for k, r, v in zip(key, x, y)], "k string, x array<double>, y double").repartition(6)
    for row in least_squares(df, ["k"], "x", "y", 3, constant=True).collect():
        z = np.column_stack([x, np.ones(500)])[key == row.k]
        expected, sse = np.linalg.lstsq(z, y[key == row.k], rcond=None)[:2]
        assert np.allclose(row.coefficients, expected) and row.sigma2 == pytest.approx(sse[0] / len(z))


def test_collinear_columns(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(300, 3))
    x = np.column_stack([a, a.mean(axis=1)])
    y = a @ [1.0, 2.0, 3.0] + rng.normal(size=300)
    df = spark.createDataFrame([("k", r.tolist(), float(v)) for r, v in zip(x, y)], "k string, x array<double>, y double")
    row = least_squares(df, ["k"], "x", "y", 4).first()
    # Which of the equally good solutions is a matter of scaling; the fitted values are not.
    assert np.allclose(x @ row.coefficients, x @ np.linalg.lstsq(x, y, rcond=1e-9)[0], atol=1e-6)


HOURS = 420


@pytest.fixture(scope="module")
def cities(spark):
    rng = np.random.default_rng(9)
    rows = []
    for city, level in (("a", 20.0), ("b", 5.0)):
        noise, t = 0.0, np.arange(HOURS)
        for i in t:
            noise = 0.7 * noise + rng.normal(0, 0.5)
            rows.append((city, int(i), float(level + 4 * np.sin(2 * np.pi * i / 24) + noise), float(rng.normal(60, 5))))
    rows += [("short", i, 1.0, 1.0) for i in range(150)]
    df = spark.createDataFrame(rows, "city string, h int, temperature double, humidity double")
    return df.withColumn("observed_at", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h)")).drop("h")


def run(cities, block_rows):
    spec = Forecaster(["city"], ["observed_at"], exog=("humidity",), exog_lags=2, block_rows=block_rows)
    rows = stage(spec.split(spec.prepare(cities)), "test")
    fitted = spec.fit(rows)
    final = spec.fit(rows.drop("is_train"))
    order = ["city", "observed_at"]
    return {
        "evaluation": spec.evaluate(fitted).orderBy("city").toPandas(),
        "predictions": spec.test_predictions(fitted).orderBy(*order).toPandas(),
        "forecast": spec.forecast(final, 24).orderBy("city", "step").toPandas(),
        "diagnostics": spec.diagnostics(fitted).orderBy("city").drop("params", "pvalues").toPandas(),
    }


@pytest.fixture(scope="module")
def whole(cities):
    return run(cities, 1_000_000)


def test_forecasts_follow_the_day(whole):
    evaluation, forecast = whole["evaluation"], whole["forecast"]
    assert list(evaluation["city"]) == ["a", "b"]  # the short series is left out
    assert (evaluation["mae"] < 2.0).all() and (evaluation["r2"] > 0.4).all()
    n = HOURS - 6
    assert set(evaluation["train_size"]) == {int(0.8 * n)} and set(evaluation["test_size"]) == {n - int(0.8 * n)}
    assert len(forecast) == 48 and (forecast["lower"] < forecast["prediction"]).all()
    width = forecast[forecast["city"] == "a"].eval("upper - lower").to_numpy()
    assert (np.diff(width) >= 0).all()
    truth = 20 + 4 * np.sin(2 * np.pi * (HOURS + np.arange(24)) / 24)
    assert np.abs(forecast[forecast["city"] == "a"]["prediction"].to_numpy() - truth).mean() < 1.5
    assert (whole["diagnostics"]["resid_std"] < 1.0).all()


def test_blocks_change_nothing(cities, whole):
    """Series cut into blocks (halo, chained recurrence) give the same models and forecasts."""
    cut = run(cities, 90)
    for name, frame in whole.items():
        pd.testing.assert_frame_equal(cut[name], frame, rtol=1e-6, atol=1e-6)


def test_one_step_equals_numpy(spark, cities):
    """(2,1,0) with no season: the fit is plain least squares on lagged differences."""
    spec = Forecaster(["city"], ["observed_at"], orders=Orders((2, 1, 0), (0, 0, 0, 0)))
    fit = spec.fit(cities.filter("city = 'a'")).no_exog.first()
    y = np.array([r.temperature for r in cities.filter("city = 'a'").orderBy("observed_at").collect()])
    w = np.diff(y)
    x = np.column_stack([w[1:-1], w[:-2]])
    assert np.allclose(fit.coefficients, np.linalg.lstsq(x, w[2:], rcond=None)[0])
    assert spec.parameter_names(False) == ["ar.L1", "ar.L2"]


@pytest.fixture(scope="module")
def moving(spark):
    """Forty series w_t = 3 + e_t + 0.8 e_{t-1}."""
    rng = np.random.default_rng(12)
    rows = []
    for c in range(40):
        e = rng.normal(size=401)
        rows += [(c, t, float(3 + e[t + 1] + 0.8 * e[t])) for t in range(400)]
    return stage(spark.createDataFrame(rows, "city int, at int, temperature double"), "moving")


def moving_spec(refine, block_rows=1_000_000):
    return Forecaster(["city"], ["at"], orders=Orders((0, 0, 1), (0, 0, 0, 0), constant=True, long=1), refine=refine, block_rows=block_rows)


def test_another_regression_brings_the_ma_term_nearer(moving):
    errors = {}
    for refine in (0, 1, 2):
        beta = [r.coefficients[0] for r in moving_spec(refine).fit(moving).no_exog.collect()]
        errors[refine] = abs(np.mean(beta) - 0.8), np.sqrt(np.mean((np.array(beta) - 0.8) ** 2))
    assert errors[1][0] < errors[0][0] and errors[1][1] < errors[0][1]
    assert errors[2][1] < errors[0][1]


def test_own_errors_in_blocks(moving):
    few = moving.filter("city < 3")
    fits = [{r.city: r for r in moving_spec(1, rows).fit(few).no_exog.collect()} for rows in (1_000_000, 60)]
    for city, row in fits[0].items():
        assert row.coefficients == pytest.approx(fits[1][city].coefficients, rel=1e-9)
    scores = []
    for rows in (1_000_000, 60):
        spec = moving_spec(1, rows)
        fitted = spec.fit(stage(spec.split(few), "split"))
        scores.append(sorted((r.city, round(r.rmse, 9)) for r in spec.evaluate(fitted).collect()))
        assert spec.residuals(fitted).count() == 3 * 320
    assert scores[0] == scores[1]


def test_ma_parts_are_kept_invertible():
    o = Orders((1, 0, 1), (0, 0, 1, 4))
    assert o.error_recurrence([0.5, 0.4, 0.2, 0.1]).tolist() == [-0.4, 0.0, 0.0, -0.2, -0.1]
    shrunk = o.error_recurrence([0.5, 3.0, 2.0, -4.0])
    assert np.abs(np.roots(np.concatenate(([1.0], -shrunk))[::-1])).min() >= 1.02 - 1e-9
    assert np.flatnonzero(shrunk).tolist() == [0, 3, 4]


def test_psi_weights():
    walk = Orders((0, 1, 0), (0, 0, 0, 0))
    assert _psi(walk.recurrence(np.array([])), {}, 4).tolist() == [1, 1, 1, 1]
    ar = Orders((1, 0, 1), (0, 0, 0, 0))
    assert np.allclose(_psi(ar.recurrence(np.array([0.5])), {1: 0.3}, 4), [1, 0.8, 0.4, 0.2])
    assert Orders().ar == [1, 2, 24, 25, 26] and Orders().ma == [1, 24, 25]


def test_long_paths_in_pieces_equal_one_run():
    rng = np.random.default_rng(4)
    for a in (np.array([0.5, 0.2, -0.1]), np.array([1.0]), np.zeros(0)):
        state, drive = rng.normal(size=len(a)), rng.normal(size=1003)
        plain = list(state)
        for u in drive:
            plain.append(sum(c * plain[-1 - i] for i, c in enumerate(a)) + u)
        for width in (None, 7, 400, 2000):
            assert _recur(a, state, drive, width=width) == pytest.approx(plain[len(a) :])


def test_future_buffer(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(7)], "city string, at int, v double")
    spec = Forecaster(["city"], ["at"], exog=("v",), exog_lags=2)
    rows = spec.future_exog(df, 7).orderBy("step").collect()
    assert [(r.v_lag_1, r.v_lag_2) for r in rows] == [(6, 5), (5, 4), (4, 3), (3, 2), (2, 1), (1, 6), (6, 6)]
    assert {(r.v_ma_3, r.v_ma_6) for r in rows} == {(5.0, 3.5)}
    held = spec.future_exog(df, 3, mode="hold_last").orderBy("step").collect()
    assert [(r.v_lag_1, r.v_lag_2) for r in held] == [(6, 5), (6, 6), (6, 6)]
    short = spec.future_exog(df.filter("at > 2"), 1).first()
    assert short.v_ma_3 == 5.0 and short.v_ma_6 is None
    gap = spec.future_exog(df.withColumn("v", F.when(F.col("at") != 5, F.col("v"))), 4).orderBy("step").collect()
    assert [r.v_lag_2 for r in gap] == [4, 4, 3, 2]  # unknown at first: the next step's value


def test_short_buffer_falls_back(spark, cities):
    spec = Forecaster(["city"], ["observed_at"], exog=("humidity",), orders=Orders((1, 1, 0), (0, 0, 0, 0)))
    fitted = spec.fit(spec.prepare(cities))
    future = spec.future_exog(fitted.rows, 3).withColumn("humidity_ma_6", F.lit(None).cast("double"))
    assert {r.model_used for r in spec.forecast(fitted, 3, future=future).collect()} == {"no_exog"}


def test_saved_forecaster(spark, cities, tmp_path):
    spec = Forecaster(["city"], ["observed_at"], exog=("humidity",), orders=Orders((1, 1, 1), (0, 0, 0, 0)))
    fitted = spec.fit(spec.prepare(cities))
    spec.save(fitted, str(tmp_path / "f"))
    names = {r[0] for r in spark.read.parquet(str(tmp_path / "f/exog")).select("model_name").collect()}
    assert names == {"temp_model_exog_a", "temp_model_exog_b"}
    blank = Forecaster(["city"], ["observed_at"])
    loaded = blank.load(spark, str(tmp_path / "f"), fitted.rows)
    a = loaded.spec.forecast(loaded, 5).orderBy("city", "step").toPandas()
    pd.testing.assert_frame_equal(a, spec.forecast(fitted, 5).orderBy("city", "step").toPandas())


def test_single_series(cities):
    one = as_single_series(cities.filter("city = 'a'"))
    spec = single_series(["observed_at"], exog=("humidity",))
    row = spec.evaluate(spec.fit(spec.split(one))).first()
    assert row.series == "all" and row.exog_features == 1 and row.mae < 10


def test_train_and_forecast(cities):
    spec = Forecaster(["city"], ["observed_at"], orders=Orders((1, 1, 0), (0, 1, 0, 24)))
    out = train_and_forecast(cities, spec, first=1, steps=5)
    assert [(r.city, r.predictions_count) for r in out["summary"].collect()] == [("a", 5)]
    assert out["mean_metrics"].first().avg_mae > 0
    none = train_and_forecast(cities, spec, keys=["nowhere"])
    assert none["evaluation"].count() == 0


# ---- stream ------------------------------------------------------------------


def test_stream_equals_batch_on_closed_hours(spark, tmp_path):
    def doc(dt, lon, temp):
        return json.dumps({"dt": dt, "coord": {"lon": lon, "lat": 0.0}, "main": {"temp": temp}})

    source = tmp_path / "in"
    source.mkdir()
    base = 1_700_006_400  # midnight
    city = spark.createDataFrame([(1, "Alpha", 1, 1.0, 0.0), (2, "Beta", 1, 2.0, 0.0)], schema.CITY)
    target, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")

    def drain():
        docs = streaming.document_stream(spark, str(source), files_per_trigger=1)
        streaming.write_periods(streaming.hourly_stream(docs, city), target, offsets).awaitTermination()

    (source / "0.json").write_text("\n".join(doc(base + 60 * i, 1.0 + i % 2, float(i)) for i in range(90)))
    drain()
    # A repeated reading, late ones within the hour allowed, and the hours that close the first ones.
    second = [doc(base + 60, 2.0, 1.0), doc(base + 3600 + 61, 1.0, 50.0)]
    second += [doc(base + 3600 * h, 1.0, 7.0) for h in (2, 3, 4)]
    (source / "1.json").write_text("\n".join(second))
    drain()
    got = spark.read.parquet(target).groupBy("Date", "Hour", "idCity").agg(
        F.sum("measurement_count").alias("n"), F.max("Temp").alias("temp"), F.count("*").alias("rows")
    )
    everything = hourly.flatten(spark.read.schema(schema.DOCUMENT).json(str(source))).dropDuplicates(["lon", "dt"])
    fact = hourly.hourly_fact(hourly.with_city(hourly.coordinate_means(everything, bucket="1 hour"), city))
    closed = fact.filter(F.col("Hour") <= 2)
    expected = sorted((str(r.Date), r.Hour, r.idCity, r.measurement_count, r.Temp) for r in closed.collect())
    assert sorted((str(r.Date), r.Hour, r.idCity, r.n, r.temp) for r in got.collect()) == expected
    assert {r.rows for r in got.collect()} == {1}


def test_late_rows_are_counted_and_other_rows_stay(spark, tmp_path):
    def doc(dt, lon, temp=1.0):
        return json.dumps({"dt": dt, "coord": {"lon": lon, "lat": 0.0}, "main": {"temp": temp}})

    base, source = 1_700_006_400, tmp_path / "in"
    source.mkdir()
    city = spark.createDataFrame([(1, "Alpha", 1, 1.0, 0.0), (2, "Beta", 1, 2.0, 0.0)], schema.CITY)
    target, counters = str(tmp_path / "out"), str(tmp_path / "counters")

    def drain(offsets):
        rows = streaming.hourly_stream(streaming.document_stream(spark, str(source)), city)
        return streaming.drain(rows, target, str(tmp_path / offsets), counters)

    (source / "0.json").write_text("\n".join([doc(base, 1.0), doc(base + 60, 2.0), doc(base + 5 * 3600, 1.0)]))
    assert drain("a").agg(F.sum("rows_read"), F.sum("rows_late")).first()[:] == (3, 0)
    (source / "1.json").write_text("\n".join([doc(base + 120, 1.0), doc(base + 4 * 3600, 1.0), doc(base + 4 * 3600 + 1, 1.0)]))
    assert drain("a").agg(F.sum("rows_read"), F.sum("rows_late")).first()[:] == (3, 2)
    stored = spark.read.parquet(counters)
    assert stored.select("run").distinct().count() == 2 and stored.agg(F.sum("rows_late")).first()[0] == 2
    # A stream from scratch over one city's documents replaces that city's rows and leaves the other's.
    before = {(r.idCity, r.Hour) for r in spark.read.parquet(target).collect()}
    assert {(1, 0), (2, 0)} <= before
    (source / "0.json").write_text("\n".join([doc(base, 1.0, 9.0), doc(base + 5 * 3600, 1.0)]))
    (source / "1.json").unlink()
    drain("b")
    after = {(r.idCity, r.Hour): r.Temp for r in spark.read.parquet(target).collect()}
    assert before <= after.keys() and after[1, 0] == 9.0 and after[2, 0] == 1.0


def test_stream_sorts_its_means_and_stores_them_adaptively(spark, tmp_path, monkeypatch, capsys):
    """A batch without documents emits hours too: they are not broadcast as empty, and rows are gathered before they are stored."""
    def doc(dt, lon):
        return json.dumps({"dt": dt, "coord": {"lon": lon, "lat": 0.0}, "main": {"temp": 1.0}})

    base, source, seen = 1_700_006_400, tmp_path / "in", []
    source.mkdir()
    (source / "0.json").write_text("\n".join([doc(base, 1.0), doc(base + 60, 2.0), doc(base + 5 * 3600, 1.0)]))
    city = spark.createDataFrame([(1, "Alpha", 1, 1.0, 0.0), (2, "Beta", 1, 2.0, 0.0)], schema.CITY)
    store = streaming.replace_rows
    monkeypatch.setattr(streaming, "replace_rows", lambda rows, *how: seen.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled")) or store(rows, *how))
    rows = streaming.hourly_stream(streaming.document_stream(spark, str(source)), city)
    query = streaming.write_periods(rows, str(tmp_path / "out"), str(tmp_path / "offsets"))
    query.awaitTermination()
    assert query.lastProgress.numInputRows == 0 and spark.read.parquet(str(tmp_path / "out")).count() == 2
    capsys.readouterr()
    query.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert seen == ["true"]
