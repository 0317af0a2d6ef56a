"""Trees against exhaustive search, forests against Spark's own models of them."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel, classification, regression
from pyspark.sql import functions as F

from isobar.plans import forests, models, trees


def table(n=600, seed=3, classes=False):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 8, (3, n)).astype(np.uint8)
    y = bins[0] * 3.0 - bins[1] * (bins[2] > 4) + rng.normal(size=n)
    return bins, (y > 10).astype(float) if classes else y


def blocks(bins, y, rows=100):
    return [(bins[:, k : k + rows], y[k : k + rows], None) for k in range(0, len(y), rows)]


def drawn(y, seed, number, rows=100):
    return np.concatenate([trees.draws(np.random.default_rng([seed, number, 0, k]), len(y[i : i + rows])) for k, i in enumerate(range(0, len(y), rows))])


def predict(nodes, bins):
    at = np.zeros(bins.shape[1], int)
    while (nodes["left"][at] >= 0).any():
        inner = nodes["left"][at] >= 0
        left = bins[nodes["feature"][at], np.arange(len(at))] <= nodes["bin"][at]
        at = np.where(inner, np.where(left, nodes["left"][at], nodes["right"][at]), at)
    return nodes["prediction"][at]


def exhaustive(bins, y, w, depth, rows, out):
    """Every border of every feature tried at every node."""
    mean = np.average(y[rows], weights=w[rows])
    spread = lambda r: (w[r] * (y[r] - np.average(y[r], weights=w[r])) ** 2).sum()
    best = (0, None)
    if depth and np.ptp(y[rows]) > 0:
        for column in bins:
            for border in range(7):
                left, right = rows[column[rows] <= border], rows[column[rows] > border]
                if len(left) and len(right):
                    best = max(best, (spread(rows) - spread(left) - spread(right), (left, right)), key=lambda b: b[0])
    if best[1] is None:
        out[rows] = mean
        return
    for part in best[1]:
        exhaustive(bins, y, w, depth - 1, part, out)


def test_draws_are_poisson_numbers():
    found = np.bincount(trees.draws(np.random.default_rng(1), 1_000_000)) / 1e6
    assert found[:5] == pytest.approx(np.exp(-1) / np.array([1, 1, 2, 6, 24]), rel=0.02) and 7 <= len(found) <= 12


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_trees_are_those_of_an_exhaustive_search(depth):
    bins, y = table()
    nodes = trees.tree(trees.Shape(3, 8, depth, 3, False), blocks(bins, y), 7, 2)
    w = drawn(y, 7, 2)
    rows, want = np.flatnonzero(w), np.zeros(len(y))
    exhaustive(bins, y, w, depth, rows, want)
    assert predict(nodes, bins)[rows] == pytest.approx(want[rows])
    leaf = nodes["left"] < 0
    assert nodes["count"][0] == w.sum() == nodes["count"][leaf].sum() and nodes["level"].max() <= depth
    assert all(c == nodes["count"][[a, b]].sum() for c, a, b in zip(nodes["count"][~leaf], nodes["left"][~leaf], nodes["right"][~leaf]))


@pytest.mark.parametrize("classes", [False, True])
def test_rows_in_a_file_and_counted_children_give_the_same_trees(monkeypatch, classes):
    bins, y = table(classes=classes)
    shape = trees.Shape(3, 8, 7, 3, classes)
    whole = trees.tree(shape, blocks(bins, y), 7, 0)
    rows = drawn(y, 7, 0) > 0  # borders that part the drawn rows alike are as good as each other
    assert len(whole["id"]) > 20
    for name, value in (("LOCAL_ROWS", 40), ("BLOCK_ROWS", 17), ("KEPT_BYTES", 0), ("CELLS", 1)):
        monkeypatch.setattr(trees, name, value)
        other = trees.tree(shape, blocks(bins, y), 7, 0)
        assert len(other["id"]) == len(whole["id"]) and predict(other, bins)[rows] == pytest.approx(predict(whole, bins)[rows])


def test_some_features_at_each_node(monkeypatch):
    bins, y = table(classes=True)
    shape = trees.Shape(3, 8, 6, 1, True)
    seen = [trees.tree(shape, blocks(bins, y), 7, k) for k in range(20)]
    assert {int(t["feature"][0]) for t in seen} == {0, 1, 2}
    share = np.mean([predict(t, bins) for t in seen], axis=0)
    assert ((share > 0.5) == (y > 0)).mean() > 0.9
    monkeypatch.setattr(trees, "LOCAL_ROWS", 40)
    share = np.mean([predict(trees.tree(shape, blocks(bins, y), 7, k), bins) for k in range(20)], axis=0)
    assert ((share > 0.5) == (y > 0)).mean() > 0.9


def test_borders_lie_between_values():
    rng = np.random.default_rng(0)
    assert forests._cuts(np.array([3.0, 1.0, 2.0]), np.array([5, 1, 1]), 32) == [1.5, 2.5]
    assert forests._cuts(np.array([4.0]), np.array([5]), 32) == []
    parts = [forests._summary(rng.normal(size=20_000)) for _ in range(3)]
    assert all(w.sum() == 20_000 and len(v) <= forests.POINTS for v, w in parts)
    cuts = forests._cuts(*map(np.concatenate, zip(*parts)), 32)
    rest = rng.normal(size=100_000)
    sizes = np.bincount(np.searchsorted(cuts, rest))
    assert len(cuts) == 31 and 0.8 < sizes.min() * 32 / len(rest) and sizes.max() * 32 / len(rest) < 1.2


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(0, 2000, 1, 4).selectExpr("id", "cast(id % 7 as double) as humidity", "cast(id % 53 as double) as pressure", "cast(id * id % 11 as double) as wind_speed")
    return made.selectExpr("*", "humidity * 2 + pressure - wind_speed as temperature", "int(humidity > 3 and pressure > 20) as rain_flag").localCheckpoint()


def jobs(spark, group, work):
    """Jobs that ``work`` starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_deep_temperature_forests_take_no_pass_for_each_level(spark, rows):
    features = models.temperature_features(rows)

    def train(depth):
        return lambda: models.fit(models.scaled(features, models.temperature_forest(trees=5, depth=depth)), features, rows, "temperature", partitions=4)

    assert jobs(spark, "shallow", train(3)) == jobs(spark, "deep", train(12))


def test_temperature_forest_scores_as_the_model_saved_by_it(spark, rows, tmp_path):
    model, scored = models.train_temperature(rows, "id", partitions=4)
    got = {r.id: r.prediction for r in scored.collect()}
    error = scored.agg(F.avg(F.abs(F.col("prediction") - F.col("temperature")))).first()[0]
    assert error < 3 and 0 < len(got) < 2000
    assert model.pipeline.stages[-1]._whole is None  # not needed so far
    importance = model.importance().collect()
    assert importance[0].feature == "pressure" and sum(r.importance for r in importance) == pytest.approx(1)
    model.save(str(tmp_path / "m"))
    loaded = models.load(spark, str(tmp_path / "m"))[0]
    assert type(loaded.pipeline.stages[-1]) is regression.RandomForestRegressionModel
    again = {r.id: r.prediction for r in loaded.score(rows).collect()}
    assert got == pytest.approx({k: again[k] for k in got}, rel=1e-12)
    assert len(loaded.pipeline.stages[-1].trees) == 100 and len(model.pipeline.stages[-1].trees) == 100


def test_temperature_forest_is_as_good_as_sparks(rows):
    features = models.temperature_features(rows)
    own = models.temperature_forest(trees=20, depth=8)
    plain = regression.RandomForestRegressor(labelCol="temperature", numTrees=20, maxDepth=8, featureSubsetStrategy="all", seed=42)
    errors = []
    for learner in (own, plain):
        model = models.fit(models.scaled(features, learner), features, rows.filter("id % 5 != 0"), "temperature", partitions=4)
        held = model.score(rows.filter("id % 5 = 0"))
        errors.append(held.agg(F.avg(F.abs(F.col("prediction") - F.col("temperature")))).first()[0])
    assert errors[0] < 1.1 * errors[1]


def test_labels_must_be_known(rows):
    features = models.temperature_features(rows)
    bad = rows.withColumn("temperature", F.when(F.col("id") != 5, F.col("temperature")))
    with pytest.raises(Exception, match="must not be null"):
        models.fit(models.scaled(features, models.temperature_forest(trees=2, depth=2)), features, bad, "temperature", partitions=4)


def test_other_settings_are_left_to_spark(rows):
    features = models.temperature_features(rows)
    learner = models.temperature_forest(trees=2, depth=2).setMinInstancesPerNode(20)
    model = models.fit(models.scaled(features, learner), features, rows, "temperature", partitions=4)
    assert type(model.pipeline.stages[-1]) is regression.RandomForestRegressionModel
    assert isinstance(model.pipeline, PipelineModel)


def test_cross_validation_deletes_the_node_tables_of_its_folds(spark, rows, monkeypatch):
    gone, forget = [], models.forget
    monkeypatch.setattr(models, "forget", lambda model: gone.append(model.stages[-1]) or forget(model))
    learner = models.temperature_forest(trees=3, depth=4)
    row = models.temperature_cross_validation(rows, models.temperature_features(rows), "id", folds=3, learner=learner).first()
    assert 0 < row.cv_mean < 5 and row.cv_std >= 0 and len(gone) == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        gone[0]._saved.arrays(spark)


def test_rain_forests_take_no_pass_for_each_level(spark, rows):
    features = models.rain_features(rows)

    def train(depth):
        return lambda: models.fit(models.scaled(features, models.rain_forest(trees=5, depth=depth)), features, rows, "rain_flag", partitions=4)

    assert jobs(spark, "low", train(2)) == jobs(spark, "high", train(6))


def test_rain_forest_is_sparks_model_of_the_grown_trees(rows):
    features = models.rain_features(rows)
    model = models.fit(models.scaled(features, models.rain_forest(trees=20, depth=6)), features, rows, "rain_flag", partitions=4)
    forest = model.pipeline.stages[-1]
    assert type(forest) is classification.RandomForestClassificationModel and forest.getNumTrees == 20 and forest.numClasses == 2
    report = models.classifier_report(model.score(rows), "rain_flag").first()
    assert report.auc > 0.99 and report.accuracy > 0.95 and sum(forest.featureImportances) == pytest.approx(1)


def test_labels_of_one_class_are_left_to_spark(rows):
    features = models.rain_features(rows)
    dry = rows.filter("rain_flag = 0")
    model = models.fit(models.scaled(features, models.rain_forest(trees=2, depth=2)), features, dry, "rain_flag", partitions=4)
    plain = classification.RandomForestClassifier(labelCol="rain_flag", numTrees=2, maxDepth=2, seed=42)
    assert model.pipeline.stages[-1].numClasses == models.fit(models.scaled(features, plain), features, dry, "rain_flag", partitions=4).pipeline.stages[-1].numClasses
