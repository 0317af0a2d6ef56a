import zlib

import numpy as np
from pyspark.sql import functions as F

from isobar.llm import classifier
from isobar.staging import stage
from isobar.llm.queries import QUERIES

from .helpers import documents

MEDIUM = "/root/testdata/sf0.01"


def test_query_scores_every_row_and_holds_out(spark):
    rows = QUERIES["op4_quality"](spark, MEDIUM).collect()
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (classifier.quality_model(docs, x) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.levels, b.levels)


def test_fit_solves_the_ridge_equations(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(200)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", F.col("quality").alias("y"))
    kernel = classifier.Kernel(features=32)
    model = classifier.fit(docs, labels, kernel)
    joined = docs.join(labels, "doc_id").select("text", "y").collect()
    stats, y = classifier.table([r.text for r in joined]), np.array([r.y for r in joined])
    scale = stats.std(0)
    z = classifier.lifted(stats, stats.mean(0), np.where(scale > 1e-9, scale, 1), kernel)
    wanted = np.linalg.solve(z.T @ z + kernel.ridge * len(y) * np.eye(32), z.T @ (y - y.mean()))
    assert np.allclose(model.weights, wanted, atol=1e-5)
    assert np.all(np.diff(model.levels) >= 0)


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(0)
    for _ in range(30):
        x, y = rng.integers(0, 8, 12).astype(float), rng.integers(0, 2, 12).astype(float)
        knots, levels = classifier.isotonic(x, y)
        got = np.interp(x, knots, levels)
        # min-max formula of isotonic regression
        points = np.unique(x)
        for p in points:
            best = max(min(y[(x >= a) & (x <= b)].mean() for b in points[points >= p]) for a in points[points <= p])
            assert np.isclose(got[x == p][0], best)


def test_odd_rows_and_missing_labels(spark):
    frame = documents(spark, more="stats y score row")
    frame = frame.unionByName(frame)
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (3, None, 0), (None, 1, 1), (99, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    model = classifier.quality_model(frame, labels)
    rows = frame.select("doc_id", classifier.score(model, F.col("text")).alias("s")).collect()
    assert len(rows) == 22 and all(0 <= r.s <= 1 for r in rows)
    assert classifier.quality_model(frame, labels.limit(0)) is None
    assert {r.s for r in frame.select(classifier.score(None, F.col("text")).alias("s")).collect()} == {1.0}
    empty = documents(spark, [])
    assert classifier.quality_model(empty, labels) is None
    assert empty.select(classifier.score(model, F.col("text"))).count() == 0
    constant = spark.createDataFrame([(5, 1)], "doc_id long, quality int")
    one = classifier.quality_model(frame, constant)
    assert all(r.s == 1 for r in frame.select(classifier.score(one, F.col("text")).alias("s")).collect())


def test_repeated_rows_of_a_labelled_key_weigh_as_one(spark):
    docs = stage(spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(60).select("doc_id", "text"), "some")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", F.col("quality").alias("y"))
    kernel = classifier.Kernel(features=32)
    hot = stage(docs.join(labels, "doc_id").orderBy("doc_id").limit(1).select("doc_id", "text"), "hot")
    copies = hot.crossJoin(spark.range(200)).drop("id")
    a, b = classifier.fit(docs, labels, kernel), classifier.fit(docs.unionByName(copies), labels, kernel)
    assert np.allclose(a.weights, b.weights, atol=1e-9) and np.allclose(a.mean, b.mean) and np.array_equal(a.levels, b.levels)
    # Different texts of one key share its weight.
    other = copies.select("doc_id", F.concat(F.lit("word "), F.uuid()).alias("text"))
    mixed = classifier.fit(docs.unionByName(other), labels, kernel)
    assert np.isclose(mixed.bias, a.bias) and len(mixed.knots) <= 60 + classifier.TEXTS_PER_KEY
