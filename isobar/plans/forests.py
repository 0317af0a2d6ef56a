"""Spark's random forests with training that sends rows to trees instead of statistics of every node through a shuffle.

Features are binned once and kept as blocks of bytes.  Every task gets a copy of
the blocks and grows some of the trees (``isobar.plans.trees``); node tables are
written the way Spark saves a forest and loaded as Spark's own model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel, classification, regression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Params
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.plans import trees
from isobar.staging import discard, new_path, remove, stage

#: Values of a column that are summed up together when bins are chosen, and the points that stand for them.
SUMMED = 262_144
POINTS = 1024

NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)
#: Parameters that a forest has and its trees have not.
OF_FORESTS = {"bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate", "thresholds"}


def _chunks(batches: Iterator[pa.RecordBatch], features: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features (a row per feature) and labels, so many rows at a time."""
    xs, ys, waiting = [], [], 0
    for batch in batches:
        label = batch.column(1)
        y = label.to_numpy(zero_copy_only=False).astype(np.float64)
        if label.null_count or np.isnan(y).any():
            raise ValueError("labels must not be null or NaN")
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
        for at in range(0, len(y), rows):
            xs.append(x[at : at + rows])
            ys.append(y[at : at + rows])
            waiting += len(ys[-1])
            if waiting >= rows:
                yield np.concatenate(xs).T, np.concatenate(ys)
                xs, ys, waiting = [], [], 0
    if waiting:
        yield np.concatenate(xs).T, np.concatenate(ys)


def _summary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their numbers; of more than ``POINTS`` those at evenly spaced places, each for the rows up to it."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= POINTS:
        return found, counts
    ends = counts.cumsum()
    at = np.unique(np.searchsorted(ends, np.linspace(0, ends[-1], POINTS + 1)[1:]))
    return found[at], np.diff(ends[at], prepend=0)


def _cuts(values: np.ndarray, weights: np.ndarray, bins: int) -> list[float]:
    """Borders between bins of about equal weight, half-way between neighbouring values; between all values if there are few."""
    order = values.argsort()
    values, ends = values[order], weights[order].cumsum()
    if len(values) <= bins:
        at = np.arange(len(values) - 1)
    else:
        at = np.unique(np.searchsorted(ends, ends[-1] * np.arange(1, bins) / bins))
        at = at[at < len(values) - 1]
    return (values[at] / 2 + values[at + 1] / 2).tolist()


def _borders(rows: DataFrame, features: int, bins: int) -> tuple[list[list[float]], list[float]]:
    """The borders of every feature, and the smallest and largest labels with one between if there is."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _chunks(batches, features, SUMMED):
            for k, (found, counts) in enumerate(map(_summary, x)):
                yield pa.record_batch({"feature": np.full(len(found), k, np.int32), "value": found, "n": counts.astype(np.int64)})
            labels = np.unique(y)
            labels = labels[[0, len(labels) // 2, -1]]
            yield pa.record_batch({"feature": np.full(3, -1, np.int32), "value": labels, "n": np.ones(3, np.int64)})

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        values, weights = table.column("value").to_numpy(), table.column("n").to_numpy()
        of_labels = np.sort(values)[[0, len(values) // 2, -1]].tolist()
        cuts = of_labels if key[0].as_py() == -1 else _cuts(values, weights, bins)
        return pa.table({"feature": [key[0]], "cuts": pa.array([cuts], pa.list_(pa.float64()))})

    points = rows.mapInArrow(summed, "feature int, value double, n long").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    found = {r.feature: r.cuts for r in points.groupBy("feature").applyInArrow(cut, "feature int, cuts array<double>").collect()}  # a row for each feature
    return [found.get(k, []) for k in range(features)], found.get(-1, [])


def _blocks(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """Rows as blocks of bytes, in the order of their partitions."""
    size = trees.BLOCK_ROWS

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = [np.array(c) for c in cuts]
        for k, (x, y) in enumerate(_chunks(batches, len(cuts), size)):
            bins = np.stack([b.searchsorted(v).astype(np.uint8) for b, v in zip(borders, x)])
            columns = {"chunk": [k], "n": [len(y)], "bins": [bins.tobytes()], "labels": [y.tobytes()]}
            yield pa.record_batch(columns, pa.schema({"chunk": pa.int32(), "n": pa.int32(), "bins": pa.binary(), "labels": pa.binary()}))

    found = rows.mapInArrow(packed, "chunk int, n int, bins binary, labels binary")
    return found.withColumn("part", F.spark_partition_id())


def _node_table(shape: trees.Shape, cuts: list[list[float]], number: int, nodes: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Nodes of a tree as Spark saves them."""
    n, inner = len(nodes["id"]), nodes["left"] >= 0
    stats = [nodes["count"] - nodes["total"], nodes["total"]] if shape.classes else [nodes["count"], nodes["total"], nodes["squares"]]
    offsets = pa.array(np.arange(n + 1) * len(stats), pa.int32())
    ends = pa.array(np.concatenate([[0], inner.cumsum()]), pa.int32())
    border = np.array([cuts[f][b] for f, b in zip(nodes["feature"][inner], nodes["bin"][inner])], np.float64)
    split = {
        "featureIndex": pa.array(nodes["feature"], pa.int32()),
        "leftCategoriesOrThreshold": pa.ListArray.from_arrays(ends, pa.array(border)),
        "numCategories": pa.array(np.full(n, -1), pa.int32()),
    }
    data = {
        "id": pa.array(nodes["id"], pa.int32()),
        "prediction": pa.array(nodes["prediction"]),
        "impurity": pa.array(nodes["impurity"]),
        "impurityStats": pa.ListArray.from_arrays(offsets, pa.array(np.stack(stats, axis=1).reshape(-1))),
        "rawCount": pa.array(nodes["count"].astype(np.int64)),
        "gain": pa.array(nodes["gain"]),
        "leftChild": pa.array(nodes["left"], pa.int32()),
        "rightChild": pa.array(nodes["right"], pa.int32()),
        "split": pa.StructArray.from_arrays([*split.values()], names=[*split]),
    }
    return pa.record_batch({"treeID": pa.array(np.full(n, number), pa.int32()), "nodeData": pa.StructArray.from_arrays([*data.values()], names=[*data])})


def _groups(spark: SparkSession, count: int) -> int:
    """Tasks of a forest: as many as cores, so that each copies the blocks once, and at least eight.  Trees don't depend on it."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    return min(count, cores * -(-8 // cores))


def _grown(blocks: DataFrame, shape: trees.Shape, cuts: list[list[float]], count: int, seed: int) -> DataFrame:
    """Node tables of ``count`` trees."""
    groups = _groups(blocks.sparkSession, count)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, group = trees.Spool(shape.features), None
        for batch in batches:
            for row in batch.to_pylist():
                group, n = row["group"], row["n"]
                bins = np.frombuffer(row["bins"], np.uint8).reshape(shape.features, n)
                table.add(bins, np.frombuffer(row["labels"], np.float64), np.ones(n, np.uint8))
        if group is not None:
            for number in range(group, count, groups):
                yield _node_table(shape, cuts, number, trees.tree(shape, table, seed, number))
        table.close()

    copies = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    placed = copies.repartitionById(groups, F.col("group")).sortWithinPartitions("part", "chunk")
    return placed.select("group", "n", "bins", "labels").mapInArrow(grow, NODES)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


class _Grown:
    """Training of a forest; parameters it doesn't know are left to Spark's own."""

    def _shape(self, features: int) -> trees.Shape | None:
        strategy = self.getFeatureSubsetStrategy()
        plain = (
            strategy in ("all", "sqrt")
            and self.getBootstrap()
            and self.getNumTrees() > 1
            and self.getSubsamplingRate() == 1
            and self.getMaxBins() <= 128  # twice that fits a byte
            and self.getMinInstancesPerNode() == 1
            and self.getMinInfoGain() == 0
            and self.getMinWeightFractionPerNode() == 0
            and self.getImpurity() == self._impurity
            and not self.isSet("weightCol")
            and not self.getLeafCol()
        )
        if not plain:
            return None
        tried = features if strategy == "all" else math.ceil(math.sqrt(features))
        return trees.Shape(features, self.getMaxBins(), self.getMaxDepth(), tried, self._impurity == "gini")

    def _fit(self, dataset: DataFrame):
        column = dataset.schema[self.getFeaturesCol()]
        attributes = json.dumps(column.metadata)
        first = dataset.select(_quoted(column.name)).first()
        shape = self._shape(len(first[0])) if first and first[0] is not None else None
        if not shape or "nominal" in attributes or "binary" in attributes:
            return super()._fit(dataset)
        rows = dataset.select(vector_to_array(_quoted(column.name)).alias("x"), _quoted(self.getLabelCol()).cast("double").alias("y"))
        cuts, labels = _borders(rows, shape.features, shape.bins)
        if shape.classes and {min(labels), *labels, max(labels)} != {0.0, 1.0}:
            return super()._fit(dataset)
        blocks = stage(_blocks(rows, cuts), "bins")
        path = new_path(dataset.sparkSession, "forest")
        _grown(blocks, shape, cuts, self.getNumTrees(), self.getSeed()).write.parquet(f"{path}/data")
        discard(blocks)
        return self._finished(Saved(path, self, shape), dataset.sparkSession)


class Saved:
    """Node tables of a forest in a folder, and what else Spark keeps with them."""

    def __init__(self, path: str, learner: _Grown, shape: trees.Shape):
        self.path, self.shape, self.uid, self.count, self.names = path, shape, learner.uid, learner.getNumTrees(), learner._names
        self.given, self.otherwise = ({p.name: v for p, v in m.items()} for m in (learner._paramMap, learner._defaultParamMap))

    def load(self, spark: SparkSession, kind: type):
        """Spark's own model; the folder is completed into one that Spark reads."""
        head = {"timestamp": 0, "sparkVersion": spark.version}
        sizes = {"numFeatures": self.shape.features, **({"numClasses": 2} if self.shape.classes else {})}
        forest = {"class": self.names[0], **head, "uid": self.uid, "paramMap": self.given, "defaultParamMap": self.otherwise, **sizes, "numTrees": self.count}
        own = [{k: v for k, v in m.items() if k not in OF_FORESTS} for m in (self.given, self.otherwise)]
        tree = {"class": self.names[1], **head, "paramMap": own[0], "defaultParamMap": own[1], **sizes}
        each = [(k, json.dumps({**tree, "uid": f"{self.uid}_{k}"}), 1.0) for k in range(self.count)]
        spark.createDataFrame([(json.dumps(forest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/metadata")
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/treesMetadata")
        return kind.read().session(spark).load(self.path)

    def arrays(self, spark: SparkSession) -> list[tuple[np.ndarray, ...]]:
        """Feature, border, children and value of the nodes of every tree; a leaf leads to itself."""
        node = F.col("nodeData")
        split = node.getField("split")
        wanted = {
            "feature": split.getField("featureIndex").cast("smallint"),
            "border": F.get(split.getField("leftCategoriesOrThreshold"), F.lit(0)),
            "left": node.getField("leftChild"),
            "right": node.getField("rightChild"),
            "value": node.getField("prediction"),
        }
        rows = spark.read.parquet(f"{self.path}/data").select("treeID", node.getField("id").alias("id"), *[v.alias(k) for k, v in wanted.items()])
        table = rows.toArrow()  # at most trees * 2 ** (depth + 1) nodes of 30 bytes, fewer than Spark's model takes
        tree, own = table.column("treeID").to_numpy(), table.column("id").to_numpy()
        order = np.lexsort((own, tree))
        feature, border, left, right, value = (table.column(c).to_numpy()[order] for c in wanted)
        leaf, own = left < 0, own[order]
        children = np.stack([np.where(leaf, own, left), np.where(leaf, own, right)], axis=1).astype(np.int32)
        ends = np.flatnonzero(np.diff(tree[order])) + 1
        parts = (np.where(leaf, 0, feature), np.where(leaf, np.inf, border), children, value)
        return [(f, b, c.reshape(-1), v) for f, b, c, v in zip(*(np.split(p, ends) for p in parts))]


class GrownRegressionModel(regression.RandomForestRegressionModel):
    """A regression forest that scores by its node tables.

    Spark's own model, a million objects and more for deep trees, is loaded only
    for what needs it (saving, importances, printing), from the folder of the
    node tables, which ``staging.release`` deletes.
    """

    def __init__(self, saved: Saved, spark: SparkSession):
        self._whole = None
        super().__init__()
        self._saved, self._spark = saved, spark
        self._shared = spark.sparkContext.broadcast(saved.arrays(spark))
        self._resetUid(saved.uid)

    @property
    def _java_obj(self):
        if self._whole is None and hasattr(self, "_saved"):
            self._whole = self._saved.load(self._spark, regression.RandomForestRegressionModel)
        return self._whole and self._whole._java_obj

    @_java_obj.setter
    def _java_obj(self, found) -> None:
        if found is not None:
            raise ValueError("this model comes from its node tables")

    @property
    def trees(self) -> list:  # else looked at, and so loaded, whenever parameters are listed
        return self._java_obj and self._whole.trees

    def __del__(self) -> None:
        """Spark's model goes by itself."""

    def copy(self, extra: dict | None = None) -> GrownRegressionModel:
        return Params.copy(self, extra)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared, features, depth = self._shared, self._saved.shape.features, self._saved.shape.depth

        def predict(x: pa.Array) -> pa.Array:
            if x.null_count:
                raise ValueError("features must not be null")
            values = x.flatten().to_numpy(zero_copy_only=False)
            start = np.arange(len(x)) * features
            total = np.zeros(len(x))
            for feature, border, children, value in shared.value:
                at = np.zeros(len(x), np.int64)
                for _ in range(depth):
                    right = values.take(start + feature.take(at)) > border.take(at)
                    at = children.take(2 * at + right).astype(np.int64)
                total += value.take(at)
            return pa.array(total / len(shared.value))

        x = vector_to_array(_quoted(self.getFeaturesCol()))
        return dataset.withColumn(self.getPredictionCol(), F.arrow_udf(predict, "double")(x))


class RandomForestRegressor(_Grown, regression.RandomForestRegressor):
    _impurity = "variance"
    _names = ("org.apache.spark.ml.regression.RandomForestRegressionModel", "org.apache.spark.ml.regression.DecisionTreeRegressionModel")

    def _finished(self, saved: Saved, spark: SparkSession) -> GrownRegressionModel:
        return self._copyValues(GrownRegressionModel(saved, spark))


class RandomForestClassifier(_Grown, classification.RandomForestClassifier):
    _impurity = "gini"
    _names = ("org.apache.spark.ml.classification.RandomForestClassificationModel", "org.apache.spark.ml.classification.DecisionTreeClassificationModel")

    def _finished(self, saved: Saved, spark: SparkSession) -> classification.RandomForestClassificationModel:
        model = self._copyValues(saved.load(spark, classification.RandomForestClassificationModel))
        remove(spark, saved.path)
        return model


def forget(model: PipelineModel) -> None:
    """Delete the node tables of a model that is neither saved nor looked into later; what it scored can still be read."""
    for part in model.stages:
        if isinstance(part, GrownRegressionModel):
            remove(part._spark, part._saved.path)
