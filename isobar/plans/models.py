"""Rain classifiers and temperature regressors on Spark ML."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from statistics import fmean, pstdev

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators import metrics
from isobar.operators.columns import available, top
from isobar.operators.encode import encode_labels, label_mapping
from isobar.operators.joins import not_in
from isobar.operators.split import (
    SEED,
    plain_split,
    stratified_split,
    with_folds,
    with_stratified_folds,
)
from isobar.plans.forests import RandomForestClassifier, RandomForestRegressor, forget
from isobar.schema import PREDICTION
from isobar.sources.tables import typed
from isobar.staging import apart, discard, stage

# The features each model looks for, in order.
RAIN_FEATURES = [
    "temperature",
    "humidity",
    "pressure",
    "wind_speed",
    "feelslike",
    "dew_point",
    "pressure_tendency",
    "temp_humidity_interaction",
    "wind_pressure_interaction",
    "hour",
    "day_of_week",
    "month",
]
TEMPERATURE_FEATURES = [
    "humidity",
    "pressure",
    "wind_speed",
    "precipitation",
    "dew_point",
    "pressure_tendency",
    "temp_humidity_interaction",
    "wind_pressure_interaction",
    "hour",
    "day_of_week",
    "month",
]
RAIN_CATEGORIES = ["wind_direction"]
TEMPERATURE_CATEGORIES = ["wind_direction", "season"]


@dataclass(frozen=True)
class Features:
    """Which columns a model reads, with the text encodings it was fitted with.

    ``levels`` are text columns that the model's own pipeline turns into sparse
    one-hot vectors (see ``one_hot_stages``).
    """

    columns: list[str]
    mappings: dict[str, DataFrame] = field(default_factory=dict)
    levels: list[str] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [*self.columns, *[f"{c}_encoded" for c in self.mappings]]

    @staticmethod
    def fit(df: DataFrame, wanted: list[str], categories: list[str] = (), levels: list[str] = ()) -> Features:
        return Features(available(df, wanted), {c: label_mapping(df, c) for c in available(df, list(categories))}, available(df, list(levels)))

    def apply(self, df: DataFrame) -> DataFrame:
        for c, mapping in self.mappings.items():
            df = encode_labels(df, c, mapping)
        return df


def rain_features(df: DataFrame) -> Features:
    return Features.fit(df, RAIN_FEATURES, RAIN_CATEGORIES)


def temperature_features(df: DataFrame) -> Features:
    return Features.fit(df, TEMPERATURE_FEATURES, TEMPERATURE_CATEGORIES)


def scaled(features: Features, learner: Estimator) -> Pipeline:
    """Assemble, centre and scale, then learn; rows with a missing feature are an error."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features.names, outputCol="assembled"),
            StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
            learner,
        ]
    )


# Spark's training, where it is used, keeps each row's node with the row, so a pass over a level doesn't walk every tree from its root; the trees are the same.


def rain_forest(label: str = "rain_flag", *, trees: int = 100, depth: int = 10, seed: int = SEED) -> Estimator:
    return RandomForestClassifier(
        labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True
    )


def temperature_forest(
    label: str = "temperature", *, trees: int = 100, depth: int = 15, seed: int = SEED
) -> Estimator:
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=seed, cacheNodeIds=True
    )


def one_hot_stages(columns: list[str]) -> list:
    """Pipeline stages that turn each text column into ``<column>_vector``: a place for each level in order, and one for NULL and levels not seen.

    Vectors are sparse, so a row holds one number whatever the levels; the
    levels themselves are kept with the saved pipeline.
    """
    if not columns:
        return []
    indices, vectors = [f"{c}_index" for c in columns], [f"{c}_vector" for c in columns]
    return [
        StringIndexer(inputCols=columns, outputCols=indices, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indices, outputCols=vectors, handleInvalid="error", dropLast=False),
    ]


def rain_logit(features: Features, rows: int, label: str = "rain_flag") -> Pipeline:
    """Unscaled logistic regression with an L2 penalty of weight 1 on the summed loss."""
    learner = LogisticRegression(
        labelCol=label, maxIter=1000, regParam=1.0 / rows, elasticNetParam=0.0, standardization=False
    )
    inputs = [*features.names, *[f"{c}_vector" for c in features.levels]]
    return Pipeline(stages=[*one_hot_stages(features.levels), VectorAssembler(inputCols=inputs, outputCol="features"), learner])


@dataclass(frozen=True)
class Model:
    """A fitted pipeline with everything needed to score another table."""

    pipeline: PipelineModel
    features: Features
    label: str
    version: str = "1.0.0"

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and, for classifiers, ``probability`` of class 1."""
        out = self.pipeline.transform(self.features.apply(df))
        if "probability" in out.columns:
            out = out.withColumns(
                {
                    "probability": vector_to_array("probability")[1],
                    "prediction": F.col("prediction").cast("int"),
                }
            )
        helpers = [f"{c}_{h}" for c in self.features.levels for h in ("index", "vector")]
        return out.drop("assembled", "features", "rawPrediction", *helpers)

    def importance(self, *, k: int | None = None) -> DataFrame:
        """Feature importances, highest first (ties by name)."""
        weights = self.pipeline.stages[-1].featureImportances.toArray().tolist()
        spark = SparkSession.active()
        table = spark.createDataFrame(list(zip(self.features.names, weights)), "feature string, importance double")
        return top(table, "importance", k=len(weights) if k is None else k, tie="feature")

    def save(self, path: str, metrics_row: DataFrame | None = None) -> None:
        """Pipeline, encodings, and one row of metadata with the scores."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        for c, mapping in self.features.mappings.items():
            mapping.write.mode("overwrite").parquet(f"{path}/encoding/{c}")
        meta = SparkSession.active().range(1).select(
            F.array(*[F.lit(c) for c in self.features.columns]).cast("array<string>").alias("feature_columns"),
            F.array(*[F.lit(c) for c in self.features.mappings]).cast("array<string>").alias("categories"),
            F.array(*[F.lit(c) for c in self.features.levels]).cast("array<string>").alias("levels"),
            F.lit(self.label).alias("label"),
            F.lit(self.version).alias("version"),
        )
        if metrics_row is not None:
            scores = metrics_row.agg(F.first(F.to_json(F.struct(*metrics_row.columns)))).scalar()
            meta = meta.withColumn("metrics", scores)
        meta.write.mode("overwrite").parquet(f"{path}/metadata")


def load(spark: SparkSession, path: str) -> tuple[Model, DataFrame]:
    """The model saved at ``path`` and its metadata row."""
    meta = spark.read.parquet(f"{path}/metadata")
    row = meta.first()
    mappings = {c: spark.read.parquet(f"{path}/encoding/{c}") for c in row["categories"]}
    features = Features(row["feature_columns"], mappings, row["levels"])
    return Model(PipelineModel.load(f"{path}/pipeline"), features, row["label"], row["version"]), meta


#: Partitions of a training table at least, and rows of one at most.  Forests draw their samples by partition, so these numbers, not the cluster's size, decide them.
PARTITIONS = 4
PARTITION_ROWS = 100_000
#: The same for temperature forests.
DEEP_PARTITION_ROWS = 400_000
#: Equal rows that stay together.
TOGETHER = 1000


def partitions_of(rows: int, partition_rows: int | None = None) -> int:
    return max(PARTITIONS, -(-rows // (partition_rows or PARTITION_ROWS)))


def spread(written: DataFrame, partitions: int | None = None, partition_rows: int | None = None) -> DataFrame:
    """Rows placed and sorted by their own hash, for repeated passes over a written table.

    The same rows give the same partitions on any cluster, and so the same
    forest.  Their number grows with the table unless it is given.  Equal rows
    are counted first and come back in lots of ``TOGETHER``, each with a place of
    its own, so that no value fills a partition.
    """
    columns = [F.col(f"`{c}`") for c in written.columns]
    partitions = partitions_of(written.count(), partition_rows) if partitions is None else partitions
    counted = written.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    lots = counted.withColumn("__lot", F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(TOGETHER).cast("long"))))
    placed = lots.withColumn("__place", F.xxhash64(*columns, "__lot")).repartition(partitions, "__place")
    ordered = placed.sortWithinPartitions("__place", *columns, "__lot")
    copies = F.sequence(F.lit(1).cast("long"), F.least(F.col("__n") - F.col("__lot"), F.lit(TOGETHER)))
    return ordered.withColumn("__copy", F.explode(copies)).drop("__n", "__lot", "__place", "__copy")


def fit(
    pipeline: Pipeline,
    features: Features,
    train: DataFrame,
    label: str,
    version: str = "1.0.0",
    *,
    partitions: int | None = None,
    partition_rows: int | None = None,
) -> Model:
    wanted = [*features.names, *features.levels, label]
    written = stage(features.apply(train).select(*dict.fromkeys(wanted)), "training")
    rows = spread(apart(written), partitions, partition_rows).persist(StorageLevel.DISK_ONLY)  # a scaler and a forest take six passes
    fitted = pipeline.fit(rows)
    rows.unpersist()
    discard(written)
    return Model(fitted, features, label, version)


def classifier_report(scored: DataFrame, label: str) -> DataFrame:
    """One row: AUC with the class-1 scores, accuracy and confusion counts."""
    area = metrics.auc(scored, label, "probability").scalar()
    return metrics.binary_report(scored, label).withColumn("auc", area)


def cross_validate(
    pipeline: Pipeline, df: DataFrame, evaluator: Evaluator, *, fold: str = "fold", folds: int = 5
) -> DataFrame:
    """Mean and population std of a score over the folds marked in ``fold``.

    One model for each fold and none of all rows, which no score needs.  Folds
    run together while the partitions of one leave cores idle; else one by one,
    so that only one training table is held at a time.
    """
    rows = df.persist(StorageLevel.DISK_ONLY)  # every fold reads it several times
    sizes = {r[0]: r[1] for r in rows.groupBy(fold).count().collect()}  # a row for each fold
    if set(sizes) != set(range(folds)) or folds < 2:
        rows.unpersist()
        raise ValueError(f"rows must lie in {folds} folds from 0, each with a row; found {sorted(sizes, key=str)}")

    def score(k: int) -> float:
        model = pipeline.fit(rows.filter(F.col(fold) != k))
        scored = model.transform(rows.filter(F.col(fold) == k))
        wanted = [c for c in (evaluator.getLabelCol(), "rawPrediction", "prediction") if c in scored.columns]
        scored = scored.select(*wanted).persist(StorageLevel.DISK_ONLY)  # an evaluator sorts, which reads twice
        found = float(evaluator.evaluate(scored))
        scored.unpersist()
        forget(model)
        return found

    spark = df.sparkSession
    together = max(1, min(folds, spark.sparkContext.defaultParallelism // rows.rdd.getNumPartitions()))
    with ThreadPoolExecutor(together) as pool:
        scores = [*pool.map(inheritable_thread_target(spark)(score), range(folds))]
    rows.unpersist()
    return SparkSession.active().createDataFrame([(fmean(scores), pstdev(scores))], "cv_mean double, cv_std double")


def rain_cross_validation(
    df: DataFrame,
    features: Features,
    key: str,
    *,
    label: str = "rain_flag",
    folds: int = 5,
    learner: Estimator | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Stratified folds scored by AUC."""
    marked = with_stratified_folds(features.apply(df), label, key, folds=folds)
    written = stage(marked.select(*dict.fromkeys([*features.names, label, "fold"])), "folds")
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    result = cross_validate(scaled(features, learner or rain_forest(label)), spread(apart(written), partitions), evaluator, folds=folds)
    discard(written)
    return result


def temperature_cross_validation(
    df: DataFrame,
    features: Features,
    key: str,
    *,
    label: str = "temperature",
    folds: int = 5,
    share: Column | None = None,
    learner: Estimator | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Plain folds scored by mean absolute error."""
    marked = with_folds(features.apply(df), key, folds=folds, share=share)
    written = stage(marked.select(*dict.fromkeys([*features.names, label, "fold"])), "folds")
    evaluator = RegressionEvaluator(labelCol=label, metricName="mae")
    result = cross_validate(scaled(features, learner or temperature_forest(label)), spread(apart(written), partitions, DEEP_PARTITION_ROWS), evaluator, folds=folds)
    discard(written)
    return result


def train_rain(df: DataFrame, key: str, *, label: str = "rain_flag", partitions: int | None = None) -> tuple[Model, DataFrame]:
    """Stratified 80/20 split, scaled forest; returns the model and the scored test rows."""
    parts = stratified_split(df, label, key)
    features = rain_features(df)
    model = fit(scaled(features, rain_forest(label)), features, parts.filter("not is_test"), label, partitions=partitions)
    return model, model.score(parts.filter("is_test"))


def train_temperature(
    df: DataFrame, key: str, *, label: str = "temperature", share: Column | None = None, partitions: int | None = None
) -> tuple[Model, DataFrame]:
    """Plain 80/20 split, scaled forest; returns the model and the scored test rows."""
    parts = plain_split(df, key, share=share)
    features = temperature_features(df)
    train = parts.filter("not is_test")
    model = fit(scaled(features, temperature_forest(label)), features, train, label, partitions=partitions, partition_rows=DEEP_PARTITION_ROWS)
    return model, model.score(parts.filter("is_test"))


def score_unscored(
    readings: DataFrame,
    predictions: DataFrame,
    model: Model,
    now: Column,
    *,
    key: str = "id",
    time: str = "recorded_at",
    hours: int = 1,
) -> DataFrame:
    """Prediction rows for the last hour's readings that have none from that hour yet."""
    limit = now - F.make_dt_interval(F.lit(0), F.lit(hours))
    done = predictions.filter(F.col("predicted_at") >= limit)
    due = not_in(readings.filter(F.col(time) >= limit), key, done, "weather_data_id")
    scored = model.score(due)
    return typed(
        scored.select(
            F.col(key).alias("weather_data_id"),
            "prediction",
            F.col("probability").alias("confidence"),
            F.lit(model.version).alias("model_version"),
            now.cast("timestamp").alias("predicted_at"),
        ),
        PREDICTION,
    )
