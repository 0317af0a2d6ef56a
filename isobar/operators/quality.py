"""Data-quality scores, summaries and run reports."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.weather import missing
from isobar.operators.quantiles import EXACT_ROWS, exact_quantiles

CHECKED = ["temperature", "humidity", "pressure"]


def _absent(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    floating = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    return value.isNull() | F.isnan(value) if floating else value.isNull()


def completeness(df: DataFrame) -> DataFrame:
    """Share of cells with a value, in one pass; an empty table scores 1."""
    gaps = reduce(lambda a, b: a + b, [F.count_if(_absent(df, c)) for c in df.columns])
    cells = F.count("*") * len(df.columns)
    score = 1 - F.coalesce(F.try_divide(gaps, cells), F.lit(0.0))
    return df.agg(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("data_quality_score"))


def null_counts(df: DataFrame, columns: list[str] = CHECKED) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_records"), *[F.count_if(_absent(df, c)).alias(f"null_{c}") for c in columns]
    )


def with_null_percentage(counts: DataFrame, columns: list[str] = CHECKED) -> DataFrame:
    gaps = reduce(lambda a, b: a + b, [F.col(f"null_{c}") for c in columns])
    return counts.withColumn("null_percentage", F.try_divide(gaps, F.col("total_records") * len(columns)) * 100)


def verdict(counts: DataFrame, columns: list[str] = CHECKED, *, limit: float = 10.0) -> DataFrame:
    """'no_data', 'low_quality' (more than ``limit`` percent missing) or 'quality_ok'."""
    share = with_null_percentage(counts, columns)
    return share.withColumn(
        "verdict",
        F.when(F.col("total_records") == 0, "no_data")
        .when(F.col("null_percentage") > limit, "low_quality")
        .otherwise("quality_ok"),
    )


def period(df: DataFrame, time: str) -> DataFrame:
    return df.agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("records"))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def describe(df: DataFrame, columns: list[str], *, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """One row per column: count, mean, sample std, min, exact quartiles, max."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], exact_rows=exact_rows)

    def facts(c: str) -> Column:
        v = missing(F.col(c).cast("double"))
        q = [F.lit(x).cast("double") for x in quartiles[c]]
        return F.struct(
            F.lit(c).alias("column"),
            F.count(v).alias("count"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"),
            q[0].alias("q25"),
            q[1].alias("q50"),
            q[2].alias("q75"),
            F.max(v).alias("max"),
        )

    return df.agg(F.array(*[facts(c) for c in columns]).alias("facts")).select(F.inline("facts"))


def forecast_summary(forecast: DataFrame, keys: list[str], value: str = "prediction") -> DataFrame:
    """Mean, extremes, count and population std of each series' forecast."""
    return forecast.groupBy(*keys).agg(
        F.avg(value).alias("next_avg"),
        F.min(value).alias("min_predicted"),
        F.max(value).alias("max_predicted"),
        F.count(value).alias("predictions_count"),
        F.stddev_pop(value).alias("std_deviation"),
    )


def mean_metrics(evaluation: DataFrame) -> DataFrame:
    return evaluation.agg(
        F.avg("mae").alias("avg_mae"), F.avg("rmse").alias("avg_rmse"), F.avg("r2").alias("avg_r2")
    )


class StageCounts:
    """Counts the rows of stages while they pass through a write that is made anyway.

    ``watch`` a frame that the next write reads, then ``note`` when it is done.
    Reading the counts starts no job.  A stage whose frame was read by no job yet
    must not be asked for.
    """

    def __init__(self):
        self._seen: dict[str, Observation | int] = {}
        self._seconds: dict[str, float] = {}
        self._began = time.monotonic()

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        observed = Observation(f"{name}-{len(self._seen)}")
        self._seen[name] = observed
        return df.observe(observed, F.count(F.lit(1)).alias("records"))

    def same_as(self, name: str, other: str) -> None:
        """A stage that neither adds nor drops rows of another one."""
        self._seen[name] = self._seen[other]

    def done(self, name: str) -> None:
        """The stage ends here: its seconds count from the start or the last stage's end."""
        now = time.monotonic()
        self._seconds[name], self._began = now - self._began, now

    def records(self, name: str) -> int:
        seen = self._seen[name]
        if isinstance(seen, Observation):
            seen = self._seen[name] = int(seen.get["records"])
        return seen

    def report(self, spark: SparkSession) -> DataFrame:
        """``(step, stage, records, seconds)`` as ``stage_report`` has it, in the order stages were watched."""
        rows = [(i, n, self.records(n), self._seconds.get(n)) for i, n in enumerate(self._seen, 1)]
        return spark.createDataFrame(rows, "step int, stage string, records long, seconds double")


def stage_report(stages: dict[str, DataFrame], seconds: dict[str, float] | None = None) -> DataFrame:
    """One row per stage, in order: record count and, where known, duration.

    Every stage is counted by a pass of its own; ``StageCounts`` counts while
    a job writes.
    """
    rows = [
        df.agg(F.count("*").alias("records")).select(
            F.lit(i).alias("step"),
            F.lit(name).alias("stage"),
            "records",
            F.lit((seconds or {}).get(name)).cast("double").alias("seconds"),
        )
        for i, (name, df) in enumerate(stages.items(), 1)
    ]
    return reduce(DataFrame.unionByName, rows)
