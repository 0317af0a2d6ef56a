"""Model scores as aggregations.

Predictions are reduced to counts per (label, prediction) or per distinct score
before anything is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.operators.ordered import BLOCK_ROWS, running_sums


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Long confusion matrix: one row per (label, prediction) that occurs."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def auc(df: DataFrame, label: str, score: str, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Area under the ROC curve: share of (positive, negative) pairs in the right order, ties half.

    A running count of negatives over the distinct scores gives every positive
    its rank, so no pairs are formed.
    """
    positive = F.col(label) == 1
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(positive).alias("p"), F.count_if(~positive).alias("n")
    )
    ranked = running_sums(per_score, [], ["score"], {"n_upto": F.col("n")}, block_rows=block_rows)
    won = F.sum(F.col("p").cast("double") * (F.col("n_upto") - F.col("n") / 2.0))
    pairs = F.sum("p").cast("double") * F.sum("n").cast("double")
    return ranked.agg(F.try_divide(won, pairs).alias("auc"))


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0, as the usual reports have it."""
    return F.when(b == 0, 0.0).otherwise(F.try_divide(a, b))


def binary_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 of class 1, accuracy and the four counts."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class precision, recall, F1 and support, with macro and weighted means.

    Works from the confusion counts; the data is read once.
    """
    cells = confusion(df, label, prediction)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").cast("string").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).cast("long").alias("hits"),
                ),
                F.struct(
                    F.col("prediction").cast("string").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        )
    )
    totals = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    classes = totals.select(
        "class",
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, support + predicted).alias("f1_score"),
        "support",
    )
    scores = ["precision", "recall", "f1_score"]
    macro = classes.agg(
        *[F.avg(s).alias(s) for s in scores], F.sum("support").alias("support")
    ).withColumn("class", F.lit("macro avg"))
    weighted = classes.agg(
        *[_ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(s) for s in scores],
        F.sum("support").alias("support"),
    ).withColumn("class", F.lit("weighted avg"))
    return classes.unionByName(macro).unionByName(weighted)


def regression_metrics(
    df: DataFrame, actual: str = "actual", prediction: str = "prediction", keys: list[str] | None = None
) -> DataFrame:
    """MAE, RMSE and R2, overall or per key, in one pass."""
    y, error = F.col(actual), F.col(actual) - F.col(prediction)
    sse, sst = F.sum(error * error), F.var_pop(y) * F.count(y)
    return df.groupBy(*(keys or [])).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(sse, sst)).alias("r2"),
        F.count(error).alias("n"),
    )


def residual_stats(df: DataFrame, residual: str, keys: list[str] | None = None) -> DataFrame:
    """Mean, population std, and bias-corrected skewness and excess kurtosis."""
    raw = df.groupBy(*(keys or [])).agg(
        F.count(residual).cast("double").alias("n"),
        F.avg(residual).alias("mean"),
        F.stddev_pop(residual).alias("std"),
        F.skewness(residual).alias("g1"),
        F.kurtosis(residual).alias("g2"),
    )
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    return raw.select(
        *(keys or []),
        n.cast("long").alias("n"),
        "mean",
        "std",
        F.when(n > 2, F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2)).alias("skew"),
        F.when(n > 3, F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"),
    )
