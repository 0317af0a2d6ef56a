"""Literal frames with hand-checked results, and properties of the cleaning rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import clean
from isobar.operators.quantiles import exact_quantiles

MEASURES = "temperature double, humidity double, pressure double, wind_speed double, precipitation double"


@pytest.fixture
def messy(spark):
    return spark.createDataFrame(
        [
            (0, 12.0, 40.0, 998.0, 3.0, 0.0),
            (1, 14.0, None, 1002.0, 4.0, 0.5),
            (2, None, 44.0, 1000.0, 5.0, 0.0),
            (3, 16.0, 48.0, None, 6.0, 1.0),
            (4, 18.0, 52.0, 1004.0, 90.0, 0.0),
            (5, 20.0, 56.0, 1006.0, 7.0, 0.5),
        ],
        "row int, " + MEASURES,
    )


def test_clean_keeps_filled_inliers(messy):
    rows = {r.row: r for r in clean.clean(messy, fill_columns=["temperature", "humidity", "pressure"]).collect()}
    assert sorted(rows) == [0, 1, 2, 3, 5]
    assert (rows[2].temperature, rows[1].humidity, rows[3].pressure) == (16.0, 48.0, 1002.0)
    assert rows[0].temperature == 12.0


def test_sequential_fences(messy):
    """Each column's fences come from the rows the columns before it have left."""
    filled = clean.fill_median(messy)
    assert clean.iqr_bounds(filled, ["temperature", "wind_speed"]) == {"temperature": (10.0, 22.0), "wind_speed": (0.5, 10.5)}
    assert clean.iqr_bounds(filled, ["humidity"])["humidity"] == (36.0, 60.0)
    calm = filled.filter(F.col("wind_speed").between(0.5, 10.5))
    assert clean.iqr_bounds(calm, ["humidity"])["humidity"] == (38.0, 54.0)


def test_outlier_rows_dropped(spark):
    rows = [(k, 5.0 + k if k < 4 else 300.0, 30.0 + 5 * k, 990.0 + k) for k in range(5)]
    df = spark.createDataFrame(rows, "row int, temperature double, humidity double, pressure double")
    assert sorted(r.row for r in clean.drop_outliers(df).collect()) == [0, 1, 2, 3]


def test_missing_values(spark):
    df = spark.createDataFrame(
        [(8.0, 30.0, "north", None), (None, 34.0, None, None), (11.0, None, "east", None)],
        "temperature double, humidity double, location string, note string",
    )
    rows = clean.fill_mode(clean.fill_median(df)).collect()
    assert rows[1].temperature == 9.5 and rows[2].humidity == 32.0
    assert rows[1].location == "east" and {r.note for r in rows} == {"Unknown"}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "temperature double")
    assert sorted(r[0] for r in clean.fill_median(df).collect()) == [1.0, 2.0, 3.0]


def test_zero_inflated_column_loses_its_rain(spark):
    df = spark.range(100).select(F.when(F.col("id") < 10, 1.0).otherwise(0.0).alias("precipitation"))
    assert clean.iqr_bounds(df, ["precipitation"])["precipitation"] == (0.0, 0.0)
    assert clean.drop_outliers(df).count() == 90
    assert clean.drop_outliers(df, []).count() == 100


def test_mode_fill_keeps_dates(spark):
    df = spark.sql("SELECT * FROM VALUES (date'2024-01-02'), (date'2024-01-01'), (NULL) AS t(d)")
    out = clean.fill_mode(df)
    assert out.schema["d"].dataType.simpleString() == "date"
    assert sorted(str(r.d) for r in out.collect()) == ["2024-01-01", "2024-01-01", "2024-01-02"]


def test_types_and_clip(spark):
    df = spark.createDataFrame([("12.5", "130"), ("bad", "-4"), (None, None)], "temperature string, humidity string")
    assert [tuple(r) for r in clean.coerce_types(df).collect()] == [(12.5, 100.0), (None, 0.0), (None, None)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, float("nan")), (2, float("nan"))], "a int, b double")
    assert clean.drop_duplicates(df).count() == 2


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("limits", [{}, {"exact_rows": 40, "accuracy": 60}, {"at_most": 4001}])
@pytest.mark.parametrize("shape", ["spread", "tied", "wide", "constant"])
def test_quantiles_equal_numpy(spark, shape, limits):
    """The narrowing rounds give the same exact answer as one pick, hot values included."""
    rng = np.random.default_rng(7)
    values = {
        "spread": rng.normal(10, 5, 4000),
        "tied": np.where(rng.random(4000) < 0.4, 3.0, rng.integers(0, 50, 4000) / 4),
        "wide": np.exp(rng.normal(0, 60, 4000)) * rng.choice([-1, 1], 4000),
        "constant": np.full(500, 2.5),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    assert exact_quantiles(df, ["v"], PROBS, **limits)["v"] == np.quantile(values, PROBS).tolist()


def test_many_columns_share_one_bound(spark):
    rng = np.random.default_rng(8)
    values = rng.normal(size=(600, 6))
    df = spark.createDataFrame([tuple(map(float, r)) for r in values], ", ".join(f"c{k} double" for k in range(6)))
    found = exact_quantiles(df, df.columns, [0.25, 0.5, 0.75], exact_rows=50, accuracy=40)
    for k in range(6):
        assert found[f"c{k}"] == np.quantile(values[:, k], [0.25, 0.5, 0.75]).tolist()


def test_integers_have_one_type_with_or_without_gaps(spark):
    for rows in ([(1,), (2,), (4,)], [(1,), (None,), (2,)], [(1,), (None,), (3,)]):
        filled = clean.fill_median(spark.createDataFrame(rows, "v long"))
        assert filled.dtypes == [("v", "double")]


def test_named_fills_leave_keys_alone(spark):
    df = spark.createDataFrame([(1, None, None), (None, 2.0, "x"), (3, 4.0, "x")], "id long, temperature double, name string")
    out = clean.clean(df, outlier_columns=[], fill_columns=["temperature"], mode_columns=[]).collect()
    assert {r.id for r in out} == {1, None, 3} and {r.name for r in out} == {None, "x"}
    assert {r.temperature for r in out} == {2.0, 3.0, 4.0}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]) == {"v": [None]}
    assert clean.drop_outliers(df.withColumnRenamed("v", "humidity")).count() == 0
