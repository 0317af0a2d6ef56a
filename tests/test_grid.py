"""Series on a regular grid, in chunks of any size."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators.grid import regular, spine, without_holes
from isobar.plans.forecast import Forecaster, Orders

BEGIN = dt.datetime(2024, 3, 1)


def at(hours):
    return BEGIN + dt.timedelta(hours=hours)


@pytest.fixture
def holed(spark):
    rows = [("a", at(h), float(h)) for h in (0, 1, 5, 6, 30)] + [(None, at(2), 4.0), (None, at(4), 8.0), ("one", at(9), 1.0), ("b", None, 3.0)]
    return spark.createDataFrame(rows, "city string, observed_at timestamp_ntz, v double").withColumn("note", F.lit("x"))


@pytest.mark.parametrize("chunk", [10_000, 31, 7, 1])
def test_every_hour_once(holed, chunk):
    got = regular(holed, ["city"], "observed_at", chunk=chunk)
    assert got.schema == holed.schema or got.dtypes == holed.dtypes
    rows = {(r.city, r.observed_at): (r.v, r.note) for r in got.collect()}
    assert got.count() == len(rows) == 31 + 3 + 1
    assert rows["a", at(30)] == (30.0, "x") and rows["a", at(7)] == (None, None)
    assert rows[None, at(3)] == (None, None) and rows["one", at(9)] == (1.0, "x")


@pytest.mark.parametrize("chunk, block_rows", [(10_000, 1_000_000), (5, 6)])
def test_lines_through_holes(holed, chunk, block_rows):
    got = {(r.city, r.observed_at): r.v for r in without_holes(holed, ["city"], "observed_at", ["v"], chunk=chunk, block_rows=block_rows).collect()}
    assert [got["a", at(h)] for h in range(31)] == pytest.approx([float(h) for h in range(31)])
    assert got[None, at(3)] == 6.0


def test_times_are_cut_to_steps_and_rows_of_a_step_stay(spark):
    rows = [("a", at(0) + dt.timedelta(minutes=40), 1.0), ("a", at(0) + dt.timedelta(minutes=50), 2.0), ("a", at(2) + dt.timedelta(minutes=1), 3.0)]
    df = spark.createDataFrame(rows, "city string, observed_at timestamp, v double")
    got = regular(df, ["city"], "observed_at").collect()
    assert sorted((r.observed_at.replace(tzinfo=None), r.v) for r in got if r.v) == [(at(0), 1.0), (at(0), 2.0), (at(2), 3.0)]
    assert len(got) == 4
    assert regular(df, ["city"], "observed_at", unit="day").count() == 3
    with pytest.raises(ValueError, match="unit"):
        spine(df, ["city"], "observed_at", unit="week")


def test_empty(spark):
    df = spark.createDataFrame([], "city string, observed_at timestamp, v double")
    assert without_holes(df, ["city"], "observed_at", ["v"]).collect() == []


def test_a_long_series_is_spread(holed):
    plan = spine(holed, ["city"], "observed_at", chunk=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 2 and "__start" in plan.split("hashpartitioning")[1]


def test_forecaster_fills_holes_first(spark):
    """Without the grid a lag of one season points to another hour; with it the daily pattern is found."""
    rng = np.random.default_rng(2)
    rows = [("a", at(h), 10 * np.sin(2 * np.pi * h / 24) + 0.01 * float(rng.normal()), "x" if h % 2 else None) for h in range(400) if h % 13 not in (4, 5)]
    df = spark.createDataFrame([(c, t, float(v), n) for c, t, v, n in rows], "city string, observed_at timestamp_ntz, temperature double, note string")
    errors = {}
    for unit in (None, "hour"):
        spec = Forecaster(["city"], ["observed_at"], orders=Orders((1, 0, 0), (0, 1, 0, 24), constant=True), unit=unit)
        ready = spec.prepare(df if unit else df.drop("note"), minimum=100)
        errors[unit] = spec.evaluate(spec.fit(spec.split(ready))).first().rmse
        assert ready.count() == (400 if unit else len(rows))
    assert errors["hour"] < 1.5 < errors[None]
    with pytest.raises(ValueError, match="one time"):
        Forecaster(["city"], ["observed_at", "note"], unit="hour").prepare(df)
