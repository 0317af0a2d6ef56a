"""The hourly job by runs that read each document once."""

import os
import random

import pytest
from pyspark.sql import functions as F

from isobar import schema
from isobar.operators import hourly
from isobar.operators.quality import StageCounts
from isobar.operators.sums import cell_sums, means_of, merged_sums
from isobar.plans import runs
from isobar.plans.runs import HourlyStore, run_hourly, run_new_documents, stored_sums
from isobar.sources.ledger import Ledger

START = 1_700_000_000  # 2023-11-14 22:13:20
DAY = 86_400
def later():
    return F.timestamp_seconds(F.lit(START + 10 * DAY))



def frame(spark, rows):
    """(dt, lon, lat, temperature, rain) as documents."""
    flat = spark.createDataFrame(rows, "dt long, lon double, lat double, temp double, wet double")
    return flat.select(
        "dt",
        F.struct("lon", "lat").alias("coord"),
        F.struct("temp", (F.col("temp") + 1).alias("feels_like"), F.lit(50.0).alias("humidity"), F.lit(1000.1).alias("pressure")).alias("main"),
        F.struct(F.lit(0.1).alias("speed")).alias("wind"),
        F.struct(F.lit(None).cast("double").alias("all")).alias("clouds"),
        F.when(F.col("wet").isNotNull(), F.struct(F.col("wet").alias("1h"))).alias("rain"),
    )


def readings(count, days=3):
    rng = random.Random(count)
    times = rng.sample(range(days * DAY), count)
    return [(START + t, 10.0 + rng.choice([0.001, 0.004]), rng.choice([20.0, 30.0]), rng.choice([None, rng.uniform(-5, 30)]), rng.choice([None, 0.7])) for t in times]


@pytest.fixture(scope="module")
def places(spark):
    city = spark.createDataFrame([(1, "Alpha", 7, 10.0, 20.0), (2, "Beta", 8, 9.996, 20.001), (3, "Gamma", 7, 10.0, 30.0)], schema.CITY)
    return city, None


def facts(spark, store):
    rows = spark.read.parquet(store.facts_path).drop("created_at")
    return sorted(map(tuple, rows.select(sorted(rows.columns)).collect()), key=str)


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_runs_gives_the_rows_of_one_run(spark, places, tmp_path, seed):
    rng, rows = random.Random(seed), readings(60)
    whole = HourlyStore(str(tmp_path / "whole"))
    run_new_documents(frame(spark, rows), *places, later(), whole, "only")
    parts = HourlyStore(str(tmp_path / "parts"))
    rng.shuffle(rows)  # late documents come with any run
    cuts = sorted(rng.sample(range(1, len(rows)), 2))
    for k, end in enumerate([*cuts, len(rows)]):
        again = rows[max(0, end - 25) : end]  # some were delivered before
        run_new_documents(frame(spark, again + rows[:end]), *places, later(), parts, f"run {k}")
    assert facts(spark, parts) == facts(spark, whole)
    days = [r[0] for r in spark.read.parquet(whole.sums_path).select("day").distinct().collect()]
    assert sorted(map(tuple, stored_sums(spark, parts, days).collect()), key=str) == sorted(map(tuple, stored_sums(spark, whole, days).collect()), key=str)
    # The means are those of the job that averages all documents of an hour.
    target = str(tmp_path / "fact")
    run_hourly(frame(spark, rows), *places, later(), target, hours_back=1000, bucket="1 hour")
    plain = {(r.idCity, r.Date, r.Hour): r for r in spark.read.parquet(target).collect()}
    mine = {(r.idCity, r.Date, r.Hour): r for r in spark.read.parquet(parts.facts_path).collect()}
    assert plain.keys() == mine.keys()
    for key, row in plain.items():
        assert row.measurement_count == mine[key].measurement_count
        assert (row.Temp is None) == (mine[key].Temp is None) and abs((row.Temp or 0) - (mine[key].Temp or 0)) < 0.0101


def test_a_run_touches_its_own_days_only(spark, places, tmp_path):
    store = HourlyStore(str(tmp_path / "s"))
    first = [(START + h * 3600, 10.0, 20.0, float(h), None) for h in range(72)]
    run_new_documents(frame(spark, first), *places, later(), store, "first")
    before = files_of(store.folder)
    late = [(START + DAY + 7, 10.0, 20.0, 5.0, None)]
    report = run_new_documents(frame(spark, first + late), *places, later(), store, "second").collect()
    assert [(r.stage, r.records) for r in report] == [("new documents", 1), ("aggregation", 2)]
    after = files_of(store.folder)
    gone = {f for f in before if f not in after}
    assert gone and all("/hourly/Date=2023-11-15/" in f for f in gone)  # the day's facts were replaced
    assert all(after[f] == before[f] for f in before if f not in gone)
    new = {f for f in after if f not in before}
    assert all("2023-11-15" in f or "/ledger/runs/" in f for f in new)


def test_keys_are_read_by_day(spark, places, tmp_path):
    store = HourlyStore(str(tmp_path / "s"))
    run_new_documents(frame(spark, [(START + h * 3600, 10.0, 20.0, 1.0, None) for h in range(72)]), *places, later(), store, "first")
    seen = store.ledger.unseen(frame(spark, [(START + 60, 10.0, 20.0, 1.0, None)]), "x")
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:200]


def test_rows_do_not_travel_by_run(spark, tmp_path):
    ledger = Ledger(str(tmp_path / "l"))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n long, run string")
    first = ledger.counting(rows, "b")
    assert "Exchange hashpartitioning" not in first._jdf.queryExecution().executedPlan().toString()
    assert [r.n for r in first.collect()] == [2]
    ledger.finish(spark, "a", later())
    assert sorted(r.n for r in ledger.counting(rows, "b").collect()) == [1, 2] and [r.n for r in ledger.counting(rows).collect()] == [1]


def test_one_of_each_key_is_picked_from_flat_rows_without_a_sort(spark, places, tmp_path, monkeypatch):
    plans, stage = {}, runs.stage
    monkeypatch.setattr(runs, "stage", lambda df, label: plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString()) and stage(df, label))
    rows = readings(30)
    run_new_documents(frame(spark, rows + rows[:5]), *places, later(), HourlyStore(str(tmp_path / "s")), "a")
    assert "HashAggregate" in plans["readings"] and "SortAggregate" not in plans["readings"]
    assert spark.read.parquet(str(tmp_path / "s/ledger/keys")).count() == 30


@pytest.mark.parametrize("broken", ["write_run", "record", "replace_rows", "finish"])
def test_a_retry_or_a_later_run_mends_a_broken_one(spark, places, tmp_path, monkeypatch, broken):
    rows = readings(12, days=1)
    whole = HourlyStore(str(tmp_path / "whole"))
    run_new_documents(frame(spark, rows), *places, later(), whole, "only")
    for follow in ("retry", "later"):
        store = HourlyStore(str(tmp_path / follow))
        run_new_documents(frame(spark, rows[:4]), *places, later(), store, "a")

        def fail(*args, **kw):
            raise OSError("lost")

        with monkeypatch.context() as patch:
            patch.setattr(Ledger if broken in ("record", "finish") else runs, broken, fail)
            with pytest.raises(OSError):
                run_new_documents(frame(spark, rows[:9]), *places, later(), store, "b")
        run_new_documents(frame(spark, rows), *places, later(), store, "b" if follow == "retry" else "c")
        assert facts(spark, store) == facts(spark, whole)
        assert store.ledger.processed(frame(spark, rows)).filter("processed").count() == 12


def test_nothing_new_writes_no_rows(spark, places, tmp_path):
    store = HourlyStore(str(tmp_path / "s"))
    docs = frame(spark, readings(6))
    run_new_documents(docs, *places, later(), store, "a")
    before = files_of(store.facts_path) | files_of(store.sums_path)
    assert [r.records for r in run_new_documents(docs, *places, later(), store, "b").collect()] == [0]
    assert files_of(store.facts_path) | files_of(store.sums_path) == before
    assert store.ledger.processed(frame(spark, readings(6) + [(None, 1.0, 1.0, 1.0, None)])).filter("not processed").count() == 1


def test_the_future_and_the_far_past_wait(spark, places, tmp_path):
    store = HourlyStore(str(tmp_path / "s"))
    docs = frame(spark, [(START + h * 3600, 10.0, 20.0, 1.0, None) for h in range(10)])
    report = run_new_documents(docs, *places, F.timestamp_seconds(F.lit(START + 5 * 3600)), store, "a", hours_back=2)
    assert report.first().records == 3


def test_sums_do_not_depend_on_the_order_of_adding(spark):
    flat = hourly.flatten(frame(spark, [(START + i, 10.0, 20.0, 0.1 * i, None) for i in range(500)]))
    whole = cell_sums(flat).collect()
    parts = [cell_sums(flat.filter(F.col("dt") % 7 == k)) for k in range(7)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    assert merged_sums(union).collect() == whole
    means = means_of(cell_sums(flat)).first()
    assert means.avg_temperature == 24.95 and means.avg_clouds is None and means.avg_precipitation == 0.0


def test_counts_come_with_the_write(spark, tmp_path):
    counts = StageCounts()
    spark.range(100).transform(lambda d: counts.watch(d, "all")).filter("id % 4 = 0").transform(lambda d: counts.watch(d, "kept")).write.parquet(str(tmp_path / "x"))
    counts.done("kept")
    counts.same_as("again", "kept")
    got = counts.report(spark).collect()
    assert [(r.step, r.stage, r.records) for r in got] == [(1, "all", 100), (2, "kept", 25), (3, "again", 25)]
    assert got[0].seconds is None and got[1].seconds > 0
