"""Readers, writers, landing and dimension upkeep on small files."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar import schema
from isobar.operators import hourly, joins
from isobar.operators.columns import METRIC_NAMES, IMPERIAL, canonical_hourly, metric_only
from isobar.plans.runs import prepare_observations, run_hourly
from isobar.sources import files, landing, tables

NOW = 1_700_003_600  # 2023-11-14 23:13:20 UTC


def document(dt, lon, lat, temp, rain=None, **extra):
    doc = {
        "dt": dt,
        "coord": {"lon": lon, "lat": lat},
        "main": {"temp": temp, "feels_like": temp + 1, "humidity": 50, "pressure": 1000},
        "wind": {"speed": 2},
        "clouds": {"all": 10},
        **extra,
    }
    if rain is not None:
        doc["rain"] = {"1h": rain}
    return json.dumps(doc)


@pytest.fixture
def clock():
    return F.timestamp_seconds(F.lit(NOW))


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [
        document(NOW - 10, 10.001, 20.004, 20.0),
        document(NOW - 3600, 10.004, 19.999, 30.0, rain=3.0),
        document(NOW - 3601, 10.0, 20.0, 99.0),
        document(NOW - 20, 50.0, 60.0, 5.0, processed=True),
        '{"dt": 17000',
    ]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    return str(tmp_path / "in")


@pytest.fixture
def places(spark):
    city = spark.createDataFrame(
        [(1, "Alpha", 7, 10.0, 20.0), (2, "Beta", 8, 9.996, 20.001), (3, "Gamma", 7, 50.0, 60.0)], schema.CITY
    )
    return city, spark.createDataFrame([(7, "North"), (8, "South")], schema.COUNTRY)


def test_hourly_means(spark, landed, clock, places):
    docs = files.read_documents(spark, landed)
    means = hourly.coordinate_means(hourly.flatten(hourly.recent_documents(docs, clock)))
    joined = {r.city_name: r for r in hourly.with_city(means, *places).collect()}
    # Both cities of the cell match; the reading one second too old does not count.
    assert joined["Alpha"].measurement_count == joined["Beta"].measurement_count == 2
    assert joined["Alpha"].avg_temperature == 25.0
    assert joined["Alpha"].avg_precipitation == 1.5  # the dry document counts as 0
    assert (joined["Alpha"].country, joined["Beta"].country) == ("North", "South")


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1, 1.0), (0.0, 0.0, 2, 1.01)], "lon double, lat double, dt long, temperature double")
    assert hourly.coordinate_means(df).first().avg_temperature == 1.01


def test_all_dry_batch(spark, tmp_path):
    (tmp_path / "x.json").write_text(document(1, 1.0, 1.0, 1.0))
    assert hourly.flatten(files.read_documents(spark, str(tmp_path))).first().precipitation == 0.0


def test_run_is_repeatable(spark, landed, clock, places, tmp_path):
    docs, target = files.read_documents(spark, landed), str(tmp_path / "fact")
    for _ in range(2):
        report = run_hourly(docs, *places, clock, target).collect()
    stored = spark.read.parquet(target)
    assert stored.count() == report[0].records == 3
    row = canonical_hourly(stored).first()
    assert (str(row.date), row.hour) == ("2023-11-14", 22)


def test_overlapping_runs_keep_every_reading(spark, places, tmp_path):
    """A reading every five minutes, runs at half past: no hour loses its first half."""
    start = 1_700_002_800  # 2023-11-14 23:00
    lines = [document(start + 300 * i, 10.0, 20.0, float(i)) for i in range(40)]
    (tmp_path / "five.json").write_text("\n".join(lines))
    docs, target = files.read_documents(spark, str(tmp_path / "five.json")), str(tmp_path / "fact")
    for minute in (30, 90, 150, 210):
        known = docs.filter(F.col("dt") <= start + 60 * minute)
        run_hourly(known, *places, F.timestamp_seconds(F.lit(start + 60 * minute)), target, bucket="1 hour")
    stored = {(r.Date.isoformat(), r.Hour): r for r in spark.read.parquet(target).filter("idCity = 1").collect()}
    counts = {k: r.measurement_count for k, r in stored.items()}
    assert counts == {("2023-11-14", 23): 12, ("2023-11-15", 0): 12, ("2023-11-15", 1): 12, ("2023-11-15", 2): 4}
    assert stored["2023-11-15", 0].Temp == 17.5


def test_a_run_for_some_cities_leaves_the_others(spark, landed, clock, places, tmp_path):
    docs, target = files.read_documents(spark, landed), str(tmp_path / "fact")
    run_hourly(docs, *places, clock, target)
    run_hourly(docs, places[0].filter("city_id = 3"), places[1], clock, target)
    assert sorted(r.idCity for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_unprocessed_hours_are_made_whole(spark, places, tmp_path):
    start = 1_700_002_800
    lines = [document(start + 600 * i, 10.0, 20.0, float(i), processed=i < 3) for i in range(9)]
    (tmp_path / "d.json").write_text("\n".join(lines))
    docs = files.read_documents(spark, str(tmp_path / "d.json"))
    target = str(tmp_path / "fact")
    now = F.timestamp_seconds(F.lit(start + 5400))
    run_hourly(docs, *places, now, target, hours_back=2, bucket="1 hour", only_unprocessed=True)
    counts = {r.Hour: r.measurement_count for r in spark.read.parquet(target).filter("idCity = 1").collect()}
    assert counts == {23: 6, 0: 3}
    again = str(tmp_path / "again")
    marked = joins.mark_processed(docs, F.lit(start), now)
    run_hourly(marked, *places, now, again, hours_back=2, bucket="1 hour", only_unprocessed=True)
    assert spark.read.schema(spark.read.parquet(target).schema).parquet(again).count() == 0


def test_a_document_from_the_future_waits(spark, places, tmp_path):
    start = 1_700_002_800
    (tmp_path / "d.json").write_text("\n".join(document(start + 600 * i, 10.0, 20.0, float(i)) for i in range(9)))
    docs, target = files.read_documents(spark, str(tmp_path / "d.json")), str(tmp_path / "fact")
    run_hourly(docs, *places, F.timestamp_seconds(F.lit(start + 1800)), target, bucket="1 hour")
    assert {r.measurement_count for r in spark.read.parquet(target).collect()} == {4}


def test_write_modes(spark, tmp_path):
    df, path = spark.range(2), str(tmp_path / "w")
    tables.write_table(df, path, if_exists="fail")
    for mode in ("replce", "overwrite", ""):
        with pytest.raises(ValueError):
            tables.write_table(df.limit(0), path, if_exists=mode)
    tables.write_table(df.limit(0), path, if_exists="ignore")
    with pytest.raises(Exception, match="exists"):
        tables.write_table(df, path, if_exists="fail")
    assert spark.read.parquet(path).count() == 2


def test_prepared_observations_invent_no_city(spark):
    rows = [(1 if i % 2 else 3, "2024-01-01", i % 24, 20.0 + i % 5, 0.0, 1.0, 50.0, 1013.0, 60.0) for i in range(80)]
    rows += [(None, "2024-01-01", 5, 20.0, 0.0, 1.0, 50.0, 1013.0, 60.0)] * 3 + [(1, "2024-01-02", 1, None, 0.0, 1.0, 50.0, 1013.0, 60.0)]
    stored = spark.createDataFrame(rows, "idCity long, Date string, Hour int, Temp double, Rain double, Wind double, Clouds double, Pressure double, Humidity double")
    stored = stored.withColumn("Date", F.to_date("Date"))
    raw, cleaned, table = prepare_observations(stored)
    assert raw.filter("city_id is null").count() == 3
    assert {r.city_id for r in cleaned.select("city_id").distinct().collect()} == {1, 3}
    assert dict(cleaned.dtypes)["city_id"] == "bigint" and table.count() == cleaned.count()


def test_landing_counts_and_stamp(spark, landed, places, clock):
    docs = files.read_documents(spark, landed)
    saved = F.coalesce(F.col("dt") > NOW - 3600, F.lit(False))
    row = landing.landing_counts(docs, saved).first()
    assert tuple(row) == (5, 4, 1, 2, 2)
    city = places[0].select(F.col("city_name").alias("city"), F.lit("North").alias("country"), "lat", "lon", "city_id")
    docs = spark.createDataFrame([(1, 5), (9, 6)], "city_id long, dt long")
    out = {r.city_id: r for r in landing.stamp(docs, city, ["city_id"], clock).collect()}
    assert out[1].city_info.city == "Alpha" and out[9].city_info is None and out[1].processed is False
    assert out[1].fetch_timestamp == "2023-11-14T23:13:20.000000+00:00"


def test_mark_processed(spark, landed, clock):
    docs = files.read_documents(spark, landed).filter("dt IS NOT NULL")
    out = joins.mark_processed(docs, F.lit(NOW - 3600), clock).collect()
    marked = {r.dt: (r.processed, r.processed_at is not None) for r in out}
    assert marked == {
        NOW - 10: (True, True), NOW - 3600: (True, True), NOW - 3601: (False, False), NOW - 20: (True, False)
    }


def test_frames_by_format(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", "2024-01-01 05:00:00"), (2, None, "never")], "id int, name string, at string")
    path = str(tmp_path / "c")
    files.write_frame(df, path, "csv")
    back = {r.id: r for r in files.read_csv(spark, path, df.schema, parse_dates=["at"]).collect()}
    assert back[1].name == "a,b" and back[1].at.hour == 5 and back[2].at is None and back[2].name is None
    files.write_frame(df, str(tmp_path / "p"), "parquet")
    assert files.read_frame(spark, str(tmp_path / "p"), "parquet").count() == 2
    for call in (lambda: files.write_frame(df, path, "xml"), lambda: files.read_frame(spark, path, "xml")):
        with pytest.raises(ValueError):
            call()
    listed = files.list_objects(spark, str(tmp_path), pattern="*.parquet")
    assert listed.columns == ["path", "modificationTime", "length"]
    assert all(r.path.endswith(".parquet") and r.length > 0 for r in listed.collect())


def test_typed_sink(spark, tmp_path):
    rows = spark.createDataFrame([("SP", 20, "2024-01-01 00:00:00"), ("RJ", 21, "bad")], "location string, temperature int, recorded_at string")
    rows = rows.withColumns({c: F.lit(1) for c in ("humidity", "pressure", "wind_speed", "wind_direction", "precipitation", "rain_probability", "extra")})
    path = str(tmp_path / "t")
    tables.write_table(rows, path, schema.READING)
    tables.write_table(rows, path, schema.READING, if_exists="append")
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and stored.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.READING]
    assert stored.filter("recorded_at IS NULL").count() == 2
    tables.write_table(rows, path, schema.READING, if_exists="replace")
    assert spark.read.parquet(path).count() == 2


def test_parameters_are_values(spark):
    df = spark.createDataFrame([("x' OR '1'='1",), ("y",)], "name string")
    sql = "SELECT count(*) AS n FROM names WHERE name = :who"
    assert tables.read_query(spark, sql, {"who": "x' OR '1'='1"}, {"names": df}).first().n == 1


def test_jdbc_options(spark):
    """No database here, so only what would be asked of the driver is checked."""
    assert tables.Slices("id", 0, 100, 8).options() == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"
    }


def test_named_sources():
    assert tables.load_processed_data("weather_db", lambda name: name) == "weather_data"
    assert tables.load_processed_data("iot_weather_db", {"iot_weather_db": lambda name: name}) == "weather_hour"
    with pytest.raises(ValueError):
        tables.load_processed_data("other", lambda name: name)


def test_metric_names(spark):
    df = spark.createDataFrame([(1,) * 12], T.StructType([T.StructField(c, T.IntegerType()) for c in [*IMPERIAL, *METRIC_NAMES]]))
    assert metric_only(df).columns == list(METRIC_NAMES.values())


@pytest.mark.parametrize("block_rows", [1_000_000, 2])
def test_upsert(spark, block_rows):
    country = spark.createDataFrame([(5, "North")], schema.COUNTRY)
    city = spark.createDataFrame([(9, "Alpha", 5, 0.0, 0.0)], schema.CITY)
    listed = spark.createDataFrame(
        [("Alpha", "North", 1.0, 1.0), ("Alpha", "South", 2.0, 2.0), ("Beta", "South", 3.0, 3.0), ("Beta", "South", 4.0, 4.0)],
        "city string, country string, lat double, lon double",
    )
    for _ in range(2):  # the second round changes nothing
        country, city = joins.upsert_cities(listed, country, city, block_rows=block_rows)
    assert sorted(map(tuple, country.collect())) == [(5, "North"), (6, "South")]
    rows = sorted(map(tuple, city.select("city_id", "city_name", "country_id", "lon").collect()))
    assert rows == [(9, "Alpha", 5, 0.0), (10, "Alpha", 6, 2.0), (11, "Beta", 6, 3.0)]


@pytest.mark.parametrize("others, expected", [([1, 3], [2]), ([1, None], []), ([], [None, 1, 2, 3]), ([None], [])])
def test_not_in(spark, others, expected):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    other = spark.createDataFrame([(o,) for o in others], "o int")
    found = sorted((r.k for r in joins.not_in(df, "k", other, "o").collect()), key=lambda k: (k is not None, k))
    assert found == expected
    df.createOrReplaceTempView("left_keys")
    other.createOrReplaceTempView("right_keys")
    sql = spark.sql("SELECT k FROM left_keys WHERE k NOT IN (SELECT o FROM right_keys)")
    assert sorted((r.k for r in sql.collect()), key=lambda k: (k is not None, k)) == expected


def test_replaced_rows_are_met_by_sorting(spark, tmp_path, monkeypatch):
    """The keys of the new rows are as many as the rows: only the partitions they touch may be broadcast.  Null keys replace nothing."""
    columns, target, seen = "day int, hour int, id int, x int", str(tmp_path / "t"), []
    tables.replace_rows(spark.createDataFrame([(1, 1, 1, 0), (1, 2, 1, 0), (1, 1, None, 0), (2, 1, 1, 0)], columns), target, ["day"], ["hour", "id"])
    stage = tables.stage
    monkeypatch.setattr(tables, "stage", lambda df, label: seen.append(df._jdf.queryExecution().executedPlan().toString()) or stage(df, label))
    tables.replace_rows(spark.createDataFrame([(1, 1, 1, 5), (1, 1, 1, 6), (1, 1, None, 7)], columns), target, ["day"], ["hour", "id"])
    rows = spark.read.parquet(target).select("day", "hour", "id", "x").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [(1, 1, 1, 5), (1, 1, 1, 6), (1, 1, None, 7), (1, 1, None, 0), (1, 2, 1, 0), (2, 1, 1, 0)]))
    assert len(seen) == 1 and re.search(r"SortMergeJoin \[day#\d+, hour#\d+, id#\d+\].*LeftAnti", seen[0])
