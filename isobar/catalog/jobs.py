"""The jobs end to end, and the forecaster where SQL can follow it."""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.catalog import CITIES, DOCUMENTS, HOURLY, Tables, query
from isobar.operators import quality
from isobar.operators.columns import canonical_hourly
from isobar.operators.grid import without_holes
from isobar.operators.quality import StageCounts
from isobar.plans.forecast import Forecaster, Orders
from isobar.plans.runs import HourlyStore, final_report, prepare_observations, run_hourly, run_new_documents, stored_sums
from isobar.sources import files
from isobar.staging import new_path, stage
from isobar.streaming import hourly as streaming

MEANS = ["Temp", "FeelsLike", "Clouds", "Rain", "Wind", "Pressure", "Humidity"]


def _near(stored: str, exact: str):
    """Whether a stored mean is the exact one rounded to two digits, whichever way a tie went."""
    return F.abs(F.col(stored) - F.col(exact)) <= 0.005 + 1e-9


# ---- hourly job --------------------------------------------------------------


@query(
    "hourly_job",
    f"""WITH {DOCUMENTS}, {CITIES},
    a AS (SELECT lon, lat, date_trunc('hour', ts) AS period, count(*) AS measurement_count FROM d GROUP BY 1, 2, 3)
    SELECT c.city_id, CAST(CAST(a.period AS DATE) AS VARCHAR) AS date, CAST(hour(a.period) AS INTEGER) AS hour, a.measurement_count,
           true AS means_near
    FROM a JOIN cities c ON a.lon = round(c.lon, 2) AND a.lat = round(c.lat, 2)""",
)
def hourly_job(t: Tables) -> DataFrame:
    """Two runs whose documents overlap, the first one ending at half past an hour: every hour holds exactly its readings."""
    docs = t.documents_nested.drop("processed").withColumn("processed", F.lit(False))
    target = new_path(t.spark, "fact")
    known = docs.filter("dt <= 1705314600")  # 2024-01-15 10:30, the first run's clock
    run_hourly(known, t.cities, t.countries, F.lit("2024-01-15 10:30:00").cast("timestamp"), target, hours_back=1_000_000, bucket="1 hour")
    hours = F.lit("2024-01-31 00:00:00").cast("timestamp")
    run_hourly(docs, t.cities, t.countries, hours, target, hours_back=374, bucket="1 hour")
    stored = t.spark.read.parquet(target).select("idCity", F.col("Date").cast("string").alias("date"), F.col("Hour").alias("hour"), "measurement_count", *MEANS)
    # The exact means again, from the flat readings.
    place = [F.round("lon", 2).alias("lon"), F.round("lat", 2).alias("lat")]
    flat = streaming.hourly.flatten(docs).withColumn("at", F.timestamp_seconds("dt"))
    names = {"Temp": "temperature", "FeelsLike": "feels_like", "Clouds": "clouds", "Rain": "precipitation", "Wind": "wind_speed", "Pressure": "pressure", "Humidity": "humidity"}
    exact = flat.groupBy(*place, F.date_trunc("hour", "at").alias("period")).agg(*[F.avg(v).alias(f"x_{k}") for k, v in names.items()])
    cells = t.cities.select(F.col("city_id").alias("idCity"), *place)
    exact = exact.join(cells, ["lon", "lat"]).select("idCity", F.to_date("period").cast("string").alias("date"), F.hour("period").alias("hour"), *[f"x_{k}" for k in names])
    joined = stored.join(exact, ["idCity", "date", "hour"], "left")
    near = F.lit(True)
    for k in names:
        near = near & F.coalesce(_near(k, f"x_{k}"), F.col(k).isNull() & F.col(f"x_{k}").isNull())
    return joined.select(F.col("idCity").alias("city_id"), "date", "hour", "measurement_count", near.alias("means_near"))


# ---- hourly job by new documents ---------------------------------------------

# Sums are exact, so both sides divide the same numbers; the mean is rounded as a decimal.
_SUMMED = {"temperature": "Temp", "feels_like": "FeelsLike", "clouds": "Clouds", "precipitation": "Rain", "wind_speed": "Wind", "pressure": "Pressure", "humidity": "Humidity"}
_FACT = f"""{DOCUMENTS}, {CITIES},
    a AS (SELECT lon, lat, date_trunc('hour', ts) AS period, count(*) AS n, max(dt) AS latest, {", ".join(f"sum(CAST({m} AS DECIMAL(28,10))) AS sum_{m}" for m in _SUMMED)}
          FROM d GROUP BY 1, 2, 3),
    f AS (SELECT c.city_id, a.period, a.n, {", ".join(f"CAST(round(CAST(CAST(sum_{m} AS DOUBLE) / n AS DECIMAL(38,12)), 2) AS DOUBLE) AS {m}" for m in _SUMMED)}
          FROM a JOIN cities c ON a.lon = round(c.lon, 2) AND a.lat = round(c.lat, 2))"""


def _month_end():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def _store(t: Tables) -> HourlyStore:
    return HourlyStore(new_path(t.spark, "store"), keys=("event_id",))


def _in_four_runs(t: Tables) -> HourlyStore:
    """Four runs over documents that come in any order; each run is offered all that came before once more."""
    store, docs = _store(t), t.documents_nested.drop("processed")
    for k in range(4):
        known = docs.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) <= k)
        run_new_documents(known, t.cities, t.countries, _month_end(), store, f"run {k}")
    return store


@query(
    "hourly_increments",
    f"""WITH {_FACT}
    SELECT city_id, CAST(CAST(period AS DATE) AS VARCHAR) AS date, CAST(hour(period) AS INTEGER) AS hour, n AS measurement_count,
           {", ".join(f"{m} AS {c}" for m, c in _SUMMED.items())} FROM f""",
)
def hourly_increments(t: Tables) -> DataFrame:
    """Hourly rows merged from four runs are those of all documents at once, to the last digit."""
    rows = t.spark.read.parquet(_in_four_runs(t).facts_path)
    return rows.select(F.col("idCity").alias("city_id"), F.col("Date").cast("string").alias("date"), F.col("Hour").alias("hour"), "measurement_count", *MEANS)


@query(
    "hourly_sums",
    f"""WITH {_FACT}
    SELECT lon, lat, CAST(epoch(period) AS BIGINT) // 3600 AS hour, n AS readings, latest, CAST(sum_temperature AS VARCHAR) AS sum_temperature,
           CAST(sum_precipitation AS VARCHAR) AS sum_precipitation FROM a""",
)
def hourly_sums(t: Tables) -> DataFrame:
    """The stored sums of all days, merged over the runs."""
    store = _in_four_runs(t)
    days = [r[0] for r in t.spark.read.parquet(store.sums_path).select("day").distinct().collect()]
    sums = stored_sums(t.spark, store, days)
    exact = [F.col(c).cast("string").alias(c) for c in ("sum_temperature", "sum_precipitation")]
    return sums.select("lon", "lat", "hour", "readings", "latest", *exact)


@query(
    "processed_ledger",
    "SELECT event_id, epoch(ts) <= 1705314600 AS processed FROM events",
)
def processed_ledger(t: Tables) -> DataFrame:
    """What the ledger says of every document after a run whose clock stood at 2024-01-15 10:30."""
    store, docs = _store(t), t.documents_nested.drop("processed")
    now = F.timestamp_seconds(F.lit(1705314600))
    run_new_documents(docs, t.cities, t.countries, now, store, "half")
    return store.ledger.processed(docs).select("event_id", "processed")


# ---- preparation and report --------------------------------------------------


def _fact(t: Tables) -> DataFrame:
    """The stored hourly table with gaps, every seventh city without its id."""
    store = _store(t)
    run_new_documents(t.documents_nested.drop("processed"), t.cities, t.countries, _month_end(), store, "all")
    hour = F.col("Hour")
    return t.spark.read.parquet(store.facts_path).withColumns(
        {"idCity": F.when(F.col("idCity") % 7 != 0, F.col("idCity")), "Temp": F.when(hour % 5 != 2, F.col("Temp")), "Humidity": F.when(hour % 7 != 3, F.col("Humidity"))}
    )


def _fences() -> str:
    """The five measures' quartile fences, each from the rows the ones before have left."""
    steps, before = [], "k"
    for n, c in enumerate(["temperature", "humidity", "pressure", "wind_speed", "precipitation"]):
        steps.append(
            f"b{n} AS (SELECT quantile_cont({c}, 0.25) AS low, quantile_cont({c}, 0.75) AS high FROM {before}), "
            f"k{n} AS (SELECT {before}.* FROM {before}, b{n} WHERE {c} BETWEEN low - 1.5 * (high - low) AND high + 1.5 * (high - low))"
        )
        before = f"k{n}"
    return ", ".join(steps)


_PREPARED = f"""{_FACT},
    g AS (SELECT * REPLACE (CASE WHEN hour(period) % 5 <> 2 THEN temperature END AS temperature, CASE WHEN hour(period) % 7 <> 3 THEN humidity END AS humidity)
          FROM f WHERE city_id % 7 <> 0),
    k AS (SELECT * REPLACE (coalesce(temperature, (SELECT median(temperature) FROM g)) AS temperature, coalesce(humidity, (SELECT median(humidity) FROM g)) AS humidity)
          FROM g), {_fences()},
    p AS (SELECT * REPLACE (least(greatest(humidity, 0), 100) AS humidity) FROM k4)"""


@query(
    "prepared",
    f"""WITH {_PREPARED}
    SELECT city_id, CAST(CAST(period AS DATE) AS VARCHAR) AS date, CAST(hour(period) AS INTEGER) AS hour,
           CAST(isodow(period) - 1 AS INTEGER) AS day_of_week, temperature, humidity, pressure, wind_speed, precipitation,
           round(temperature * humidity, 6) AS temp_humidity_interaction, round(wind_speed * pressure, 6) AS wind_pressure_interaction,
           round(coalesce(pressure - lag(pressure) OVER (PARTITION BY city_id ORDER BY period), 0), 6) AS pressure_tendency,
           CAST(precipitation > 0 AS INTEGER) AS rain_flag
    FROM p""",
)
def prepared(t: Tables) -> DataFrame:
    """The preparation job as it runs: gaps filled, outliers of all measures dropped, features made; rows without a city belong to no series."""
    _, _, table = prepare_observations(_fact(t))
    exact = ["city_id", "hour", "day_of_week", "temperature", "humidity", "pressure", "wind_speed", "precipitation"]
    made = ["temp_humidity_interaction", "wind_pressure_interaction", "pressure_tendency"]
    return table.select(*exact, F.col("date").cast("string").alias("date"), *[F.round(c, 6).alias(c) for c in made], F.col("rain_flag").cast("int").alias("rain_flag"))


# ---- files -------------------------------------------------------------------


@query("file_catalogue", "SELECT 'events.parquet' AS name, count(*) AS n, true AS has_bytes FROM events")
def file_catalogue(t: Tables) -> DataFrame:
    """The files of a table, each with the rows read from it."""
    listed = files.list_objects(t.spark, t.folder, pattern="events.parquet")
    name = F.element_at(F.split("path", "/"), -1)
    counts = t.events.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    found = listed.select(name.alias("name"), (F.col("length") > 0).alias("has_bytes"))
    return found.join(counts, "name").select("name", "n", "has_bytes")


# ---- document stream ---------------------------------------------------------


@query(
    "stream_documents",
    f"""WITH {DOCUMENTS}, {CITIES},
    u AS (SELECT DISTINCT lon, lat, dt, temperature FROM d),
    a AS (SELECT lon, lat, dt // 3600 AS hour_number, count(*) AS measurement_count FROM u
          GROUP BY 1, 2, 3)
    SELECT c.city_id, CAST(CAST(make_timestamp(a.hour_number * 3600000000) AS DATE) AS VARCHAR) AS date,
           CAST(a.hour_number % 24 AS INTEGER) AS hour, a.measurement_count
    FROM a JOIN cities c ON a.lon = round(c.lon, 2) AND a.lat = round(c.lat, 2)
    WHERE (a.hour_number + 1) * 3600 <= (SELECT max(dt) FROM d) - 3600""",
)
def stream_documents(t: Tables) -> DataFrame:
    """JSON documents through the document stream in two drains, every tenth one twice; hours the watermark has closed."""
    docs = t.documents_nested
    again = docs.filter("event_id % 10 = 0")
    folder, target, offsets = (new_path(t.spark, n) for n in ("landed", "stream", "offsets"))
    for part in (F.col("dt") < 1705314600, F.col("dt") >= 1705314600):
        docs.filter(part).unionByName(again.filter(part)).drop("event_id", "processed").write.mode("append").json(folder)
        rows = streaming.hourly_stream(streaming.document_stream(t.spark, folder), t.cities, t.countries)
        streaming.write_periods(rows, target, offsets).awaitTermination()
    stored = canonical_hourly(t.spark.read.parquet(target))
    return stored.select("city_id", F.col("date").cast("string").alias("date"), "hour", "measurement_count")


@query(
    "stream_late",
    """WITH d AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS dt, event_id FROM events),
    p AS (SELECT *, event_id % 5 = 1 OR dt >= 1705314600 AS second FROM d)
    SELECT count(*) AS rows_read,
           count(*) FILTER (second AND dt <= (SELECT max(dt) FROM p WHERE NOT second) - 3600) AS rows_late FROM p""",
)
def stream_late(t: Tables) -> DataFrame:
    """Two drains, the second one with documents older than the watermark: what was read and what came too late, from the stored counters."""
    docs = t.documents_nested
    folder, target, offsets, counters = (new_path(t.spark, n) for n in ("landed", "stream", "offsets", "counters"))
    second = (F.col("event_id") % 5 == 1) | (F.col("dt") >= 1705314600)
    for part in (~second, second):
        docs.filter(part).drop("event_id", "processed").write.mode("append").json(folder)
        rows = streaming.hourly_stream(streaming.document_stream(t.spark, folder), t.cities, t.countries)
        streaming.drain(rows, target, offsets, counters)
    return t.spark.read.parquet(counters).agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_late").alias("rows_late"))


# ---- a forecaster that SQL can follow ----------------------------------------

# Seasonal difference and one autoregressive term, with a constant.
_STEPS = """
    i AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY observed_at) AS i, count(*) OVER (PARTITION BY city) AS total FROM {source}),
    w AS (SELECT *, temperature - lag(temperature, 24) OVER (PARTITION BY city ORDER BY observed_at) AS w FROM i),
    l AS (SELECT *, lag(w) OVER (PARTITION BY city ORDER BY observed_at) AS w1 FROM w)"""
_AR = HOURLY + "," + _STEPS.format(source="h")
_FIT = """
    m AS (SELECT city, regr_slope(w, w1) AS a, regr_intercept(w, w1) AS c, regr_count(w, w1) AS n,
                 (regr_syy(w, w1) - regr_slope(w, w1) * regr_sxy(w, w1)) / regr_count(w, w1) AS s2
          FROM l WHERE {rows} GROUP BY city),
    e AS (SELECT city, arg_max(w, i) AS w, max(i) AS last FROM w WHERE {rows} GROUP BY city)"""
_TRAIN = _AR + "," + _FIT.format(rows="i <= floor(0.8::DOUBLE * total)")
_WHOLE = _AR + "," + _FIT.format(rows="true")
_PATH = """
    s AS (SELECT i.city, i.observed_at, i.i, i.temperature AS actual, i.i - e.last AS h, CAST(ceil((i.i - e.last) / 24.0) AS BIGINT) AS k, e.last
          FROM i JOIN e USING (city) WHERE i.i > e.last),
    p AS (SELECT s.city, s.observed_at, any_value(s.actual) AS actual,
                 any_value(y.temperature) + sum(m.c * (1 - m.a ** (s.h - 24 * j)) / (1 - m.a) + m.a ** (s.h - 24 * j) * e.w) AS prediction
          FROM s JOIN m USING (city) JOIN e USING (city) JOIN i y ON y.city = s.city AND y.i = s.i - 24 * s.k, unnest(range(s.k)) AS u(j)
          GROUP BY 1, 2)"""


def _ar_spec() -> Forecaster:
    return Forecaster(["city"], ["observed_at"], orders=Orders((1, 0, 0), (0, 1, 0, 24), constant=True))


def _ar_trained(t: Tables):
    spec = _ar_spec()
    return spec, spec.fit(stage(spec.split(t.hourly), "split"))


@query("ar_predictions", f"WITH {_TRAIN},{_PATH} SELECT city, observed_at, round(actual, 6) AS actual, round(prediction, 5) AS prediction FROM p")
def ar_predictions(t: Tables) -> DataFrame:
    spec, fitted = _ar_trained(t)
    out = spec.test_predictions(fitted)
    return out.withColumns({"actual": F.round("actual", 6), "prediction": F.round("prediction", 5)})


@query(
    "ar_evaluation",
    f"""WITH {_TRAIN},{_PATH},
    z AS (SELECT city, count(*) FILTER (i <= floor(0.8::DOUBLE * total)) AS train_size,
                 count(*) FILTER (i > floor(0.8::DOUBLE * total)) AS test_size FROM i GROUP BY 1),
    x AS (SELECT city, avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) ** 2)) AS rmse,
                 1 - sum((actual - prediction) ** 2) / (var_pop(actual) * count(*)) AS r2 FROM p GROUP BY 1)
    SELECT city, round(mae, 5) AS mae, round(rmse, 5) AS rmse, round(r2, 5) AS r2,
           round(6 + n * (ln(2 * pi() * s2) + 1), 4) AS aic, round(3 * ln(n) + n * (ln(2 * pi() * s2) + 1), 4) AS bic,
           train_size, test_size, 0 AS exog_features, 'no_exog' AS model_used
    FROM x JOIN m USING (city) JOIN z USING (city)""",
)
def ar_evaluation(t: Tables) -> DataFrame:
    spec, fitted = _ar_trained(t)
    out = spec.evaluate(fitted)
    return out.withColumns({c: F.round(c, 4 if c in ("aic", "bic") else 5) for c in ("mae", "rmse", "r2", "aic", "bic")})


@query(
    "ar_diagnostics",
    f"""WITH {_TRAIN},
    o AS (SELECT city, w - c - a * w1 AS r FROM l JOIN m USING (city) WHERE i <= floor(0.8::DOUBLE * total) AND w1 IS NOT NULL),
    x AS (SELECT city, stddev_pop(r) AS s, skewness(r) AS k3, kurtosis(r) AS k4 FROM o GROUP BY 1)
    SELECT city, round(-0.5 * n * (ln(2 * pi() * s2) + 1), 4) AS llf, CAST(n AS BIGINT) AS n_obs, round(s, 5) AS resid_std, round(k3, 4) AS resid_skew,
           round(k4, 4) AS resid_kurtosis FROM x JOIN m USING (city)""",
)
def ar_diagnostics(t: Tables) -> DataFrame:
    spec, fitted = _ar_trained(t)
    out = spec.diagnostics(fitted)
    digits = {"llf": 4, "resid_std": 5, "resid_skew": 4, "resid_kurtosis": 4}
    return out.select("city", "n_obs", *[F.round(c, d).alias(c) for c, d in digits.items()])


_AHEAD = """
    g AS (SELECT city, u.s AS step, y.temperature + m.c * (1 - m.a ** u.s) / (1 - m.a) + m.a ** u.s * e.w AS prediction,
                 1.959963984540054::DOUBLE * sqrt(m.s2 * (1 - m.a ** (2 * u.s)) / (1 - m.a ** 2)) AS half
          FROM m JOIN e USING (city), unnest(range(1, 25)) AS u(s) JOIN i y ON y.city = m.city AND y.i = e.last + u.s - 24)"""


@query(
    "ar_forecast",
    f"""WITH {_WHOLE},{_AHEAD}
    SELECT city, CAST(step AS INTEGER) AS step, round(prediction, 5) AS prediction, round(prediction - half, 5) AS lower,
           round(prediction + half, 5) AS upper, 'no_exog' AS model_used FROM g""",
)
def ar_forecast(t: Tables) -> DataFrame:
    spec = _ar_spec()
    out = spec.forecast(spec.fit(stage(t.hourly, "hourly")), 24)
    return out.withColumns({c: F.round(c, 5) for c in ("prediction", "lower", "upper")})


@query(
    "ar_forecast_summary",
    f"""WITH {_WHOLE},{_AHEAD}
    SELECT city, round(avg(prediction), 5) AS next_avg, round(min(prediction), 5) AS min_predicted, round(max(prediction), 5) AS max_predicted,
           count(*) AS predictions_count, round(stddev_pop(prediction), 5) AS std_deviation FROM g GROUP BY 1""",
)
def ar_forecast_summary(t: Tables) -> DataFrame:
    spec = _ar_spec()
    out = quality.forecast_summary(spec.forecast(spec.fit(stage(t.hourly, "hourly")), 24), ["city"])
    return out.withColumns({c: F.round(c, 5) for c in ("next_avg", "min_predicted", "max_predicted", "std_deviation")})


@query(
    "job_report",
    f"""WITH {_PREPARED}, t AS (
      WITH {_TRAIN},{_PATH},
      x AS (SELECT city, avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) ** 2)) AS rmse,
                   1 - sum((actual - prediction) ** 2) / (var_pop(actual) * count(*)) AS r2 FROM p GROUP BY 1)
      SELECT avg(mae) AS mae, avg(rmse) AS rmse, avg(r2) AS r2 FROM x),
    w AS (
      WITH {_WHOLE},{_AHEAD}
      SELECT city, avg(prediction) AS middle, min(prediction) AS low, max(prediction) AS high FROM g GROUP BY 1),
    rows AS (
      SELECT 'stage' AS section, 'raw' AS name, 'records' AS item, CAST(count(*) AS DOUBLE) AS value FROM f
      UNION ALL SELECT 'stage', 'clean', 'records', count(*) FROM p
      UNION ALL SELECT 'stage', 'features', 'records', count(*) FROM p
      UNION ALL SELECT 'quality', 'all', 'data_quality_score', 1.0
      UNION ALL SELECT 'model', 'all', 'avg_mae', mae FROM t
      UNION ALL SELECT 'model', 'all', 'avg_rmse', rmse FROM t
      UNION ALL SELECT 'model', 'all', 'avg_r2', r2 FROM t
      UNION ALL SELECT 'forecast', city, 'next_avg', middle FROM w
      UNION ALL SELECT 'forecast', city, 'min_predicted', low FROM w
      UNION ALL SELECT 'forecast', city, 'max_predicted', high FROM w)
    SELECT section, name, item, round(value, 5) AS value FROM rows""",
)
def job_report(t: Tables) -> DataFrame:
    """The run report: stages counted while they are written, the quality score, the models' mean errors, and each city's forecast."""
    counts = StageCounts()
    _, cleaned, _ = prepare_observations(_fact(t), counts=counts)
    score = quality.completeness(cleaned.select("temperature", "humidity", "pressure"))
    spec, fitted = _ar_trained(t)
    forecast = spec.forecast(spec.fit(stage(t.hourly, "hourly")), 24)
    report = final_report(counts.report(t.spark), score=score, evaluation=spec.evaluate(fitted), forecast=forecast, keys=["city"])
    return report.filter("item <> 'seconds'").withColumn("value", F.round("value", 5))


# ---- the regular grid --------------------------------------------------------

_HOLES = f"""{HOURLY},
    q AS (SELECT city, observed_at, temperature, row_number() OVER (PARTITION BY city ORDER BY observed_at) AS at FROM h
          QUALIFY (CAST(epoch(observed_at) AS BIGINT) // 3600 * 7 + length(city)) % 11 NOT IN (3, 4)),
    e AS (SELECT city, min(observed_at) AS low, max(observed_at) AS high FROM q GROUP BY 1),
    z AS (SELECT city, unnest(generate_series(low, high, INTERVAL 1 HOUR)) AS observed_at FROM e),
    n AS (SELECT z.city, z.observed_at, q.temperature AS v, row_number() OVER (PARTITION BY z.city ORDER BY z.observed_at) AS i
          FROM z LEFT JOIN q ON q.city = z.city AND q.observed_at = z.observed_at),
    b AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY city ORDER BY i) AS bi,
                 min(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY city ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ai FROM n),
    g AS (SELECT b.city, b.observed_at, b.v IS NULL AS was_missing,
                 CASE WHEN b.v IS NOT NULL THEN b.v ELSE p.v + (a.v - p.v) * (b.i - b.bi) / (b.ai - b.bi) END AS temperature
          FROM b LEFT JOIN n p ON p.city = b.city AND p.i = b.bi LEFT JOIN n a ON a.city = b.city AND a.i = b.ai)"""


def _with_holes(t: Tables) -> DataFrame:
    """The hourly series without two hours in eleven."""
    hour = F.floor(F.unix_seconds(F.col("observed_at").cast("timestamp")) / 3600)
    return t.hourly.filter(~((hour * 7 + F.length("city")) % 11).isin(3, 4))


@query("hour_grid", f"WITH {_HOLES} SELECT city, observed_at, temperature, was_missing FROM g")
def hour_grid(t: Tables) -> DataFrame:
    """Every hour of every series, with lines through the holes."""
    rows = _with_holes(t).select("city", "observed_at", "temperature", F.lit(True).alias("given"))
    out = without_holes(rows, ["city"], "observed_at", ["temperature"])
    return out.select("city", "observed_at", "temperature", F.col("given").isNull().alias("was_missing"))


_GRID_TRAIN = _HOLES.replace(" e AS (", " ends AS (").replace("FROM e)", "FROM ends)") + "," + _STEPS.format(source="g") + "," + _FIT.format(rows="i <= floor(0.8::DOUBLE * total)")


@query(
    "grid_predictions",
    f"WITH {_GRID_TRAIN},{_PATH} SELECT city, observed_at, round(actual, 6) AS actual, round(prediction, 5) AS prediction FROM p",
)
def grid_predictions(t: Tables) -> DataFrame:
    """A forecaster that puts series with holes on the grid first."""
    spec = replace(_ar_spec(), unit="hour")
    ready = spec.prepare(_with_holes(t), minimum=1, minimum_complete=1)
    out = spec.test_predictions(spec.fit(stage(spec.split(ready), "split")))
    return out.withColumns({"actual": F.round("actual", 6), "prediction": F.round("prediction", 5)})


# ---- a moving average --------------------------------------------------------

# Three regressions: one long lag for innovations, their lag, and the lag of the model's own errors.
_MA = f"""{HOURLY},
    i AS (SELECT city, observed_at, temperature AS w, row_number() OVER (PARTITION BY city ORDER BY observed_at) AS i,
                 count(*) OVER (PARTITION BY city) AS total FROM h),
    t AS (SELECT *, lag(w) OVER (PARTITION BY city ORDER BY i) AS w1 FROM i WHERE {{rows}}),
    s1 AS (SELECT city, regr_slope(w, w1) AS a, regr_intercept(w, w1) AS c FROM t GROUP BY 1),
    e1 AS (SELECT t.city, i, w, coalesce(w - c - a * w1, 0) AS e FROM t JOIN s1 USING (city)),
    z1 AS (SELECT city, w, coalesce(lag(e) OVER (PARTITION BY city ORDER BY i), 0) AS x FROM e1),
    s2 AS (SELECT city, least(greatest(regr_slope(w, x), -1 / 1.02::DOUBLE), 1 / 1.02::DOUBLE) AS b, regr_intercept(w, x) AS c FROM z1 GROUP BY 1),
    e2 AS (SELECT t.city, t.i, t.w, t.w - s2.c AS e FROM t JOIN s2 USING (city) WHERE t.i = 1
           UNION ALL
           SELECT t.city, t.i, t.w, t.w - s2.c - s2.b * e2.e FROM e2 JOIN t ON t.city = e2.city AND t.i = e2.i + 1 JOIN s2 ON s2.city = t.city),
    z2 AS (SELECT city, i, w, e, coalesce(lag(e) OVER (PARTITION BY city ORDER BY i), 0) AS x FROM e2),
    m AS (SELECT city, regr_slope(w, x) AS b, regr_intercept(w, x) AS c, regr_count(w, x) AS n,
                 (regr_syy(w, x) - regr_slope(w, x) * regr_sxy(w, x)) / regr_count(w, x) AS s2, arg_max(e, i) AS e, max(i) AS last FROM z2 GROUP BY 1)"""
_MA_TRAIN, _MA_WHOLE = _MA.format(rows="i <= floor(0.8::DOUBLE * total)"), _MA.format(rows="true")


def _ma_spec() -> Forecaster:
    return Forecaster(["city"], ["observed_at"], orders=Orders((0, 0, 1), (0, 0, 0, 0), constant=True, long=1), refine=1)


@query("ma_fit", f"WITH RECURSIVE {_MA_WHOLE} SELECT city, round(b, 5) AS ma1, round(c, 5) AS intercept, round(s2, 4) AS sigma2, CAST(n AS BIGINT) AS n_obs FROM m")
def ma_fit(t: Tables) -> DataFrame:
    model = _ma_spec().fit(stage(t.hourly, "hourly")).no_exog
    beta = F.col("coefficients")
    return model.select("city", F.round(beta[0], 5).alias("ma1"), F.round(beta[1], 5).alias("intercept"), F.round("sigma2", 4).alias("sigma2"), F.col("n_obs").cast("long"))


@query(
    "ma_evaluation",
    f"""WITH RECURSIVE {_MA_TRAIN},
    p AS (SELECT i.city, i.w AS actual, m.c + CASE WHEN i.i = m.last + 1 THEN m.b * m.e ELSE 0 END AS prediction FROM i JOIN m USING (city) WHERE i.i > m.last)
    SELECT city, round(avg(abs(actual - prediction)), 4) AS mae, round(sqrt(avg((actual - prediction) ** 2)), 4) AS rmse,
           round(1 - sum((actual - prediction) ** 2) / (var_pop(actual) * count(*)), 4) AS r2, count(*) AS test_size FROM p GROUP BY 1""",
)
def ma_evaluation(t: Tables) -> DataFrame:
    """Errors on the last fifth of a model with an MA term."""
    spec = _ma_spec()
    out = spec.evaluate(spec.fit(stage(spec.split(t.hourly), "split")))
    return out.select("city", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "r2")], "test_size")


@query(
    "ma_forecast",
    f"""WITH RECURSIVE {_MA_WHOLE}, u AS (SELECT unnest(range(1, 7)) AS step),
    g AS (SELECT city, step, c + CASE WHEN step = 1 THEN b * e ELSE 0 END AS prediction,
                 1.959963984540054::DOUBLE * sqrt(s2 * CASE WHEN step = 1 THEN 1 ELSE 1 + b * b END) AS half FROM m, u)
    SELECT city, CAST(step AS INTEGER) AS step, round(prediction, 4) AS prediction, round(prediction - half, 4) AS lower, round(prediction + half, 4) AS upper,
           'no_exog' AS model_used FROM g""",
)
def ma_forecast(t: Tables) -> DataFrame:
    """Six steps ahead of a model with an MA term."""
    spec = _ma_spec()
    out = spec.forecast(spec.fit(stage(t.hourly, "hourly")), 6)
    return out.withColumns({c: F.round(c, 4) for c in ("prediction", "lower", "upper")})
