"""Cleaning, quality, features and series operators."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.catalog import GAPPY, HOURLY, READINGS, Tables, query
from isobar.functions import calendar, weather
from isobar.operators import clean, columns, encode, features, quality, series, split

SERIES = ["city"]
ORDER = ["ts", "event_id"]
MEASURES = ["temperature", "humidity", "pressure", "wind_speed", "precipitation"]


# ---- cleaning ----------------------------------------------------------------


@query("dedupe", "SELECT DISTINCT event_type, CAST(floor(value) AS BIGINT) AS v, user_id % 10 AS u FROM events")
def dedupe(t: Tables) -> DataFrame:
    return clean.drop_duplicates(
        t.events.select("event_type", F.floor("value").alias("v"), (F.col("user_id") % 10).alias("u"))
    )


@query(
    "median_fill",
    f"""WITH {GAPPY},
    m AS (SELECT median(temperature) AS t, median(humidity) AS h, median(pressure) AS p FROM g)
    SELECT event_id, coalesce(temperature, t) AS temperature, coalesce(humidity, h) AS humidity,
           coalesce(pressure, p) AS pressure FROM g, m""",
)
def median_fill(t: Tables) -> DataFrame:
    measures = ["temperature", "humidity", "pressure"]
    return clean.fill_median(t.gappy.select("event_id", *measures), measures)


@query(
    "median_fill_by_city",
    f"""WITH {GAPPY},
    k AS (SELECT * REPLACE (CASE WHEN user_id % 10 <> 3 THEN humidity END AS humidity) FROM g),
    m AS (SELECT median(humidity) AS h FROM k),
    c AS (SELECT user_id % 20 AS station, median(temperature) AS t, median(humidity) AS h, median(pressure) AS p FROM k GROUP BY 1)
    SELECT event_id, coalesce(k.temperature, c.t) AS temperature, coalesce(k.humidity, c.h, m.h) AS humidity,
           coalesce(k.pressure, c.p) AS pressure FROM k JOIN c ON k.user_id % 20 = c.station, m""",
)
def median_fill_by_city(t: Tables) -> DataFrame:
    """Gaps take the median of their own station; two stations in twenty have no humidity at all and take everybody's."""
    measures = ["temperature", "humidity", "pressure"]
    rows = t.gappy.select("event_id", (F.col("user_id") % 20).alias("station"), *measures)
    rows = rows.withColumn("humidity", F.when(F.col("station") % 10 != 3, F.col("humidity")))
    return clean.fill_median(rows, measures, keys=["station"]).drop("station")


@query(
    "mode_fill",
    f"""WITH {GAPPY},
    top AS (SELECT label FROM g WHERE label IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, label LIMIT 1)
    SELECT event_id, coalesce(label, (SELECT label FROM top)) AS label, 'Unknown' AS empty FROM g""",
)
def mode_fill(t: Tables) -> DataFrame:
    rows = t.gappy.select("event_id", "label", F.lit(None).cast("string").alias("empty"))
    return clean.fill_mode(rows)


def _fence(source: str, column: str) -> str:
    return (
        f"(SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {source}) b "
        f"WHERE {column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    )


_STEPS = ", ".join(
    f"s{i + 1} AS (SELECT s.* FROM {'g' if i == 0 else f's{i}'} s, {_fence('g' if i == 0 else f's{i}', c)})"
    for i, c in enumerate(MEASURES)
)


@query(
    "iqr_outliers",
    f"WITH {GAPPY}, {_STEPS} SELECT event_id, temperature, humidity, precipitation FROM s5",
)
def iqr_outliers(t: Tables) -> DataFrame:
    """Fences of each measure after the ones before it have filtered."""
    return clean.drop_outliers(t.gappy).select("event_id", "temperature", "humidity", "precipitation")


@query(
    "iqr_outliers_once",
    f"""WITH {GAPPY},
    q AS (SELECT quantile_cont(temperature, 0.25) AS t1, quantile_cont(temperature, 0.75) AS t3,
                 quantile_cont(humidity, 0.25) AS h1, quantile_cont(humidity, 0.75) AS h3 FROM g)
    SELECT event_id FROM g, q
    WHERE temperature BETWEEN t1 - 1.5 * (t3 - t1) AND t3 + 1.5 * (t3 - t1)
      AND humidity BETWEEN h1 - 1.5 * (h3 - h1) AND h3 + 1.5 * (h3 - h1)""",
)
def iqr_outliers_once(t: Tables) -> DataFrame:
    return clean.drop_outliers(t.gappy, ["temperature", "humidity"], simultaneous=True).select("event_id")


_FILLED = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM g)) AS {c}" for c in MEASURES)
_CLEAN_STEPS = _STEPS.replace("FROM g s", "FROM f s").replace("FROM g)", "FROM f)")


@query(
    "clean_all",
    f"""WITH {GAPPY},
    f AS (SELECT event_id, {_FILLED},
                 coalesce(label, (SELECT label FROM g WHERE label IS NOT NULL GROUP BY 1
                                  ORDER BY count(*) DESC, label LIMIT 1)) AS label FROM g),
    {_CLEAN_STEPS}
    SELECT event_id, temperature, humidity, pressure, wind_speed, precipitation, label FROM s5""",
)
def clean_all(t: Tables) -> DataFrame:
    rows = t.gappy.select("event_id", *MEASURES, "label")
    return clean.clean(rows, fill_columns=MEASURES, mode_columns=["label"])


# ---- quality and summaries ---------------------------------------------------


@query(
    "completeness",
    f"""WITH {GAPPY}
    SELECT round(1 - sum(CASE WHEN temperature IS NULL THEN 1 ELSE 0 END + CASE WHEN humidity IS NULL THEN 1 ELSE 0 END
         + CASE WHEN pressure IS NULL THEN 1 ELSE 0 END + CASE WHEN label IS NULL THEN 1 ELSE 0 END)
         / (count(*) * 10.0), 9) AS data_quality_score FROM g""",
)
def completeness(t: Tables) -> DataFrame:
    score = quality.completeness(t.gappy)
    return score.select(F.round("data_quality_score", 9).alias("data_quality_score"))


@query(
    "null_share",
    f"""WITH {GAPPY},
    c AS (SELECT count(*) AS total_records, count(*) - count(temperature) AS null_temperature,
                 count(*) - count(humidity) AS null_humidity, count(*) - count(pressure) AS null_pressure
          FROM g WHERE ts >= TIMESTAMP '2024-01-30 23:00:00')
    SELECT *, round((null_temperature + null_humidity + null_pressure) / (total_records * 3) * 100, 9) AS null_percentage
    FROM c""",
)
def null_share(t: Tables) -> DataFrame:
    last = columns.since(t.gappy, "ts", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), hours=1)
    out = quality.with_null_percentage(quality.null_counts(last))
    return out.withColumn("null_percentage", F.round("null_percentage", 9))


@query(
    "verdict",
    f"""WITH {GAPPY},
    c AS (SELECT city, count(*) AS n,
                 3 * count(*) - count(temperature) - count(humidity) - count(pressure) AS gaps FROM g GROUP BY 1)
    SELECT 'all' AS part, CASE WHEN sum(n) = 0 THEN 'no_data' WHEN sum(gaps) / (sum(n) * 3) * 100 > 10 THEN 'low_quality'
           ELSE 'quality_ok' END AS verdict FROM c
    UNION ALL SELECT 'complete', 'quality_ok' UNION ALL SELECT 'none', 'no_data'""",
)
def verdict(t: Tables) -> DataFrame:
    parts = {"all": t.gappy, "complete": t.readings, "none": t.gappy.filter("event_id < 0")}
    out = None
    for name, rows in parts.items():
        row = quality.verdict(quality.null_counts(rows)).select(F.lit(name).alias("part"), "verdict")
        out = row if out is None else out.unionByName(row)
    return out


@query("period", "SELECT min(ts) AS first, max(ts) AS last, count(*) AS records FROM events")
def period(t: Tables) -> DataFrame:
    return quality.period(t.events, "ts")


@query("distinct_keys", "SELECT DISTINCT user_id FROM events")
def distinct_keys(t: Tables) -> DataFrame:
    return quality.distinct_keys(t.events, "user_id")


@query("class_counts", f"WITH {READINGS} SELECT precipitation > 0 AS rain, count(*) AS n FROM r GROUP BY 1")
def class_counts(t: Tables) -> DataFrame:
    return quality.class_counts(t.readings.withColumn("rain", F.col("precipitation") > 0), "rain")


def _described(column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count({column}) AS count, round(avg({column}), 6) AS mean, "
        f"round(stddev_samp({column}), 6) AS std, min({column}) AS min, "
        f"round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50, "
        f"round(quantile_cont({column}, 0.75), 6) AS q75, max({column}) AS max FROM g"
    )


@query("describe", f"WITH {GAPPY} " + " UNION ALL ".join(_described(c) for c in MEASURES))
def describe(t: Tables) -> DataFrame:
    out = quality.describe(t.gappy, MEASURES)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "forecast_summary",
    """SELECT event_type, round(avg(value), 6) AS next_avg, min(value) AS min_predicted, max(value) AS max_predicted,
       count(value) AS predictions_count, round(stddev_pop(value), 6) AS std_deviation FROM events GROUP BY 1""",
)
def forecast_summary(t: Tables) -> DataFrame:
    out = quality.forecast_summary(t.events, ["event_type"], "value")
    return out.withColumns({c: F.round(c, 6) for c in ("next_avg", "std_deviation")})


@query(
    "stage_report",
    f"""WITH {GAPPY}
    SELECT 1 AS step, 'raw' AS stage, count(*) AS records, CAST(NULL AS DOUBLE) AS seconds FROM g
    UNION ALL SELECT 2, 'complete', count(*), 1.5 FROM g
      WHERE temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL AND label IS NOT NULL
    UNION ALL SELECT 3, 'hourly', count(*), NULL FROM (SELECT DISTINCT city, date_trunc('hour', ts) FROM g)""",
)
def stage_report(t: Tables) -> DataFrame:
    stages = {"raw": t.gappy, "complete": series.complete_rows(t.gappy), "hourly": t.hourly}
    return quality.stage_report(stages, {"complete": 1.5})


@query(
    "resample_6h",
    f"""WITH {READINGS}
    SELECT time_bucket(INTERVAL 6 HOUR, ts) AS ts, round(avg(temperature), 6) AS temperature,
           round(avg(humidity), 6) AS humidity, round(avg(pressure), 6) AS pressure,
           round(avg(wind_speed), 6) AS wind_speed, round(sum(precipitation), 4) AS precipitation,
           max(CASE WHEN precipitation > 0 THEN 1 ELSE 0 END) AS rain_flag
    FROM r GROUP BY 1""",
)
def resample_6h(t: Tables) -> DataFrame:
    out = series.resample(t.readings, "ts", width="6 hours")
    rounded = {c: F.round(c, 6) for c in ("temperature", "humidity", "pressure", "wind_speed")}
    return out.withColumns({**rounded, "precipitation": F.round("precipitation", 4)})


# ---- features ----------------------------------------------------------------


@query(
    "calendar_features",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
       CASE WHEN month(ts) IN (12, 1, 2) THEN 'Summer' WHEN month(ts) IN (3, 4, 5) THEN 'Autumn'
            WHEN month(ts) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END AS season FROM events""",
)
def calendar_features(t: Tables) -> DataFrame:
    out = features.calendar_features(t.events, "ts")
    return out.select("event_id", "hour", "day_of_week", "month", "season")


@query(
    "season",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Summer'
       WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Autumn'
       WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END AS season FROM orders""",
)
def season(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", calendar.season(F.month("o_orderdate")).alias("season"))


@query(
    "dew_point",
    f"""WITH {READINGS},
    a AS (SELECT event_id, 17.27::DOUBLE * temperature / (237.7::DOUBLE + temperature) + ln(nullif(humidity, 0) / 100) AS v
          FROM r)
    SELECT event_id, round(237.7::DOUBLE * v / (17.27::DOUBLE - v), 6) AS dew_point FROM a""",
)
def dew_point(t: Tables) -> DataFrame:
    value = weather.dew_point(F.col("temperature"), F.col("humidity"))
    return t.readings.select("event_id", F.round(value, 6).alias("dew_point"))


@query(
    "feels_like",
    f"""WITH {READINGS}
    SELECT event_id, round(temperature + 0.5::DOUBLE * (humidity / 100) * (temperature - 14.5::DOUBLE), 6) AS feels_like
    FROM r""",
)
def feels_like(t: Tables) -> DataFrame:
    value = weather.feels_like(F.col("temperature"), F.col("humidity"))
    return t.readings.select("event_id", F.round(value, 6).alias("feels_like"))


@query(
    "interactions",
    f"""WITH {READINGS} SELECT event_id, temperature * humidity AS temp_humidity_interaction,
        wind_speed * pressure AS wind_pressure_interaction FROM r""",
)
def interactions(t: Tables) -> DataFrame:
    return features.interactions(t.readings).select(
        "event_id", "temp_humidity_interaction", "wind_pressure_interaction"
    )


@query(
    "rain_flag",
    f"""WITH {READINGS} SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0
        WHEN precipitation > 0 THEN 1 ELSE 0 END AS rain_flag FROM r""",
)
def rain_flag(t: Tables) -> DataFrame:
    rain = F.when(F.col("event_id") % 7 != 0, F.col("precipitation"))
    return t.readings.select("event_id", weather.rain_flag(rain).alias("rain_flag"))


@query(
    "time_conversions",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS dt, date_trunc('second', ts) AS observed_at,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso FROM events""",
)
def time_conversions(t: Tables) -> DataFrame:
    dt = calendar.time_to_epoch(F.col("ts"))
    iso = calendar.iso_format(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id",
        dt.alias("dt"),
        calendar.epoch_to_time(dt).cast("timestamp_ntz").alias("observed_at"),
        iso.alias("iso"),
    )


@query("key_safe", "SELECT p_partkey, replace(replace(p_name || '/' || p_type, ' ', '_'), '/', '_') AS name FROM part")
def key_safe(t: Tables) -> DataFrame:
    name = F.concat("p_name", F.lit("/"), "p_type")
    return t.part.select("p_partkey", calendar.key_safe(name).alias("name"))


@query(
    "engineered",
    f"""WITH {READINGS}
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
           coalesce(pressure - lag(pressure) OVER (PARTITION BY city ORDER BY ts, event_id), 0) AS pressure_tendency,
           temperature * humidity AS temp_humidity_interaction, wind_speed * pressure AS wind_pressure_interaction,
           CASE WHEN precipitation > 0 THEN 1 ELSE 0 END AS rain_flag FROM r""",
)
def engineered(t: Tables) -> DataFrame:
    out = features.engineer(t.readings, partition_by=SERIES, time="ts", order=ORDER)
    return out.select(
        "event_id",
        "hour",
        "day_of_week",
        "month",
        "pressure_tendency",
        "temp_humidity_interaction",
        "wind_pressure_interaction",
        "rain_flag",
    )


@query("label_encode", "SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_encoded FROM part")
def label_encode(t: Tables) -> DataFrame:
    return encode.encode_labels(t.part, "p_brand").select("p_partkey", "p_brand_encoded")


@query(
    "one_hot",
    """SELECT event_id, (event_type = 'click')::INT AS event_type_click, (event_type = 'error')::INT AS event_type_error,
       (event_type = 'purchase')::INT AS event_type_purchase, (event_type = 'signup')::INT AS event_type_signup,
       (event_type = 'view')::INT AS event_type_view FROM events""",
)
def one_hot(t: Tables) -> DataFrame:
    return encode.one_hot(t.events.select("event_id", "event_type"), ["event_type"])


@query(
    "standardise",
    f"""WITH {READINGS}, s AS (SELECT avg(temperature) AS m1, stddev_pop(temperature) AS s1,
         avg(humidity) AS m2, stddev_pop(humidity) AS s2 FROM r)
    SELECT event_id, round((temperature - m1) / s1, 6) AS temperature_scaled,
           round((humidity - m2) / s2, 6) AS humidity_scaled FROM r, s""",
)
def standardise(t: Tables) -> DataFrame:
    out = encode.standardise(t.readings, ["temperature", "humidity"])
    return out.select(
        "event_id", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in ("temperature", "humidity")]
    )


# ---- along a series ----------------------------------------------------------


@query(
    "tendency",
    f"""WITH {READINGS} SELECT event_id, coalesce(pressure - lag(pressure)
        OVER (PARTITION BY city ORDER BY ts, event_id), 0) AS pressure_tendency FROM r""",
)
def tendency(t: Tables) -> DataFrame:
    return series.tendency(t.readings, "pressure", SERIES, ORDER).select("event_id", "pressure_tendency")


@query(
    "tendency_whole",
    f"""WITH {READINGS} SELECT event_id, coalesce(pressure - lag(pressure) OVER (ORDER BY ts, event_id), 0)
        AS pressure_tendency FROM r""",
)
def tendency_whole(t: Tables) -> DataFrame:
    """Across city borders, in file order."""
    return series.tendency(t.readings, "pressure", [], ORDER).select("event_id", "pressure_tendency")


_LAGS = ", ".join(
    f"lag({c}, {i}) OVER w AS {c}_lag_{i}" for c in ("temperature", "humidity") for i in range(1, 7)
)


@query(
    "lag_features",
    f"""WITH {READINGS}, x AS (SELECT event_id, {_LAGS} FROM r WINDOW w AS (PARTITION BY city ORDER BY ts, event_id))
    SELECT * FROM x WHERE temperature_lag_6 IS NOT NULL AND humidity_lag_6 IS NOT NULL""",
)
def lag_features(t: Tables) -> DataFrame:
    names = [f"{c}_lag_{i}" for c in ("temperature", "humidity") for i in range(1, 7)]
    out = series.lagged(t.readings, SERIES, ORDER, ["temperature", "humidity"], lags=6, moving=False)
    return series.complete_rows(out, names).select("event_id", *names)


@query(
    "lagged_ma",
    f"""WITH {GAPPY}, x AS (
      SELECT event_id, count(humidity) OVER w3 AS n3, round(avg(humidity) OVER w3, 6) AS a3,
             count(humidity) OVER w6 AS n6, round(avg(humidity) OVER w6, 6) AS a6,
             lag(humidity) OVER (PARTITION BY city ORDER BY ts, event_id) AS humidity_lag_1
      FROM g WINDOW w3 AS (PARTITION BY city ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
                    w6 AS (PARTITION BY city ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))
    SELECT event_id, humidity_lag_1, CASE WHEN n3 = 3 THEN a3 END AS humidity_ma_3,
           CASE WHEN n6 = 6 THEN a6 END AS humidity_ma_6 FROM x""",
)
def lagged_ma(t: Tables) -> DataFrame:
    out = series.lagged(t.gappy, SERIES, ORDER, ["humidity"])
    means = [F.round(c, 6).alias(c) for c in ("humidity_ma_3", "humidity_ma_6")]
    return out.select("event_id", "humidity_lag_1", *means)


@query(
    "interpolate",
    f"""WITH {GAPPY},
    n AS (SELECT event_id, city, ts, temperature AS v, row_number() OVER (PARTITION BY city ORDER BY ts, event_id) AS i
          FROM g),
    b AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY city ORDER BY i) AS bi,
                 min(CASE WHEN v IS NOT NULL THEN i END)
                   OVER (PARTITION BY city ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ai FROM n)
    SELECT b.event_id, CASE WHEN b.v IS NOT NULL THEN b.v WHEN a.v IS NULL THEN p.v
           ELSE p.v + (a.v - p.v) * (b.i - b.bi) / (b.ai - b.bi) END AS temperature
    FROM b LEFT JOIN n p ON p.city = b.city AND p.i = b.bi LEFT JOIN n a ON a.city = b.city AND a.i = b.ai""",
)
def interpolate(t: Tables) -> DataFrame:
    return series.interpolate(t.gappy, SERIES, ORDER, ["temperature"]).select("event_id", "temperature")


@query(
    "fill_both",
    f"""WITH {GAPPY},
    x AS (SELECT event_id, last_value(pressure IGNORE NULLS) OVER w AS b, first_value(pressure IGNORE NULLS) OVER v AS a
          FROM g WINDOW w AS (PARTITION BY city ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
                        v AS (PARTITION BY city ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT event_id, coalesce(b, a) AS pressure FROM x""",
)
def fill_both(t: Tables) -> DataFrame:
    return series.fill_gaps(t.gappy, SERIES, ORDER, ["pressure"]).select("event_id", "pressure")


@query(
    "complete_rows",
    f"""WITH {GAPPY} SELECT event_id FROM g WHERE temperature IS NOT NULL AND humidity IS NOT NULL
        AND pressure IS NOT NULL AND label IS NOT NULL""",
)
def complete_rows(t: Tables) -> DataFrame:
    return series.complete_rows(t.gappy).select("event_id")


@query(
    "time_split",
    """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)
       <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY event_type)) AS is_train FROM events""",
)
def time_split(t: Tables) -> DataFrame:
    return series.time_split(t.events, ["event_type"], ORDER).select("event_id", "is_train")


@query(
    "systematic_sample",
    """WITH n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events)
    SELECT event_id FROM n WHERE i % greatest(n // 1000, 1) = 0""",
)
def systematic_sample(t: Tables) -> DataFrame:
    return series.systematic_sample(t.events.select("event_id", "ts"), ORDER).select("event_id")


@query(
    "sample_by_counts",
    """WITH n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events)
    SELECT event_id FROM n WHERE i % greatest(n // 50, 1) = 0""",
)
def sample_by_counts(t: Tables) -> DataFrame:
    """The sample as a table too large to sort gives it: places found by counting."""
    return series.systematic_sample(t.events.select("event_id", "ts"), ORDER, size=50, block_rows=200).select("event_id")


@query(
    "series_chain",
    f"""WITH {GAPPY},
    f AS (SELECT event_id, ts, city, humidity,
                 coalesce(last_value(pressure IGNORE NULLS) OVER w, first_value(pressure IGNORE NULLS) OVER v) AS pressure
          FROM g WINDOW w AS (PARTITION BY city ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
                        v AS (PARTITION BY city ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    l AS (SELECT *, coalesce(pressure - lag(pressure) OVER w, 0) AS pressure_tendency,
                 lag(pressure, 1) OVER w AS pressure_lag_1, lag(pressure, 2) OVER w AS pressure_lag_2
          FROM f WINDOW w AS (PARTITION BY city ORDER BY ts, event_id)),
    k AS (SELECT * FROM l WHERE pressure_lag_2 IS NOT NULL AND humidity IS NOT NULL)
    SELECT event_id, pressure, pressure_tendency, pressure_lag_1, pressure_lag_2,
           coalesce(humidity - lag(humidity) OVER w, 0) AS humidity_step,
           row_number() OVER w <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY city)) AS is_train
    FROM k WINDOW w AS (PARTITION BY city ORDER BY ts, event_id)""",
)
def series_chain(t: Tables) -> DataFrame:
    """Six operators on one numbered copy, every series cut into blocks."""
    chain = series.Chain.of(t.gappy.select("event_id", "ts", "city", "pressure", "humidity"), SERIES, ORDER, block_rows=300)
    chain = chain.fill_gaps(["pressure"]).tendency("pressure").lagged(["pressure"], lags=2, moving=False)
    chain = chain.complete_rows(["pressure_lag_2", "humidity"]).tendency("humidity", name="humidity_step").time_split()
    added = ["pressure", "pressure_tendency", "pressure_lag_1", "pressure_lag_2", "humidity_step", "is_train"]
    return chain.rows().select("event_id", *added)


@query(
    "strat_split",
    """WITH e AS (SELECT event_id, value > 100 AS rain, (event_id % 2147483648) * 2654435761 % 4294967296 AS draw
                  FROM events),
    n AS (SELECT *, row_number() OVER (PARTITION BY rain ORDER BY draw, event_id) AS i,
                 count(*) OVER (PARTITION BY rain) AS n FROM e)
    SELECT event_id, rain, i <= floor(0.2::DOUBLE * n) AS is_test FROM n""",
)
def strat_split(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", (F.col("value") > 100).alias("rain"))
    draw = (F.col("event_id") % 2147483648) * F.lit(2654435761) % F.lit(4294967296)
    return split.stratified_split(rows, "rain", "event_id", draw=draw)


@query(
    "plain_split",
    """SELECT event_id, value, floor((event_id % 2147483648) * 2654435761 % 4294967296 / 4294967296.0::DOUBLE * 100) < 20 AS is_test
       FROM events""",
)
def plain_split(t: Tables) -> DataFrame:
    return split.plain_split(t.events.select("event_id", "value"), "event_id", share=split.portable_share("event_id"))


@query("hourly_series", f"WITH {HOURLY} SELECT * FROM h")
def hourly_series(t: Tables) -> DataFrame:
    return t.hourly
