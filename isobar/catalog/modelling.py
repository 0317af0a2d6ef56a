"""Scores, models, forecasts and the stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.catalog import HOURLY, READINGS, Tables, query
from isobar.operators import features, metrics, quality
from isobar.operators.encode import encode_labels, label_mapping
from isobar.operators.leastsquares import least_squares
from isobar.operators.ordered import largest_group
from isobar.operators.series import lagged, time_split
from isobar.operators.split import portable_share, with_folds, with_stratified_folds
from isobar.plans import models
from isobar.plans.forecast import Forecaster, Orders, as_single_series, single_series
from isobar.plans.runs import train_and_forecast
from isobar.staging import new_path, stage
from isobar.streaming import hourly as streaming

EXOG = ("humidity", "pressure", "wind_speed", "precipitation")


# ---- scores ------------------------------------------------------------------

# Label: rain.  Score: the humidity channel; predicted wet from 60 on.
SCORED = (
    READINGS
    + """,
s AS (SELECT event_id, city, CASE WHEN precipitation > 0 THEN 1 ELSE 0 END AS label, humidity / 100 AS probability,
             CASE WHEN humidity >= 60 THEN 1 ELSE 0 END AS prediction FROM r)"""
)


def _scored(t: Tables) -> DataFrame:
    return t.readings.select(
        "event_id",
        "city",
        F.when(F.col("precipitation") > 0, 1).otherwise(0).alias("label"),
        (F.col("humidity") / 100).alias("probability"),
        F.when(F.col("humidity") >= 60, 1).otherwise(0).alias("prediction"),
    )


@query("confusion", f"WITH {SCORED} SELECT label, prediction, count(*) AS n FROM s GROUP BY 1, 2")
def confusion(t: Tables) -> DataFrame:
    return metrics.confusion(_scored(t))


@query(
    "binary_report",
    f"""WITH {SCORED},
    c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn
          FROM s)
    SELECT tp, fp, fn, tn, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
           round(2 * tp / (2 * tp + fp + fn), 9) AS f1_score, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy FROM c""",
)
def binary_report(t: Tables) -> DataFrame:
    out = metrics.binary_report(_scored(t))
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1_score", "accuracy")})


@query(
    "auc",
    f"""WITH {SCORED},
    k AS (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2 AS rk FROM s)
    SELECT round((sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
           / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 9) AS auc FROM k""",
)
def auc(t: Tables) -> DataFrame:
    return metrics.auc(_scored(t), "label", "probability").select(F.round("auc", 9).alias("auc"))


@query(
    "class_report",
    f"""WITH {SCORED},
    c AS (SELECT k AS class, count(*) FILTER (label = k) AS support, count(*) FILTER (prediction = k) AS predicted,
                 count(*) FILTER (label = k AND prediction = k) AS hits
          FROM s, (SELECT unnest([0, 1]) AS k) GROUP BY k),
    p AS (SELECT CAST(class AS VARCHAR) AS class, hits / predicted AS precision, hits / support AS recall,
                 2 * hits / (support + predicted) AS f1_score, support FROM c),
    u AS (SELECT * FROM p
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM p
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
             sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM p)
    SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1_score, 9) AS f1_score, support
    FROM u""",
)
def class_report(t: Tables) -> DataFrame:
    out = metrics.class_report(_scored(t))
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1_score")})


_ERRORS = f"""WITH {READINGS},
    e AS (SELECT city, temperature AS y, humidity AS p FROM r)
    SELECT city, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
           round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2, count(*) AS n FROM e GROUP BY 1"""


def _errors(t: Tables) -> DataFrame:
    rows = t.readings.select("city", F.col("temperature").alias("actual"), F.col("humidity").alias("prediction"))
    return metrics.regression_metrics(rows, keys=["city"])


@query("regression_metrics", _ERRORS)
def regression_metrics(t: Tables) -> DataFrame:
    return _errors(t).withColumns({c: F.round(c, 6) for c in ("mae", "rmse", "r2")})


@query(
    "mean_metrics",
    f"WITH m AS ({_ERRORS}) SELECT round(avg(mae), 5) AS avg_mae, round(avg(rmse), 5) AS avg_rmse, round(avg(r2), 5) AS avg_r2 FROM m",
)
def mean_metrics(t: Tables) -> DataFrame:
    out = quality.mean_metrics(_errors(t))
    return out.select(*[F.round(c, 5).alias(c) for c in out.columns])


@query(
    "resid_diag",
    f"""WITH {READINGS}, e AS (SELECT city, temperature - humidity AS d FROM r)
    SELECT city, count(*) AS n, round(avg(d), 6) AS mean, round(stddev_pop(d), 6) AS std, round(skewness(d), 6) AS skew,
           round(kurtosis(d), 6) AS kurtosis FROM e GROUP BY 1""",
)
def resid_diag(t: Tables) -> DataFrame:
    rows = t.readings.select("city", (F.col("temperature") - F.col("humidity")).alias("d"))
    out = metrics.residual_stats(rows, "d", ["city"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "skew", "kurtosis")})


@query(
    "line_fit",
    f"""WITH {READINGS} SELECT city, round(regr_slope(temperature, humidity), 6) AS slope,
        round(regr_intercept(temperature, humidity), 6) AS intercept, count(*) AS n_obs FROM r GROUP BY 1""",
)
def line_fit(t: Tables) -> DataFrame:
    rows = t.readings.select("city", F.array("humidity").alias("x"), F.col("temperature").alias("y"))
    fit = least_squares(rows, ["city"], "x", "y", 1, constant=True)
    beta = F.col("coefficients")
    return fit.select("city", F.round(beta[0], 6).alias("slope"), F.round(beta[1], 6).alias("intercept"), "n_obs")


# ---- forests and regressions -------------------------------------------------


def _table(t: Tables) -> DataFrame:
    rows = t.readings.withColumn("wind_direction", F.element_at(F.array(*map(F.lit, "NESW")), (F.col("user_id") % 4 + 1).cast("int")))
    out = features.engineer(rows, partition_by=["city"], time="ts", order=["ts", "event_id"])
    return out.na.fill({"dew_point": 0.0})


_WIND = "['N', 'E', 'S', 'W'][user_id % 4 + 1]"


# Readings moved by up to eleven months, so that all seasons occur.
_SEASONED = f"""{READINGS},
    b AS (SELECT *, ts + INTERVAL 1 MONTH * (event_id % 12) AS moment, {_WIND} AS wind FROM r),
    v AS (SELECT *, 17.27::DOUBLE * temperature / (237.7::DOUBLE + temperature) + ln(nullif(humidity, 0) / 100) AS v FROM b),
    f AS (SELECT event_id, temperature, humidity, pressure, wind_speed, precipitation,
                 round(coalesce(237.7::DOUBLE * v / (17.27::DOUBLE - v), 0), 6) AS dew_point,
                 coalesce(pressure - lag(pressure) OVER (PARTITION BY city ORDER BY moment, event_id), 0) AS pressure_tendency,
                 round(temperature * humidity, 6) AS temp_humidity_interaction, wind_speed * pressure AS wind_pressure_interaction,
                 CAST(hour(moment) AS INTEGER) AS hour, CAST(isodow(moment) - 1 AS INTEGER) AS day_of_week, CAST(month(moment) AS INTEGER) AS month,
                 dense_rank() OVER (ORDER BY wind) - 1 AS wind_direction_encoded,
                 dense_rank() OVER (ORDER BY CASE WHEN month(moment) IN (12, 1, 2) THEN 'Summer' WHEN month(moment) IN (3, 4, 5) THEN 'Autumn'
                                                  WHEN month(moment) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END) - 1 AS season_encoded
          FROM v)"""


def _seasoned(t: Tables) -> DataFrame:
    rows = t.readings.withColumn("wind_direction", F.element_at(F.array(*map(F.lit, "NESW")), (F.col("user_id") % 4 + 1).cast("int")))
    rows = rows.withColumn("at", F.col("ts") + F.make_ym_interval(F.lit(0), (F.col("event_id") % 12).cast("int")))
    return features.engineer(rows, partition_by=["city"], time="at", order=["at", "event_id"]).na.fill({"dew_point": 0.0})


def _shown(rows: DataFrame, chosen: models.Features) -> DataFrame:
    out = chosen.apply(rows).select("event_id", *chosen.names)
    return out.withColumns({c: F.round(c, 6) for c in ("dew_point", "temp_humidity_interaction")})


@query(
    "rain_features",
    f"""WITH {_SEASONED}
    SELECT event_id, temperature, humidity, pressure, wind_speed, dew_point, pressure_tendency, temp_humidity_interaction,
           wind_pressure_interaction, hour, day_of_week, month, wind_direction_encoded FROM f""",
)
def rain_features(t: Tables) -> DataFrame:
    rows = _seasoned(t)
    return _shown(rows, models.rain_features(rows))


@query(
    "temperature_features",
    f"""WITH {_SEASONED}
    SELECT event_id, humidity, pressure, wind_speed, precipitation, dew_point, pressure_tendency, temp_humidity_interaction,
           wind_pressure_interaction, hour, day_of_week, month, wind_direction_encoded, season_encoded FROM f""",
)
def temperature_features(t: Tables) -> DataFrame:
    rows = _seasoned(t)
    return _shown(rows, models.temperature_features(rows))


# What a forest gives depends on its draws; the twins compare what must hold for any:
# every row scored once, scores in range, classes as the scores say, sizes and totals of the parts.
_LABELLED = f"""{READINGS}, t AS (SELECT event_id, CASE WHEN precipitation > 0 THEN 1 ELSE 0 END AS rain_flag FROM r)"""
_TEST_SIZES = """n AS (SELECT rain_flag, CAST(floor(0.2::DOUBLE * count(*)) AS BIGINT) AS n FROM t GROUP BY 1)"""


@query(
    "rf_rain",
    f"""WITH {_LABELLED}, {_TEST_SIZES}
    SELECT CAST(sum(n) FILTER (rain_flag = 1) AS BIGINT) AS wet, CAST(sum(n) FILTER (rain_flag = 0) AS BIGINT) AS dry, true AS informative FROM n""",
)
def rf_rain(t: Tables) -> DataFrame:
    """Forest trained on four fifths of every class; class totals of the rest and whether its scores tell wet from dry."""
    _, scored = models.train_rain(stage(_table(t), "features"), "event_id")
    report = models.classifier_report(scored, "rain_flag")
    right = F.col("auc").between(0.98, 1) & F.col("accuracy").between(0.95, 1)  # the label is one split of the temperature
    return report.select((F.col("tp") + F.col("fn")).alias("wet"), (F.col("tn") + F.col("fp")).alias("dry"), right.alias("informative"))


@query(
    "rf_temp",
    """SELECT count(*) AS n, true AS informative FROM events
       WHERE floor((event_id % 2147483648) * 2654435761 % 4294967296 / 4294967296.0::DOUBLE * 100) < 20""",
)
def rf_temp(t: Tables) -> DataFrame:
    """Errors on a fifth of the rows: their number and whether the forest beats the mean."""
    _, scored = models.train_temperature(stage(_table(t), "features"), "event_id", share=portable_share("event_id"))
    report = metrics.regression_metrics(scored, "temperature", "prediction")
    return report.select("n", (F.col("r2").between(0.9, 1) & (F.col("mae") <= F.col("rmse"))).alias("informative"))  # it is a ratio of two features


@query(
    "logit_rain",
    f"""WITH {READINGS},
    s AS (SELECT CASE WHEN precipitation > 0 THEN 1 ELSE 0 END AS rain_flag,
                 row_number() OVER (PARTITION BY city ORDER BY ts, event_id) > floor(0.8::DOUBLE * count(*) OVER (PARTITION BY city)) AS held
          FROM r)
    SELECT count(*) FILTER (rain_flag = 1) AS wet, count(*) FILTER (rain_flag = 0) AS dry, true AS in_range FROM s WHERE held""",
)
def logit_rain(t: Tables) -> DataFrame:
    """Lags 1 to 6 of the target's companions and sparse one-hot wind, trained on the first four fifths in time of each city."""
    rows = _table(t)
    rows = lagged(rows, ["city"], ["ts", "event_id"], ["humidity", "pressure"], lags=6)
    lags = [f"{c}_lag_{k}" for c in ("humidity", "pressure") for k in range(1, 7)]
    rows = time_split(rows, ["city"], ["ts", "event_id"]).na.fill(0.0, subset=lags)
    chosen = models.Features.fit(rows, ["wind_speed", "hour", *lags], levels=["wind_direction"])
    train = stage(rows, "logit")
    model = models.fit(models.rain_logit(chosen, train.filter("is_train").count()), chosen, train.filter("is_train"), "rain_flag")
    scored = model.score(train.filter("not is_train"))
    report = models.classifier_report(scored, "rain_flag")
    return report.select(
        (F.col("tp") + F.col("fn")).alias("wet"), (F.col("tn") + F.col("fp")).alias("dry"), F.col("auc").between(0, 1).alias("in_range")
    )


# The penalised optimum for one feature of two values: Newton steps on four counts.
_NEWTON = """c AS (SELECT count(*) FILTER (x = 0) AS n0, count(*) FILTER (x = 1) AS n1, CAST(sum(y) AS DOUBLE) AS y, CAST(sum(x * y) AS DOUBLE) AS y1 FROM m),
    step AS (
      SELECT 0 AS k, 0.0::DOUBLE AS w, 0.0::DOUBLE AS b
      UNION ALL
      SELECT k + 1, w - ((v0 + v1) * gw - v1 * gb) / ((v0 + v1) * (v1 + 1) - v1 * v1), b - ((v1 + 1) * gb - v1 * gw) / ((v0 + v1) * (v1 + 1) - v1 * v1)
      FROM (SELECT *, n0 * p0 + n1 * p1 - y AS gb, n1 * p1 - y1 + w AS gw, n0 * p0 * (1 - p0) AS v0, n1 * p1 * (1 - p1) AS v1
            FROM (SELECT step.*, c.*, 1 / (1 + exp(-b)) AS p0, 1 / (1 + exp(-b - w)) AS p1 FROM step, c WHERE k < 25)))"""


@query(
    "logit_optimum",
    f"""WITH RECURSIVE {READINGS}, m AS (SELECT CASE WHEN precipitation > 0 THEN 1 ELSE 0 END AS y, CASE WHEN wind_speed >= 20 THEN 1 ELSE 0 END AS x FROM r), {_NEWTON}
    SELECT round(w, 3) AS weight, round(b, 3) AS intercept FROM step WHERE k = 25""",
)
def logit_optimum(t: Tables) -> DataFrame:
    """The logistic model of one feature has its optimum where SQL finds it."""
    rows = stage(_table(t).select("rain_flag", (F.col("wind_speed") >= 20).cast("double").alias("windy")), "logit")
    chosen = models.Features.fit(rows, ["windy"])
    learner = models.fit(models.rain_logit(chosen, rows.count()), chosen, rows, "rain_flag").pipeline.stages[-1]
    found = t.spark.createDataFrame([(float(learner.coefficients[0]), float(learner.intercept))], "weight double, intercept double")
    return found.select(*[F.round(c, 3).alias(c) for c in found.columns])


# Away from the split that makes the label every forest must find the class.
_CLEAR = "CASE WHEN abs(value - 100) > 20 THEN CAST(value > 100 AS INTEGER) END AS clear"


def _clear(rows: DataFrame) -> DataFrame:
    return rows.withColumn("clear", F.when(F.abs(F.col("temperature") - 100) > 20, F.col("prediction").cast("int")))


@query("score", f"SELECT event_id, true AS in_range, true AS agrees, {_CLEAR} FROM events")
def score(t: Tables) -> DataFrame:
    """Class and probability for every reading, from a model trained on all of them."""
    rows = stage(_table(t), "features")
    chosen = models.rain_features(rows)
    model = models.fit(models.scaled(chosen, models.rain_forest()), chosen, rows, "rain_flag")
    share = F.col("probability")
    agrees = (F.col("prediction") == 1) == (share > 0.5)
    return _clear(model.score(rows)).select("event_id", share.between(0, 1).alias("in_range"), agrees.alias("agrees"), "clear")


@query("importance", "SELECT 10 AS listed, 1.0::DOUBLE AS total, true AS falling, 'temperature' AS strongest FROM region LIMIT 1")
def importance(t: Tables) -> DataFrame:
    """The ten strongest features: listed, falling, led by the one that makes the label, and all features together weigh 1."""
    model, _ = models.train_rain(stage(_table(t), "features"), "event_id")
    best = model.importance(k=10).collect()  # ten rows
    weights = [r.importance for r in best]
    every = model.importance().agg(F.round(F.sum("importance"), 6).alias("total"))
    return every.select(F.lit(len(weights)).alias("listed"), "total", F.lit(weights == sorted(weights, reverse=True)).alias("falling"), F.lit(best[0].feature).alias("strongest"))


@query("model_roundtrip", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS changed, '1.0.0' AS version FROM events")
def model_roundtrip(t: Tables) -> DataFrame:
    """Train, save, load, and score every reading with both: none differs."""
    rows = stage(_table(t), "features")
    model, scored = models.train_rain(rows, "event_id")
    path = new_path(t.spark, "model")
    model.save(path, models.classifier_report(scored, "rain_flag"))
    loaded, meta = models.load(t.spark, path)
    before = model.score(rows).select("event_id", F.col("probability").alias("before"))
    both = loaded.score(rows).select("event_id", "probability").join(before, "event_id", "full")
    out = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("probability").eqNullSafe(F.col("before"))).alias("changed"))
    return out.withColumn("version", meta.select("version").scalar())


@query(
    "cv_rain",
    f"""WITH {_LABELLED}, n AS (SELECT rain_flag, count(*) AS n FROM t GROUP BY 1), k AS (SELECT unnest(range(5)) AS fold)
    SELECT CAST(fold AS INTEGER) AS fold, CAST(sum(n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END) AS BIGINT) AS n, true AS in_range FROM n, k GROUP BY 1""",
)
def cv_rain(t: Tables) -> DataFrame:
    """Five stratified folds of all rows, scored by AUC."""
    rows = stage(_table(t), "features")
    result = models.rain_cross_validation(rows, models.rain_features(rows), "event_id").first()
    marked = with_stratified_folds(rows, "rain_flag", "event_id")
    return marked.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).withColumn("in_range", F.lit(0.97 < result.cv_mean <= 1 and result.cv_std >= 0))


@query(
    "cv_temp",
    """SELECT CAST(floor((event_id % 2147483648) * 2654435761 % 4294967296 / 4294967296.0::DOUBLE * 5) AS INTEGER) AS fold,
              count(*) AS n, true AS in_range FROM events GROUP BY 1""",
)
def cv_temp(t: Tables) -> DataFrame:
    """Five plain folds of all rows, scored by mean absolute error."""
    rows = stage(_table(t), "features")
    share = portable_share("event_id")
    result = models.temperature_cross_validation(rows, models.temperature_features(rows), "event_id", share=share).first()
    spread = rows.agg(F.stddev_pop("temperature").alias("s")).first().s
    marked = with_folds(rows, "event_id", share=share)
    return marked.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).withColumn("in_range", F.lit(0 <= result.cv_mean < spread / 4))


@query(
    "strat_folds",
    f"""WITH {SCORED}, n AS (SELECT label, count(*) AS n FROM s GROUP BY 1), k AS (SELECT unnest(range(5)) AS fold)
    SELECT label, CAST(fold AS INTEGER) AS fold, n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS n FROM n, k""",
)
def strat_folds(t: Tables) -> DataFrame:
    marked = with_stratified_folds(_scored(t), "label", "event_id")
    return marked.groupBy("label", "fold").agg(F.count("*").alias("n"))


@query(
    "plain_folds",
    """SELECT event_id, CAST(floor((event_id % 2147483648) * 2654435761 % 4294967296 / 4294967296.0::DOUBLE * 5) AS INTEGER) AS fold
       FROM events""",
)
def plain_folds(t: Tables) -> DataFrame:
    return with_folds(t.events.select("event_id"), "event_id", share=portable_share("event_id"))


@query(
    "batch_scoring",
    f"""SELECT event_id AS weather_data_id, '1.0.0' AS model_version, '2024-01-31 00:00:00' AS predicted_at, true AS agrees, {_CLEAR} FROM events
       WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND event_id % 2 <> 0""",
)
def batch_scoring(t: Tables) -> DataFrame:
    """The last day's readings without a prediction, scored into prediction rows."""
    rows = stage(_table(t), "features")
    model, _ = models.train_rain(rows, "event_id")
    made = rows.filter("event_id % 2 = 0").select(
        F.col("event_id").alias("weather_data_id"), F.col("ts").alias("predicted_at")
    )
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    out = models.score_unscored(rows, made, model, now, key="event_id", time="ts", hours=24)
    agrees = F.col("confidence").between(0, 1) & (F.col("prediction").cast("boolean") == (F.col("confidence") > 0.5))
    stamp = F.date_format("predicted_at", "yyyy-MM-dd HH:mm:ss")
    out = _clear(out.join(rows.select(F.col("event_id").alias("weather_data_id"), "temperature"), "weather_data_id"))
    return out.select("weather_data_id", "model_version", stamp.alias("predicted_at"), agrees.alias("agrees"), "clear")


@query(
    "encode_unseen",
    """WITH m AS (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS code
                  FROM (SELECT DISTINCT p_type FROM part WHERE p_size < 10))
    SELECT p_partkey, code AS p_type_encoded FROM part LEFT JOIN m USING (p_type)""",
)
def encode_unseen(t: Tables) -> DataFrame:
    """A mapping fitted on some rows and kept for the others."""
    mapping = label_mapping(t.part.filter("p_size < 10"), "p_type")
    return encode_labels(t.part, "p_type", mapping).select("p_partkey", "p_type_encoded")


# ---- forecasts ---------------------------------------------------------------


def _series(t: Tables) -> DataFrame:
    return stage(t.hourly, "hourly")


@query(
    "seasonal_ar1",
    f"""WITH {HOURLY},
    w AS (SELECT city, observed_at, temperature - lag(temperature, 24) OVER (PARTITION BY city ORDER BY observed_at) AS w FROM h),
    l AS (SELECT city, w, lag(w) OVER (PARTITION BY city ORDER BY observed_at) AS w1 FROM w)
    SELECT city, round(regr_slope(w, w1), 6) AS ar1, round(regr_intercept(w, w1), 6) AS intercept,
           regr_count(w, w1) AS n_obs FROM l GROUP BY 1""",
)
def seasonal_ar1(t: Tables) -> DataFrame:
    spec = Forecaster(["city"], ["observed_at"], orders=Orders((1, 0, 0), (0, 1, 0, 24), constant=True))
    beta = F.col("coefficients")
    fit = spec.fit(_series(t)).no_exog
    return fit.select("city", F.round(beta[0], 6).alias("ar1"), F.round(beta[1], 6).alias("intercept"), "n_obs")


def _ahead(mode: str) -> str:
    """The lag column of a buffer list at a step, newest value first."""
    back = "step + {k}" if mode == "reference" else "greatest({k} - step, 1)"
    lag = lambda v, k: f"CASE WHEN {back.format(k=k)} <= 6 THEN {v}[{back.format(k=k)}] ELSE {v}[{1 if mode == 'reference' else 6}] END"
    mean = lambda v, n: "round((" + " + ".join(f"{v}[{i}]" for i in range(1, n + 1)) + f") / {n}, 6)"
    names = [("v", "humidity"), ("p", "pressure")]
    listed = [f"{lag(v, k)} AS {c}_lag_{k}" for v, c in names for k in (1, 2)] + [f"{mean(v, n)} AS {c}_ma_{n}" for v, c in names for n in (3, 6)]
    return f"""WITH {HOURLY},
    b AS (SELECT city, list(humidity ORDER BY observed_at DESC) AS v, list(pressure ORDER BY observed_at DESC) AS p
          FROM (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY city ORDER BY observed_at DESC) <= 6) GROUP BY 1),
    s AS (SELECT unnest(range(12)) AS step)
    SELECT city, CAST(step AS INTEGER) AS step, {", ".join(listed)} FROM b, s"""


def _future(t: Tables, mode: str) -> DataFrame:
    spec = Forecaster(["city"], ["observed_at"], exog=("humidity", "pressure"), exog_lags=2)
    out = spec.future_exog(t.hourly, 12, mode=mode)
    return out.withColumns({f"{c}_ma_{w}": F.round(f"{c}_ma_{w}", 6) for c in ("humidity", "pressure") for w in (3, 6)})


@query("future_exog", _ahead("reference"))
def future_exog(t: Tables) -> DataFrame:
    return _future(t, "reference")


@query("future_exog_held", _ahead("hold_last"))
def future_exog_held(t: Tables) -> DataFrame:
    return _future(t, "hold_last")


def _fitted(t: Tables):
    spec = Forecaster(["city"], ["observed_at"], exog=EXOG, exog_lags=2)
    series = _series(t)
    longest = largest_group(series, spec.keys)
    rows = stage(spec.split(spec.prepare(series, longest=longest), longest=longest), "prepared")
    return spec, spec.fit(rows, longest=longest)


@query("series_eval")
def series_eval(t: Tables) -> DataFrame:
    spec, fitted = _fitted(t)
    return spec.evaluate(fitted)


@query("test_predictions")
def test_predictions(t: Tables) -> DataFrame:
    spec, fitted = _fitted(t)
    return spec.test_predictions(fitted)


@query("model_diagnostics")
def model_diagnostics(t: Tables) -> DataFrame:
    spec, fitted = _fitted(t)
    out = spec.diagnostics(fitted)
    return out.select("city", "aic", "bic", "llf", "n_obs", "resid_mean", "resid_std", "resid_skew", "resid_kurtosis")


@query("city_forecast")
def city_forecast(t: Tables) -> DataFrame:
    """Recent rows, fit per city, refit on everything, 24 hours ahead with intervals."""
    spec = Forecaster(["city"], ["observed_at"], exog=EXOG, exog_lags=2)
    return train_and_forecast(_series(t).withColumn("is_known", F.lit(True)), spec)["forecast"]


@query("city_forecast_summary")
def city_forecast_summary(t: Tables) -> DataFrame:
    spec = Forecaster(["city"], ["observed_at"], exog=EXOG, exog_lags=2)
    return train_and_forecast(_series(t), spec)["summary"]


@query("single_series")
def single_series_forecast(t: Tables) -> DataFrame:
    """The whole table as one hourly series, (1,1,1) with a constant and known regressors."""
    hourly = t.readings.groupBy(F.date_trunc("hour", "ts").alias("observed_at")).agg(
        *[F.avg(c).alias(c) for c in ("temperature", "humidity", "pressure", "wind_speed")]
    )
    spec = single_series(["observed_at"], exog=("humidity", "pressure", "wind_speed"))
    rows = stage(spec.split(as_single_series(hourly)), "series")
    return spec.evaluate(spec.fit(rows))


@query("single_series_seasonal")
def single_series_seasonal(t: Tables) -> DataFrame:
    """(3,1,2)x(1,1,1,24) with two regressors."""
    hourly = t.readings.groupBy(F.date_trunc("hour", "ts").alias("observed_at")).agg(
        *[F.avg(c).alias(c) for c in ("temperature", "humidity", "pressure")]
    )
    spec = single_series(["observed_at"], exog=("humidity", "pressure"), orders=Orders((3, 1, 2), (1, 1, 1, 24)))
    rows = stage(spec.split(as_single_series(hourly)), "series")
    return spec.evaluate(spec.fit(rows))


# ---- stream ------------------------------------------------------------------


@query(
    "stream_hourly",
    """WITH a AS (SELECT user_id, date_trunc('hour', ts) AS period, count(*) AS measurement_count,
                         round(avg(value), 6) AS mean_value FROM events GROUP BY 1, 2)
    SELECT user_id, period, measurement_count, mean_value FROM a
    WHERE period + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def stream_hourly(t: Tables) -> DataFrame:
    """Hours the watermark has closed, each reading counted once, written by date."""
    flat = streaming.parquet_stream(t.spark, t.folder, t.events.schema, pattern="events.parquet").select(
        F.col("user_id").cast("double").alias("lon"),
        F.lit(0.0).alias("lat"),
        F.col("event_id").alias("dt"),
        F.col("value").alias("temperature"),
        F.col("ts").cast("timestamp").alias("observed_at"),
    )
    once = streaming.process_once(flat, ["lon", "dt"], "observed_at")
    means = streaming.hourly.coordinate_means(once, bucket="1 hour", digits=6).withColumns(
        {"Date": F.to_date("period"), "Hour": F.hour("period")}
    )
    target = new_path(t.spark, "stream")
    streaming.write_periods(means, target, new_path(t.spark, "offsets"), keys=["Hour", "lon", "lat"]).awaitTermination()
    return t.spark.read.parquet(target).select(
        F.col("lon").cast("long").alias("user_id"),
        F.col("period").cast("timestamp_ntz").alias("period"),
        "measurement_count",
        F.col("avg_temperature").alias("mean_value"),
    )
