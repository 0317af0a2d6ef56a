"""The scheduled jobs end to end."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators import hourly, quality
from isobar.operators.clean import clean
from isobar.operators.columns import canonical_hourly, first_keys, keep_keys, recent
from isobar.operators.features import engineer, observed_at
from isobar.operators.joins import unprocessed
from isobar.operators.ordered import largest_group
from isobar.operators.quality import StageCounts
from isobar.operators.series import enough_rows
from isobar.operators.sums import CELL, SUMS_SCHEMA, cell_sums, means_of, merged_sums
from isobar.plans.forecast import Forecaster
from isobar.schema import MEASURES
from isobar.sources.ledger import DAY, K1, K2, READING_KEY, RUN, Ledger, read_days, write_run
from isobar.sources.tables import replace_rows
from isobar.staging import discard, stage


def hourly_rows(
    documents: DataFrame,
    city: DataFrame,
    country: DataFrame | None,
    now: Column,
    *,
    hours_back: int = 1,
    bucket: str | None = None,
    only_unprocessed: bool = False,
) -> DataFrame:
    """Recent documents to stored hourly rows, one lazy plan.

    Without ``bucket`` the recent documents are one period.  With it, every
    hour that a recent (and, if asked, unprocessed) document falls into is
    averaged from all of its documents up to ``now``, so a run at half past the
    hour gives the first hour whole and the current one as far as it is known.
    """
    due = hourly.recent_documents(documents, now, hours_back=hours_back)
    if only_unprocessed:
        due = due.filter(unprocessed(due, F.lit(0)))
    if bucket:
        hour = F.floor(F.col("dt") / 3600)
        touched = due.select(hour.alias("__hour")).distinct()
        first = F.date_trunc("hour", now - F.make_dt_interval(F.lit(0), F.lit(hours_back)))
        known = documents.filter(F.col("dt").between(F.unix_seconds(first.cast("timestamp")), F.unix_seconds(now.cast("timestamp"))))
        due = known.withColumn("__hour", hour).join(touched, "__hour", "left_semi")
    means = hourly.coordinate_means(hourly.flatten(due), bucket=bucket)
    joined = hourly.with_city(means, city, country)
    return hourly.hourly_fact(joined, None if bucket else now)


def run_hourly(
    documents: DataFrame,
    city: DataFrame,
    country: DataFrame | None,
    now: Column,
    target: str,
    *,
    hours_back: int = 1,
    bucket: str | None = None,
    only_unprocessed: bool = False,
) -> DataFrame:
    """Aggregate and store; a retry replaces its own (city, date, hour) rows.  Returns the run's report.

    Rows are counted while they are staged.  This job averages every document
    of an hour again; ``run_new_documents`` reads only what no run has read.
    """
    counts = StageCounts()
    made = hourly_rows(documents, city, country, now, hours_back=hours_back, bucket=bucket, only_unprocessed=only_unprocessed)
    rows = stage(counts.watch(made, "aggregation"), "hourly")
    replace_rows(rows, target, ["Date", "Hour"], ["idCity"])
    counts.done("aggregation")
    return counts.report(documents.sparkSession)


@dataclass(frozen=True)
class HourlyStore:
    """Where ``run_new_documents`` keeps sums by cell and hour, hourly rows, and keys of processed documents named by ``keys``."""

    folder: str
    keys: tuple[str, ...] = READING_KEY

    @property
    def ledger(self) -> Ledger:
        return Ledger(f"{self.folder}/ledger", self.keys)

    @property
    def sums_path(self) -> str:
        return f"{self.folder}/sums"

    @property
    def facts_path(self) -> str:
        return f"{self.folder}/hourly"


def run_new_documents(
    documents: DataFrame,
    city: DataFrame,
    country: DataFrame | None,
    now: Column,
    store: HourlyStore,
    run: str,
    *,
    hours_back: int | None = None,
) -> DataFrame:
    """Average the documents up to ``now`` that no earlier run has; returns the run's report.

    The documents are staged once as flat readings; sums, hourly rows and ledger all come
    from that copy.  A run adds its sums by cell and hour to the store, merges
    them with those of finished runs for the hours it touches, rounds, and replaces
    the stored (city, date, hour) rows.  Any split of the documents into
    runs leaves the rows of a single run, late documents included.

    ``run`` names the run.  Its name is listed as finished last: until then
    nothing it wrote counts for others, and a retry under the same name
    replaces it.  Only folders of touched days are read or written.  Runs of
    one store follow each other, they don't overlap.  ``hours_back`` limits how
    old a document may be.
    """
    spark, ledger, counts = documents.sparkSession, store.ledger, StageCounts()
    clock = F.unix_seconds(now.cast("timestamp"))
    due = documents.filter(F.col("dt") <= clock)
    if hours_back is not None:
        due = due.filter(F.col("dt") >= clock - hours_back * 3600)
    fresh = ledger.unseen(due, run, lambda new: hourly.flatten(new, K1, K2, DAY))
    batch = stage(counts.watch(fresh, "new documents"), "readings")
    counts.done("new documents")
    if counts.records("new documents"):
        write_run(cell_sums(batch, F.col(DAY)), store.sums_path, run)
        ledger.record(batch, run, now)
        days = [r[0] for r in batch.select(DAY).distinct().collect()]  # a value for each calendar day
        stored = ledger.counting(read_days(spark, store.sums_path, SUMS_SCHEMA, days), run)
        touched = stored.filter(F.col(RUN) == run).select(*CELL).distinct()
        merged = merged_sums(stored.join(touched, CELL, "left_semi"))
        facts = hourly.hourly_fact(hourly.with_city(means_of(merged), city, country))
        rows = stage(counts.watch(facts, "aggregation"), "hourly")
        if counts.records("aggregation"):
            replace_rows(rows, store.facts_path, ["Date"], ["Hour", "idCity"])
        counts.done("aggregation")
        discard(rows)
    ledger.finish(spark, run, now)
    discard(batch)
    return counts.report(spark)


def stored_sums(spark: SparkSession, store: HourlyStore, days: list) -> DataFrame:
    """The merged sums of finished runs for the listed days: ``lon lat hour`` and what ``SUMS_SCHEMA`` names."""
    return merged_sums(store.ledger.counting(read_days(spark, store.sums_path, SUMS_SCHEMA, days)))


def prepare_observations(
    stored: DataFrame, *, outlier_columns: list[str] = MEASURES, fill_keys: list[str] | None = None, counts: StageCounts | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(canonical, cleaned, with features): the modelling table and its two earlier stages.

    Only measures are filled, with ``fill_keys`` by the median of their key.  A row without its city, date or hour belongs to
    no series and is left out of the cleaned table; ``raw`` still has it.
    ``counts`` takes the rows of the three stages (``raw``, ``clean``,
    ``features``) from the two writes made here.
    """
    raw = canonical_hourly(stored)
    read = counts.watch(raw, "raw") if counts else raw
    keyed = read.na.drop(subset=[c for c in ("city_id", "date", "hour") if c in raw.columns])
    measures = [c for c in MEASURES + ["feelslike", "clouds"] if c in raw.columns]
    cleaned = clean(keyed, outlier_columns=outlier_columns, fill_columns=measures, fill_keys=fill_keys, mode_columns=[])
    cleaned = stage(counts.watch(cleaned, "clean") if counts else cleaned, "clean")
    if counts:
        counts.done("clean")
        counts.same_as("features", "clean")  # a row each
    return raw, cleaned, observed_at(engineer(cleaned))


def train_and_forecast(
    features: DataFrame,
    spec: Forecaster,
    *,
    days: int | None = 30,
    keys: list | None = None,
    minimum_rows: int = 100,
    steps: int = 24,
    first: int = 3,
    refit: bool = True,
) -> dict[str, DataFrame]:
    """Recent rows of the chosen series: fit, evaluate on the last fifth, forecast.

    ``refit`` trains the forecasting model on all rows; without it the forecast
    uses the model of the training part.
    """
    rows = recent(features, spec.time[0], days=days) if days else features
    if keys:
        rows = keep_keys(rows, spec.keys[0], keys)
    rows = enough_rows(rows, [], minimum_rows)
    longest = largest_group(rows, spec.keys)  # counted once for all steps
    ready = spec.prepare(rows, longest=longest)
    if spec.unit:  # a grid has more rows
        longest = largest_group(ready, spec.keys)
    prepared = stage(spec.split(ready, longest=longest), "prepared")
    fitted = spec.fit(prepared, longest=longest)
    evaluation = stage(spec.evaluate(fitted), "evaluation")
    # Only the series that are forecast are fitted again.
    chosen = first_keys(prepared.drop("is_train"), spec.keys[0], first)
    forecast = spec.forecast(spec.fit(chosen, longest=longest) if refit else replace(fitted, rows=chosen), steps)
    return {
        "rows": rows,
        "evaluation": evaluation,
        "mean_metrics": quality.mean_metrics(evaluation),
        "forecast": forecast,
        "summary": quality.forecast_summary(forecast, spec.keys),
    }


def final_report(
    stages: dict[str, DataFrame] | DataFrame,
    seconds: dict[str, float] | None = None,
    *,
    score: DataFrame | None = None,
    evaluation: DataFrame | None = None,
    forecast: DataFrame | None = None,
    keys: list[str] = ("city_id",),
) -> DataFrame:
    """The run in rows ``(section, name, item, value)``.

    Record counts and durations per stage (counted here, or a report made by ``StageCounts``), the quality score (``completeness_score`` of a
    one-row table), mean MAE, RMSE and R2 over the series, and each
    series' forecast range.
    """
    report = quality.stage_report(stages, seconds) if isinstance(stages, dict) else stages
    parts = [
        report.select(F.lit("stage").alias("section"), F.col("stage").alias("name"), F.inline(_items(report, ["records", "seconds"])))
    ]
    if score is not None:
        parts.append(score.select(F.lit("quality").alias("section"), F.lit("all").alias("name"), F.inline(_items(score, score.columns))))
    if evaluation is not None:
        means = quality.mean_metrics(evaluation)
        parts.append(means.select(F.lit("model").alias("section"), F.lit("all").alias("name"), F.inline(_items(means, means.columns))))
    if forecast is not None:
        ranges = quality.forecast_summary(forecast, list(keys))
        name = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        wanted = ["next_avg", "min_predicted", "max_predicted"]
        parts.append(ranges.select(F.lit("forecast").alias("section"), name.alias("name"), F.inline(_items(ranges, wanted))))
    return reduce(DataFrame.unionByName, parts)


def _items(df: DataFrame, columns: list[str]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in columns])
