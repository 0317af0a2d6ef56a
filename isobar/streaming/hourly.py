"""The hourly aggregation as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from isobar.operators import hourly
from isobar.schema import DOCUMENT
from isobar.sources.tables import replace_rows
from isobar.staging import apart, discard, stage


def document_stream(spark: SparkSession, path: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """New JSON documents below ``path`` under the fixed schema."""
    reader = spark.readStream.schema(DOCUMENT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def process_once(readings: DataFrame, keys: list[str], time: str, *, delay: str = "1 hour") -> DataFrame:
    """Drop repeats of a reading that arrive within the watermark.

    With the checkpoint's source offsets this replaces a processed flag.
    """
    return readings.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def hourly_means(readings: DataFrame, time: str = "observed_at", *, bucket: str = "1 hour") -> DataFrame:
    """Event-time means per coordinate and hour; ``readings`` carries the watermark."""
    return hourly.coordinate_means(readings, bucket=bucket, time=time)


def hourly_stream(
    documents: DataFrame, city: DataFrame, country: DataFrame | None = None, *, delay: str = "1 hour"
) -> DataFrame:
    """Documents to stored hourly rows: once each, averaged per hour, joined to cities.

    The city side is static and re-read per batch.  A batch without new documents
    still emits the hours its watermark closes; Spark measures such a batch by its
    documents, would take the means for empty and broadcast them all, so the join is
    told to sort and merge.
    """
    flat = hourly.flatten(documents).withColumn("observed_at", F.timestamp_seconds("dt"))
    once = process_once(flat, ["lon", "lat", "dt"], "observed_at", delay=delay)
    joined = hourly.with_city(hourly_means(once).hint("merge"), city, country)
    return hourly.hourly_fact(joined)


#: Progress reports kept by a drain, one for each batch, so that none is lost before they are read.
REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
MOST_BATCHES = 100_000


def write_periods(
    stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] = ("Date",), keys: list[str] = ("Hour", "idCity")
) -> StreamingQuery:
    """Process everything available, then stop.

    An hour is emitted once, when the watermark passes it.  Its rows replace
    the stored ones of the same ``partition_by`` and ``keys`` and no others,
    so a replayed batch or a stream started afresh is harmless to other cities' rows.
    A stream's own session plans without adaptive execution, which would leave the
    rows ungathered; the written batch is stored by the caller's session.
    """
    spark = stream.sparkSession
    spark.conf.set(REPORTS, str(MOST_BATCHES))

    def replace(batch: DataFrame, _: int) -> None:
        written = stage(batch, "batch")  # read more than once
        rows = apart(written, spark)
        if not rows.isEmpty():
            replace_rows(rows, target, list(partition_by), list(keys))
        discard(written)

    return (
        stream.writeStream.outputMode("append")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


COUNTERS = "run string, batch long, watermark string, rows_read long, rows_late long"


def batch_counters(query: StreamingQuery) -> list[tuple[str, int, str | None, int, int]]:
    """(run, batch, watermark, rows read, rows too late) of every batch of this run; a late row is dropped by the first operator that keeps state."""
    out = []
    for report in query.recentProgress:
        late = sum(s.numRowsDroppedByWatermark for s in report.stateOperators)
        out.append((str(report.runId), int(report.batchId), report.eventTime.get("watermark"), int(report.numInputRows), int(late)))
    return out


def drain(stream: DataFrame, target: str, checkpoint: str, counters: str, **how) -> DataFrame:
    """``write_periods`` to its end; this run's counters are appended below ``counters`` and returned.

    What the watermark drops is never stored, so its number is: a run with
    late rows asks for the batch job over their hours.
    """
    query = write_periods(stream, target, checkpoint, **how)
    query.awaitTermination()
    rows = stream.sparkSession.createDataFrame(batch_counters(query), COUNTERS)  # a row for each batch
    rows.coalesce(1).write.mode("append").parquet(counters)
    return rows
