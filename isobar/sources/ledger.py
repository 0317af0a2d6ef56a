"""What the hourly job has done: keys of processed documents, by day and run, and the runs that count.

Tables only grow.  A run writes into partitions named after itself, so a retry
overwrites its own rows and nothing else; rows of a run count for other runs
once its name stands in the list of finished ones, which is written last.
Reading the keys of some days opens the folders of those days alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.sources.tables import exists

#: A document is known by its place and time, unless a caller names other columns.
READING_KEY = ("coord.lon", "coord.lat", "dt")

K1, K2, DAY, RUN = "__k1", "__k2", "day", "run"


def day_of(epoch: Column) -> Column:
    """The day of an epoch second, whatever the session's time zone; no hour lies in two of them."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(epoch / 86_400).cast("int"))


def keyed(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``df`` with a 128-bit hash of its key columns (NULL is a value) and its day."""
    parts = [F.coalesce(F.to_json(F.struct(F.col(k).alias("v"))), F.lit("")) for k in keys]
    return df.withColumns({K1: F.xxhash64(*parts), K2: F.xxhash64(F.lit(1), *parts), DAY: day_of(F.col("dt"))})


def write_run(rows: DataFrame, path: str, run: str) -> None:
    """Replace the rows that ``run`` wrote for the days of ``rows``; other runs' stay.  Rows are gathered by day first."""
    gathered = rows.withColumn(RUN, F.lit(run)).hint("rebalance", F.col(DAY))
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, RUN).parquet(path)


def read_days(spark: SparkSession, path: str, schema: str, days: list) -> DataFrame:
    """Rows of the listed days, from their folders only."""
    whole = f"{schema}, {DAY} date, {RUN} string"
    if not days or not exists(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path).filter(F.col(DAY).isin(days))


@dataclass(frozen=True)
class Ledger:
    """Append-only tables below one folder; ``keys`` name a document."""

    folder: str
    keys: tuple[str, ...] = READING_KEY

    @property
    def keys_path(self) -> str:
        return f"{self.folder}/keys"

    @property
    def runs_path(self) -> str:
        return f"{self.folder}/runs"

    def finished(self, spark: SparkSession) -> DataFrame:
        """``(run)``: names of the runs that count; a row for each run."""
        if not exists(spark, self.runs_path):
            return spark.createDataFrame([], "run string")
        return spark.read.schema("finished_at timestamp, run string").parquet(self.runs_path).select(RUN).distinct()

    def counting(self, rows: DataFrame, run: str | None = None) -> DataFrame:
        """Rows of finished runs, and of ``run`` itself if given.

        The list of runs goes to the rows: placed by run, all rows of one would meet in one task.
        """
        done = F.broadcast(self.finished(rows.sparkSession).withColumn("__done", F.lit(True)))
        known = F.coalesce(F.col("__done"), F.lit(False))
        return rows.join(done, RUN, "left").filter(known | (F.col(RUN) == run) if run else known).drop("__done")

    def stored_keys(self, spark: SparkSession, days: list) -> DataFrame:
        return read_days(spark, self.keys_path, f"{K1} long, {K2} long, processed_at timestamp", days)

    def unseen(self, documents: DataFrame, run: str, read: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Documents that no other finished run has processed, one of each key, with key hashes and day.

        Documents that share a key are taken to hold the same reading.  One
        without a time belongs to no day and no hour and is left out.  ``read``
        is applied before one of each key is picked and keeps the hashes and the
        day: flat numbers are picked by hashing, nested documents by a sort.
        """
        spark = documents.sparkSession
        rows = keyed(documents, self.keys).filter(F.col(DAY).isNotNull())
        days = [r[0] for r in rows.select(DAY).distinct().collect()]  # a value for each calendar day
        others = self.counting(self.stored_keys(spark, days).filter(F.col(RUN) != run))
        left = rows.join(others.select(DAY, K1, K2), [DAY, K1, K2], "left_anti")
        return (read(left) if read else left).dropDuplicates([DAY, K1, K2])

    def record(self, batch: DataFrame, run: str, now: Column) -> None:
        """Store the keys of a run's documents."""
        write_run(batch.select(K1, K2, now.cast("timestamp").alias("processed_at"), DAY), self.keys_path, run)

    def finish(self, spark: SparkSession, run: str, now: Column) -> None:
        """The run counts from here on; finishing again changes nothing."""
        row = spark.range(1).select(now.cast("timestamp").alias("finished_at"), F.lit(run).alias(RUN))
        row.coalesce(1).write.mode("append").parquet(self.runs_path)

    def processed(self, documents: DataFrame) -> DataFrame:
        """``documents`` with ``processed`` and ``processed_at`` as the ledger has them; nothing is rewritten."""
        rows = keyed(documents.drop("processed", "processed_at"), self.keys)
        spark = documents.sparkSession
        days = [r[0] for r in rows.select(DAY).distinct().collect() if r[0] is not None]
        known = self.counting(self.stored_keys(spark, days)).groupBy(DAY, K1, K2).agg(F.min("processed_at").alias("processed_at"))
        joined = rows.join(known, [DAY, K1, K2], "left")
        return joined.withColumn("processed", F.col("processed_at").isNotNull()).drop(K1, K2, DAY)
