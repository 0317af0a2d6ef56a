"""Table readers and writers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.staging import discard, stage


@dataclass(frozen=True)
class Database:
    """Where a JDBC database is, and how it is entered."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Slices:
    """A numeric or time column whose range is read in parallel slices."""

    column: str
    lower: Any
    upper: Any
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def jdbc_reader(spark: SparkSession, db: Database, source: str, slices: Slices | None = None) -> DataFrameReader:
    options = {"url": db.url, "dbtable": source, **db.properties, **(slices.options() if slices else {})}
    return spark.read.format("jdbc").options(**options)


def read_table(spark: SparkSession, table: str, db: Database | None = None, slices: Slices | None = None) -> DataFrame:
    """A catalog table or view, or a JDBC table (sliced, or else one task reads it all)."""
    return spark.table(table) if db is None else jdbc_reader(spark, db, table, slices).load()


def read_query(
    spark: SparkSession, sql: str, params: dict[str, Any] | None = None, tables: dict[str, DataFrame] | None = None
) -> DataFrame:
    """A SELECT with ``:name`` parameters, bound as values rather than pasted as text.

    ``tables`` are registered as views under their names first.
    """
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=params or {})


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Only the schema's columns, in its order and types; bad times become NULL."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


# What to do with a table that is already there, and Spark's name for it.
WRITE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists", "ignore": "ignore"}


def write_table(
    df: DataFrame,
    target: str,
    schema: T.StructType | None = None,
    *,
    if_exists: str = "append",
    db: Database | None = None,
    partition_by: list[str] = (),
) -> None:
    """Project to ``schema`` and write to a parquet path, or to a JDBC table.

    ``if_exists`` is one of ``WRITE_MODES``; anything else is an error, so that
    a typing mistake never replaces a table.
    """
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists is one of {', '.join(WRITE_MODES)}, not {if_exists!r}")
    mode = WRITE_MODES[if_exists]
    out = typed(df, schema) if schema is not None else df
    if db is not None:
        out.write.mode(mode).jdbc(db.url, target, properties=db.properties)
    else:
        out.write.mode(mode).partitionBy(*partition_by).parquet(target)


def replace_periods(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions present in ``df``, so a retry leaves no duplicates.

    Rows are gathered by partition first, or every task would open a file in
    every partition; the rebalance splits a partition that is too large again.
    """
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by])
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def replace_rows(df: DataFrame, path: str, partition_by: list[str], keys: list[str]) -> None:
    """Replace the stored rows that agree with one of ``df`` in ``partition_by`` and ``keys``; all others stay.

    Only the partitions that ``df`` touches are read and written again.  A task
    that fails leaves the old files, and a retry gives the same rows.  The rows'
    keys are as many as the rows, and far larger than their compressed files by which
    Spark would choose to broadcast them, so they are met by sorting.
    """
    spark, merged = df.sparkSession, None
    if exists(spark, path):
        stored = spark.read.schema(df.schema).parquet(path)
        touched = df.select(*partition_by).distinct()
        mine = df.select(*partition_by, *keys)
        others = stored.join(touched, partition_by, "left_semi").join(mine.hint("merge"), [*partition_by, *keys], "left_anti")
        # Written first: the files that are read are about to be replaced.
        df = merged = stage(df.unionByName(others), "merged")
    replace_periods(df, path, partition_by)
    if merged is not None:
        discard(merged)


# The source names callers use and the table each one holds.
SOURCE_TABLES = {"iot_weather_db": "weather_hour", "weather_db": "weather_data"}


def load_processed_data(
    source: str, loaders: dict[str, Callable[[str], DataFrame]] | Callable[[str], DataFrame]
) -> DataFrame:
    """Load a named source through its loader (or the one loader for all of them)."""
    if source not in SOURCE_TABLES:
        raise ValueError(f"source '{source}' is not supported")
    load = loaders[source] if isinstance(loaders, dict) else loaders
    return load(SOURCE_TABLES[source])
