"""File readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from isobar.schema import CORRUPT, DOCUMENT


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON documents under the fixed schema; unreadable ones keep their text."""
    schema = T.StructType([*DOCUMENT.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, parse_dates: list[str] = ()) -> DataFrame:
    """CSV with a header under a given schema (inference would read the files twice)."""
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name in parse_dates else f.dataType) for f in schema])
    df = spark.read.schema(text).csv(path, header=True)
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in parse_dates}) if parse_dates else df


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def read_frame(spark: SparkSession, path: str, format: str = "csv", schema: T.StructType | None = None) -> DataFrame:
    if format == "csv":
        if schema is None:
            raise ValueError("reading csv needs a schema")
        return read_csv(spark, path, schema)
    if format == "parquet":
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    raise ValueError(f"format {format} is not supported")


def write_frame(df: DataFrame, path: str, format: str = "csv", *, mode: str = "overwrite") -> None:
    if format == "csv":
        write_csv(df, path, mode=mode)
    elif format == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"format {format} is not supported")


def list_objects(spark: SparkSession, path: str, *, pattern: str | None = None) -> DataFrame:
    """File catalogue below ``path``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "modificationTime", "length")
