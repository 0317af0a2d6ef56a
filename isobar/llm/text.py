"""Words and row handling shared by the text operators.

A word is a longest run of characters other than space and the five ASCII
control characters from tab to carriage return.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text; NULL, empty and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def packed(docs: DataFrame, kept: list[str] | None = None, **named: Column) -> DataFrame:
    """The row (or its ``kept`` columns) as ``row`` beside ``named`` columns, so that no column of the input clashes with a working one."""
    columns = docs.columns if kept is None else kept
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), *[c.alias(n) for n, c in named.items()])


def unpacked(df: DataFrame, docs: DataFrame, *more: Column) -> DataFrame:
    """The columns of ``docs`` again, from ``row``."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], *more)


def with_columns(docs: DataFrame, added: dict[str, Column]) -> list[Column]:
    """Projection of ``docs`` with ``added``; an input column of the same name gives way."""
    return [F.col(f"`{c}`") for c in docs.columns if c not in added] + [v.alias(k) for k, v in added.items()]


RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches() -> None:
    """Hand whole texts to Python some hundred at a time, unless the session asks for another number.

    Spark's default of 10,000 rows is meant for numbers: with texts a worker
    would hold hundreds of megabytes.
    """
    spark = SparkSession.active()
    if spark.conf.get(RECORDS) == "10000":
        spark.conf.set(RECORDS, "500")


def text_udf(run: Callable, returns: str):
    """An Arrow function on columns of texts."""
    small_batches()
    return F.arrow_udf(run, returns)


def each(array: pa.Array, at_once: int = 64) -> Iterator:
    """The values of an Arrow array as Python objects, few of them alive at a time."""
    for begin in range(0, len(array), at_once):
        yield from array.slice(begin, at_once).to_pylist()
