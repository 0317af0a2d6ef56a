"""Encodings of text columns and scaling of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.functions.weather import missing
from isobar.operators.ordered import BLOCK_ROWS, positions

def label_mapping(df: DataFrame, column: str, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(column, <column>_encoded)``: sorted distinct values numbered from 0.

    Fit once on the training table and keep it: encoding another table with its
    own mapping would shift the codes.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    numbered = positions(values, [], [column], name="__at", block_rows=block_rows)
    return numbered.select(column, (F.col("__at") - 1).alias(f"{column}_encoded"))


def encode_labels(df: DataFrame, column: str, mapping: DataFrame | None = None) -> DataFrame:
    """Add ``<column>_encoded``; values the mapping does not know become NULL."""
    return df.join(label_mapping(df, column) if mapping is None else mapping, column, "left")


def one_hot(df: DataFrame, columns: list[str], known: dict[str, list] | None = None) -> DataFrame:
    """A 0/1 column ``<column>_<level>`` per level, all levels kept, the source dropped.

    ``known`` names a column's levels.  Otherwise they are collected, since
    each becomes a column of the result; a column with more levels than a
    table should have columns belongs into ``one_hot_vector``.
    """
    added = {}
    for c in columns:
        found = (known or {}).get(c)
        if found is None:
            found = [r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
        for level in found:
            added[f"{c}_{level}"] = F.when(F.col(c) == level, 1).otherwise(0)
    return df.withColumns(added).drop(*columns)


def one_hot_vector(df: DataFrame, columns: list[str], mappings: dict[str, DataFrame] | None = None) -> DataFrame:
    """``<column>_at``: the place of the 1 among the column's sorted levels, and ``<column>_size``, the number of places.

    The same information as ``one_hot`` in two numbers, for any number of
    levels: the levels stay a table.  A value the mapping does not know has a
    NULL place: all its places are 0.
    """
    for c in columns:
        mapping = (mappings or {}).get(c)
        mapping = label_mapping(df, c) if mapping is None else mapping
        size = mapping.agg(F.count(F.lit(1))).scalar()
        df = encode_labels(df, c, mapping).withColumnRenamed(f"{c}_encoded", f"{c}_at").withColumn(f"{c}_size", size)
    return df


def standardise(df: DataFrame, columns: list[str], *, suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population std from one aggregated pass; a constant column scales to 0."""
    value = {c: missing(F.col(c).cast("double")) for c in columns}
    facts = [F.avg(v).alias(f"m_{c}") for c, v in value.items()]
    facts += [F.stddev_pop(v).alias(f"s_{c}") for c, v in value.items()]
    scale = df.agg(F.struct(*facts)).scalar()
    return df.withColumns(
        {
            f"{c}{suffix}": (v - scale[f"m_{c}"]) / F.when(scale[f"s_{c}"] == 0, 1.0).otherwise(scale[f"s_{c}"])
            for c, v in value.items()
        }
    )
