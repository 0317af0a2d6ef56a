"""A corpus from raw documents in five stages, each written as Parquet and read again by the next.

1. ``quality``: documents that the quality classifier rejects (score below the limit) go.
2. ``near_dedup``: of every group of near copies one document stays.
3. ``pii``: personal data in the texts is replaced by its kind.
4. ``mix``: sources are cut or repeated to their target weights.
5. ``pieces``: texts become token ids, which are read back.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import classifier, mixing, pieces, pii, simhash
from isobar.llm.queries import GOOD
from isobar.llm.text import with_columns
from isobar.staging import discard, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the limit, fitted on ``labels`` without the held-out rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = classifier.quality_model(docs, labels)
    return docs.filter(classifier.score(model, F.col("text")) >= GOOD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near copies."""
    return simhash.one_of_each(docs, shingle=3, distance=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; ``n_chars`` follows."""
    clean = docs.withColumn("text", pii.redacted(F.col("text"), pii.fit(docs)))
    return clean.select(with_columns(clean, {"n_chars": F.char_length("text").cast("long")})).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each pass over a document, the first and last of a shard cut to the words taken."""
    return mixing.sample(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id lang source ids n_tokens decoded_sha256`` with begin and end ids; the digest is of the text the ids decode to."""
    made = pieces.coded(spark, F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    coded = docs.select("doc_id", "lang", "source", made.alias("made")).select("doc_id", "lang", "source", "made.*")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded_sha256")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pii", personal_data), ("mix", mix), ("pieces", to_pieces)]

#: The classifier, the field and the tokenizer can't be said in SQL; tests/llm compares with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents`` below ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)  # its last reader is written
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
