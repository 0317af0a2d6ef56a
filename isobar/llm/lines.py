"""Lines that stand in many documents, by range-partitioned hashes read in order.

* Every line becomes a hash of 128 bits with its document and position; texts
  stay where they are.  The hashes are written once, all passes read them.
* Hashes are range-partitioned, and inside a partition sorted by hash, document
  and position.  One stream over a partition sees all places of a line next to
  each other: the first one, and where a new document begins.
* A hash with a large share of all rows would fill one partition.  A sketch
  over all rows names such hashes (it misses none above a four thousandth of
  the rows); their documents are counted with map-side combining, and their rows
  meet the few totals by a broadcast join instead of travelling.
* What returns to a document is a keep bitmap: 64 lines a word, words that keep
  all their lines left out.

A document is a distinct pair of key and text: rows that agree in both count
once and get the same bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.text import BLANKS
from isobar.staging import discard, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Heavy hashes named by the sketch, and the rows from which one counts as heavy.
HEAVIEST, HEAVY_ROWS = 1000, 1000


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else unchanged; texts of ASCII alone take the shorter way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """What two lines are compared by: without blanks at both ends, A-Z lower-cased."""
    return lowered(F.btrim(line, F.lit(BLANKS)))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def _body(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def places(docs: DataFrame, *, shortest: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(id, th, pos, h1, h2)`` for every line whose key has at least ``shortest`` code points; ``th`` is the text's hash."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(_body(text)).alias("th"), _body(text).alias("body"))
    # The outer form keeps the optimizer from splitting once more to test for empty lists, which there are none of.
    lines = rows.select("id", "th", F.posexplode_outer(split_lines(F.col("body"))).alias("pos", "line"))
    lines = lines.select("id", "th", "pos", line_key(F.col("line")).alias("k")).filter(F.char_length("k") >= shortest)
    return lines.select("id", "th", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(1), "k").alias("h2"))


def heavy_hashes(found: DataFrame, *, most: int = HEAVIEST, rows: int = HEAVY_ROWS) -> list[int]:
    """At most ``most`` hashes with about ``rows`` places or more; they only decide which way a line is counted."""
    if not most:
        return []
    listed = found.agg(F.expr(f"approx_top_k(h1, {most}, {10 * most})")).first()[0] or []
    return sorted(r["item"] for r in listed if r["count"] >= rows)


def _along_order() -> list[Column]:
    return [F.col("id").asc_nulls_last(), F.col("th").asc(), F.col("pos").asc()]


def _ranged(found: DataFrame, least: int, keep_first: bool) -> DataFrame:
    """Places to drop, from one ordered stream per range of hashes."""
    same = Window.partitionBy("h1", "h2")
    along = same.orderBy(*_along_order())
    ranged = found.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", *_along_order())
    still = F.lag("id").over(along).eqNullSafe(F.col("id")) & (F.lag("th").over(along) == F.col("th"))
    opened = ranged.select("*", (~F.coalesce(still, F.lit(False))).cast("int").alias("opens"), (F.row_number().over(along) == 1).alias("first"))
    counted = opened.withColumn("documents", F.sum("opens").over(same)).filter(F.col("documents") >= least)
    return (counted.filter(~F.col("first")) if keep_first else counted).select("id", "th", "pos")


def _heavy(found: DataFrame, least: int, keep_first: bool) -> DataFrame:
    """The same for heavy hashes: totals by partial aggregation, a row per hash, broadcast back."""
    each = found.groupBy("h1", "h2", "id", "th").agg(F.min("pos").alias("pos"))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "th", "pos")
    totals = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("documents"), F.min(place).alias("first"))
    totals = totals.filter(F.col("documents") >= least).select("h1", "h2", "first")
    met = found.join(F.broadcast(totals), ["h1", "h2"])  # at most a row for each heavy hash
    return (met.filter(place != F.col("first")) if keep_first else met).select("id", "th", "pos")


def keep_bitmaps(
    docs: DataFrame,
    *,
    least: int = 10,
    shortest: int = 1,
    keep_first: bool = False,
    text: str = "text",
    key: str = "doc_id",
    heaviest: int = HEAVIEST,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``(id, th, keep, n_dropped)`` for the documents that lose lines.

    Lines whose key has at least ``shortest`` code points and stands in at
    least ``least`` documents go; with ``keep_first`` the first of them stays
    (smallest key, NULL last, then text hash, then position).  ``keep`` lists
    ``(word, bits)``: bit b of a word says whether line 64 * word + b stays;
    words without a dropped line are left out.  NULL and empty texts have one
    empty line.  Documents without a dropped line and empty tables have no row.
    """
    found = stage(places(docs, shortest=shortest, text=text, key=key), "lines")
    heavy = heavy_hashes(found, most=heaviest, rows=heavy_rows)
    if heavy:
        rare = _ranged(found.filter(~F.col("h1").isin(heavy)), least, keep_first)
        gone = rare.unionAll(_heavy(found.filter(F.col("h1").isin(heavy)), least, keep_first))
    else:
        gone = _ranged(found, least, keep_first)
    word = F.shiftright("pos", 6).alias("word")
    bits = gone.groupBy("id", "th", word).agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"))
    words = F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits"))))
    made = stage(bits.groupBy("id", "th").agg(words.alias("keep"), F.sum(F.bit_count("bits")).alias("n_dropped")), "bitmaps")
    discard(found)
    return made


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` that a bitmap keeps, joined by line feeds; NULL bitmap: the text as it is."""

    def left(lines: Column) -> Column:
        dropped = F.flatten(
            F.transform(keep, lambda w: F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w["bits"], b) == 0), lambda b: w["word"] * 64 + b))
        )
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(stay, lambda n: F.get(lines, n)), "\n")

    # Bound to a variable, the lines are split once and not once for each of them.
    return F.when(keep.isNull(), text).otherwise(F.get(F.transform(F.array(split_lines(text)), left), 0))


def deduplicated(docs: DataFrame, *, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """``(id, n_lines, n_dropped, kept)``, a row for every row of ``docs``, by ``keep_bitmaps`` (which takes ``how``)."""
    marks = keep_bitmaps(docs, text=text, key=key, **how).select(F.col("id").alias("owner"), F.col("th").alias("digest"), "keep", "n_dropped")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(_body(text)).alias("th"), _body(text).alias("body"))
    joined = rows.join(marks, F.col("id").eqNullSafe(F.col("owner")) & (F.col("th") == F.col("digest")), "left")
    return joined.select(
        "id",
        F.size(split_lines(F.col("body"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        kept_text(F.col("body"), F.col("keep")).alias("kept"),
    )
