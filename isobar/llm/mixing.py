"""Mixing sources to target weights: integer quotas of equal-token blocks by highest quotients, then seeded blocks.

1. Every source gets a target: the mix takes ``share`` of all words, dealt by
   weight; a target stops at ``most`` times its source, what is left over goes
   to the others by weight.
2. The mix is cut into blocks of ``block_words`` words.  Blocks go one after
   the other to the source with the highest quotient target / (2 k + 1), k
   being the blocks it has (Sainte-Lague); a source's blocks go to its shards
   in the same way, by shard size.
3. A shard is its documents in the order of a seeded hash, read in a circle.
   Its blocks are the ones that follow a seeded starting block, so a quota
   above the shard's size reads documents a second time.

Quotients are not listed from the first block on: rounding target / block
gives the seats down to one quotient, and only the few next to it are ranked.

Shards keep a hot source out of one task: their number follows the source's
words.  The source and shard tables hold one row per source and at most
``shards`` + sources rows; they are broadcast only where they are counted to be
small, and joined by shuffle beyond.  Sources are ranked in one task, a row of
a few numbers each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.text import packed, unpacked, word_count
from isobar.staging import stage


@dataclass(frozen=True)
class Mix:
    """share: words of the mix over words of the input.  most: passes over a source at most.

    weights repeat along the sources in code point order, NULL last.
    """

    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    block_words: int = 8
    shard_words: int = 32_768
    shards: int = 8192
    seed: str = "mix"


#: Rows of a source or shard table that may be broadcast.
BROADCAST_ROWS = 50_000


def small(written: DataFrame) -> DataFrame:
    """A staged table with a broadcast hint if it is counted to be small."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def targets(sizes: DataFrame, spec: Mix) -> DataFrame:
    """``(source, source_size)`` with ``target``: min(most * size, weight * level) with the level that fills the share.

    In the order of most * size / weight the stopped sources come first, and
    the level after taking out the first i sources is largest where they end.
    """
    every = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in spec.weights]), (F.col("at") % len(spec.weights) + 1).cast("int"))
    before = Window.orderBy("ratio", "at").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", weight)
        .withColumn("ceiling", F.col("source_size") * F.lit(float(spec.most)))
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
    )
    left = F.sum("source_size").over(every) * F.lit(float(spec.share)) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max("level").over(every)
    return ranked.withColumn("level", left / rest).select(
        "source", "source_size", F.least(F.col("ceiling"), F.col("weight") * level).alias("target")
    )


def apportion(items: DataFrame, group: list[str], key: list[str], weight: str, seats: str, name: str) -> DataFrame:
    """``items`` with ``name``: the group's ``seats`` dealt by highest quotient weight / (2 k + 1); ties by ``key``.

    Rounding seats * weight / total gives every item its seats down to one
    quotient; the sum is off by at most half the items, and no item can need
    more than its share of that plus two of the next quotients.
    """
    whole = Window.partitionBy(*group)
    quotient = F.col(weight) / (2 * F.col("k") + 1)
    ties = [F.col(c).asc_nulls_last() for c in key]
    ideal = F.col(seats) * F.col(weight) / F.sum(weight).over(whole)
    rounded = items.withColumn("base", F.when(F.col(weight) > 0, F.floor(ideal + 0.5)).otherwise(F.lit(0)).cast("long"))
    rounded = rounded.withColumn("off", F.col(seats) - F.sum("base").over(whole))
    reach = F.ceil(F.col(weight) / F.sum(weight).over(whole) * (F.abs("off") + F.count(F.lit(1)).over(whole))) + 2
    rounded = rounded.withColumn("reach", F.when((F.col("off") != 0) & (F.col(weight) > 0), reach).otherwise(F.lit(0)).cast("int"))
    steps = rounded.withColumn("step", F.explode_outer(F.when(F.col("reach") > 0, F.sequence(F.lit(1), F.col("reach")))))
    steps = steps.withColumn("k", F.when(F.col("off") > 0, F.col("base") + F.col("step") - 1).otherwise(F.col("base") - F.col("step")))
    usable = F.col("step").isNotNull() & (F.col("k") >= 0)
    # Highest first when seats are missing, lowest first when there are too many.
    sign = F.signum(F.col("off").cast("double"))
    order = Window.partitionBy(*group).orderBy(F.when(usable, 0).otherwise(1), (-sign * quotient).asc_nulls_last(), *ties, "k")
    chosen = steps.withColumn("moved", F.when(usable & (F.row_number().over(order) <= F.abs("off")), F.signum("off")).otherwise(0))
    keep = [c for c in items.columns]
    return (
        chosen.groupBy(*keep, "base")
        .agg(F.sum("moved").cast("long").alias("moves"))
        .select(*keep, (F.col("base") + F.col("moves")).alias(name))
    )


def digest(*parts: Column) -> Column:
    """Hex MD5 of the parts joined by colons; NULL counts as the word null."""
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def number(hexed: Column) -> Column:
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("long")


def shards_of(docs: DataFrame, spec: Mix, *, text: str, source: str, key: str, kept: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """The rows with their shard, and one row per shard: sizes, target, quota and first word."""
    rows = packed(
        docs,
        kept,
        doc=F.col(f"`{key}`"),
        source=F.col(f"`{source}`"),
        size=word_count(F.col(f"`{text}`")),
        print=F.xxhash64(F.col(f"`{text}`")),
    ).withColumn("hash", digest(F.lit(spec.seed), F.col("doc")))
    if kept is not None and text not in kept:
        rows = stage(rows, "sizes")  # small rows: read again instead of the texts
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = F.sum("source_size").over(Window.partitionBy())
    planned = targets(sizes, spec)
    per_shard = F.greatest(F.lit(spec.shard_words), F.ceil(total / spec.shards))
    planned = planned.withColumn("shard_count", F.greatest(F.lit(1), F.ceil(F.col("source_size") / per_shard)).cast("long"))
    blocks = F.floor(F.sum("target").over(Window.partitionBy()) / spec.block_words + 0.5).cast("long")
    planned = apportion(planned.withColumn("blocks", blocks), [], ["source"], "target", "blocks", "source_blocks").drop("blocks")
    planned = stage(planned, "sources")
    placed = rows.join(small(planned.select(F.col("source").alias("s"), "shard_count")), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    placed = placed.withColumn("shard", number(F.col("hash")) % F.col("shard_count")).drop("shard_count")
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.join(planned.select(F.col("source").alias("s"), "source_size", "target", "source_blocks"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    shards = apportion(shards, ["source"], ["shard"], "shard_size", "source_blocks", "blocks")
    held = F.floor(F.col("shard_size") / spec.block_words).cast("long")
    first = number(digest(F.lit(spec.seed), F.col("source"), F.col("shard"))) % F.greatest(held, F.lit(1))
    fits = F.floor(F.col("shard_size") * F.lit(float(spec.most)) / spec.block_words).cast("long")
    return placed, stage(shards.select(
        F.col("source").alias("s"),
        F.col("shard").alias("h"),
        "source_size",
        "target",
        "shard_size",
        (first * spec.block_words).alias("first"),
        (F.least(F.col("blocks"), fits) * spec.block_words).alias("length"),
    ), "shards")


def mixed(
    docs: DataFrame, spec: Mix = Mix(), *, text: str = "text", source: str = "source", key: str = "doc_id", kept: list[str] | None = None
) -> DataFrame:
    """Every row packed as ``row`` (its ``kept`` columns, by default all), with ``size source_size target taken`` and ``runs``, the stretches of words taken.

    ``runs`` is an array of (from, to) word positions, one per pass that takes
    something of the row.  Texts without words take no part (taken 0); NULL
    sources form one source; rows that agree in key and size are alike, so
    their order does not matter; an empty table gives no rows.  Two rows with
    one key but different texts are ordered by size, then by their texts' hash.
    """
    placed, shards = shards_of(docs, spec, text=text, source=source, key=key, kept=kept)
    rows = placed.join(
        small(shards), F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")), "left"
    )
    order = Window.partitionBy("source", "shard").orderBy("hash", F.col("doc").asc_nulls_last(), "size", "print")
    rows = rows.withColumn("at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    runs = []
    for turn in range(math.ceil(spec.most) + 1):
        begins = F.col("at") + F.lit(turn) * F.col("shard_size")
        runs.append(
            F.struct(
                (F.greatest(begins, F.col("first")) - begins).alias("from"),
                (F.least(begins + F.col("size"), F.col("first") + F.col("length")) - begins).alias("to"),
            )
        )
    rows = rows.withColumn("runs", F.filter(F.array(*runs), lambda r: r["to"] > r["from"]))
    taken = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"])
    return rows.withColumn("taken", taken).select("row", "source", "size", "source_size", "target", "taken", "runs")


def sample(docs: DataFrame, spec: Mix = Mix(), *, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per pass over a document, its text cut to the words taken.

    White space within a cut text stays; ``n_chars``, if there, follows the text.
    """
    rows = mixed(docs, spec, text=text, source=source, key=key).withColumn("run", F.explode("runs"))
    whole = F.col("row").getField(text)
    spaced = F.regexp_extract_all(whole, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    length = F.col("run.to") - F.col("run.from")
    cut = F.when(length == F.col("size"), whole).otherwise(
        F.array_join(F.slice(spaced, (F.col("run.from") + 1).cast("int"), length.cast("int")), "")
    )
    out = unpacked(rows.withColumn("cut", cut), docs, F.col("cut"))
    replaced = {text: F.col("cut")} | ({"n_chars": F.char_length("cut").cast("long")} if "n_chars" in docs.columns else {})
    return out.select(*[replaced.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
