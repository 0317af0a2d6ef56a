"""SimHash near-duplicates: fingerprints of shingles, pigeonhole blocks, Hamming distance, connected groups.

* A fingerprint has bit b set if more than half of the text's shingle hashes
  have it set.  Equal fingerprints are one row from here on.
* 64 bits are cut into ``distance`` + ``shared`` blocks.  Two fingerprints at
  ``distance`` bits or fewer agree in at least ``shared`` blocks, so each
  fingerprint is listed under every choice of ``shared`` blocks.  With 6 blocks
  and 3 shared, a key holds 32 bits: unrelated fingerprints rarely meet.
* The fingerprints of a key are linked by a breadth-first search on verified
  distances, which gives a link from each found fingerprint to the smallest one
  instead of all pairs.  A key with more than ``tile`` fingerprints is dealt
  over pairs of tiles, so no task holds more than 2 * ``tile`` of them.
* Links make connected components (``components``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.components import components
from isobar.llm.text import each, packed, text_udf, unpacked
from isobar.staging import stage

SEED = 42
HASHED_AT_ONCE = 65_536


def fingerprint_of(text: str | None, shingle: int) -> int:
    """SimHash of one text as a signed 64-bit integer; no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII blanks
    if not words:
        return 0
    if len(words) < shingle:
        words = [b" ".join(words)]
        shingle = 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    total, counts = len(words) - shingle + 1, np.zeros(64, np.int64)
    for begin in range(0, total, HASHED_AT_ONCE):
        end = min(begin + HASHED_AT_ONCE, total)
        runs = [words[begin + k : end + k] for k in range(shingle)]
        hashes = np.array([digest(join(w), SEED) for w in zip(*runs)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int) -> Column:
    """The SimHash of a text column as a long."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, shingle) for t in each(texts)], pa.int64())

    return text_udf(run, "long")(text)


def masks(distance: int, shared: int) -> list[int]:
    """One mask per choice of ``shared`` of the blocks, as signed 64-bit integers."""
    edges = np.linspace(0, 64, distance + shared + 1).round().astype(int)
    blocks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(blocks, shared)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def linked(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest one reachable among ``prints``) for all that reach another one."""
    rest = np.unique(prints)
    members, roots = [], []
    while len(rest) > 1:
        root, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count((rest ^ queue.pop()).view(np.uint64)) <= distance
            if near.any():
                found = rest[near]
                rest = rest[~near]
                queue.extend(found)
                members.append(found)
                roots.append(np.full(len(found), root))
    if not members:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(members), np.concatenate(roots)


def links(prints: DataFrame, *, distance: int = 3, shared: int = 3, tile: int = 8192) -> DataFrame:
    """``(u, v)`` with u > v, from distinct fingerprints ``fp``: enough verified links for the same components."""
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(distance, shared))])
    listed = prints.select("fp", F.inline(keys))
    heavy = listed.groupBy("choice", "key").count().filter(F.col("count") > tile)
    heavy = heavy.select("choice", "key", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    dealt = listed.join(heavy, ["choice", "key"], "left")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("tiles", F.lit(1)))
    pairs = F.transform(
        F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1),
        lambda other: F.struct(F.least(other, F.col("own")).alias("low"), F.greatest(other, F.col("own")).alias("high")),
    )
    dealt = dealt.withColumn("own", own.cast("int")).withColumn("pair", F.explode(pairs))
    groups = dealt.groupBy("choice", "key", "pair").agg(F.collect_list("fp").alias("prints")).filter(F.size("prints") > 1)

    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            flat, edges = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            found = [linked(flat[a:b], distance) for a, b in zip(edges, edges[1:])]
            if found:
                u, v = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return groups.select("prints").mapInArrow(run, "u long, v long").distinct()


def near_duplicates(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", shingle: int = 3, distance: int = 3, shared: int = 3, tile: int = 8192
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest key reachable over fingerprints that
    differ in ``distance`` bits or fewer.  NULL and blank texts have fingerprint
    zero and are linked like any other; a NULL key takes part but is never
    the smallest (a group of NULL keys only has component NULL); repeated rows
    all stay; texts are read whole; an empty table gives no rows.
    """
    printed = stage(docs.select(F.col(f"`{key}`").alias("doc_id"), fingerprints(F.col(f"`{text}`"), shingle).alias("fp")), "simhash")
    prints = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    labels = components(links(prints.select("fp"), distance=distance, shared=shared, tile=tile))
    rooted = prints.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return printed.join(named, "fp").select("doc_id", "fp", "component_id")


def hexed(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, *, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest key.

    Rows that repeat that key: the first in the order of their text's hash.
    Rows without key stay only if their group has no key at all, one per fingerprint.
    """
    found = near_duplicates(docs, text=text, key=key, **how)
    rows = packed(docs, id=F.col(f"`{key}`"), hash=F.xxhash64(F.col(f"`{text}`")))

    def first_of(many: DataFrame, by: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(by).orderBy("hash"))
        return many.withColumn("nth", nth).filter("nth = 1").select("row")

    def listed(ids: DataFrame) -> DataFrame:
        # One plan at every size: the keys that stay grow with the table, so they are never broadcast.
        return rows.join(ids.hint("merge"), F.col("id") == F.col("doc_id"), "left_semi")

    stay = stage(found.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "stay")
    kept = listed(stay.filter("n = 1")).select("row")
    # Keys that stand on several rows and rows without one are rare; they cost a pass only where they are.
    if not (twice := stay.filter("n > 1")).isEmpty():
        kept = kept.unionByName(first_of(listed(twice), "id"))
    keyless = found.filter(F.col("component_id").isNull()).select(hexed(F.col("fp")).alias("fp_hex")).distinct()
    if not keyless.isEmpty():
        nameless = rows.filter(F.col("id").isNull()).withColumn("print", hexed(fingerprints(F.col("row").getField(text), how.get("shingle", 3))))
        kept = kept.unionByName(first_of(nameless.join(keyless, F.col("print") == F.col("fp_hex"), "left_semi"), "print"))
    return unpacked(kept, docs)
