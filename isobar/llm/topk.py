"""Exact top-k by inner product, reading sorted lists from the top (no random access).

Candidates are dealt into blocks.  In a block every dimension is a list of its
values in order.  A query reads all lists together from the end that helps it
most, some places at a time.  A value not read yet lies between the list's
place reached so far and its far end, so a candidate's score has an upper and a
lower bound.  Reading stops when no more than ``few`` candidates reach the k-th
best lower bound with their upper one; those are resolved to final scores.
Between rounds a query keeps the best k-th lower bound it has seen, and
candidates that no waiting query can still want are read no further.  Bounds of
many queries and the candidates left are two matrix products.

A block gives at most k rows per query, and the blocks' results are merged by
score.  Queries travel in blocks of tens of thousands, so a candidate travels
few times, and every pair of blocks is a group of its own, dealt over as many
tasks.  Equal rows travel as one with their number; more than k of them can't
rank.  Scores are integers: floor(scale * x) of each component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.text import packed
from isobar.staging import stage


#: Bounds of so many queries against a block are held together.
QUERIES_AT_ONCE = 128


class Lists:
    """The sorted lists of one block: ``x`` is candidates x dimensions, integers."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.sorted = np.sort(x, axis=0)

    def depths(self) -> list[int]:
        """Places read after each round: first a sixteenth and a quarter, then each round half of what is left, the last one all."""
        n, out = len(self.x), []
        left = n
        while left > max(1, n // 64):
            left //= 2
            out.append(n - left)
        early = [d for d in (n // 16, n // 4) if d]
        return early + out[:-1] + [n] if out else [n]

    def bounds(self, weights: np.ndarray, depth: int, kind: type, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds (queries x ``live`` candidates) after reading ``depth`` places of every list.

        A list is read from its top for a positive weight, from its bottom for
        a negative one.  What was read counts as it is; for the rest the place
        reached bounds the value on one side and the far end on the other.
        """
        x, n = self.x[live], len(self.x)
        top, bottom = self.sorted[n - depth], self.sorted[depth - 1]
        plus, minus = np.maximum(weights, 0).astype(kind), np.minimum(weights, 0).astype(kind)
        above = np.maximum(x, top).astype(kind), np.minimum(x, bottom).astype(kind)
        below = np.where(x >= top, x, self.sorted[0]).astype(kind), np.where(x <= bottom, x, self.sorted[-1]).astype(kind)
        return plus @ above[0].T + minus @ above[1].T, plus @ below[0].T + minus @ below[1].T

    def best(self, query_ids: np.ndarray, weights: np.ndarray, k: int, few: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query ids, candidate ids, scores) of the k best for each query, smaller id first among equals."""
        n, out = len(self.x), []
        largest = int(np.abs(self.x).max(initial=0)) * int(np.abs(weights).max(initial=0)) * self.x.shape[1]
        kind = np.float64 if largest < 1 << 53 else np.int64  # floating point is exact up to there
        least = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
        waiting, live, floors = np.arange(len(query_ids)), np.arange(n), np.full(len(query_ids), least, kind)
        for depth in [n] if n <= max(few, k) else self.depths():
            upper, lower = self.bounds(weights[waiting], depth, kind, live)
            own = query_ids[waiting][:, None] == self.ids[live][None, :]
            lower[own] = least
            if len(live) > k:
                floors[waiting] = np.maximum(floors[waiting], np.partition(lower, len(live) - k, axis=1)[:, len(live) - k])
            alive = (upper >= floors[waiting][:, None]) & ~own
            ready = (alive.sum(1) <= max(few, k)) | (depth == n)
            for q in np.flatnonzero(ready):
                at = live[alive[q]]
                scores = self.x[at] @ weights[waiting[q]]
                first = np.lexsort((self.ids[at], -scores))[:k]
                out.append((np.full(len(first), query_ids[waiting[q]]), self.ids[at[first]], scores[first]))
            # What brought a floor about reaches it, so it stays among the living.
            waiting, live = waiting[~ready], live[alive[~ready].any(axis=0)]
            if not len(waiting):
                break
        return out


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not NULL or empty, no NULL, NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


#: Partitions that pairs of blocks are dealt over at most.
MOST_TASKS = 20_000


def nearest(
    vectors: DataFrame, queries: Column, *, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding", block: int = 8192, query_block: int = 16384, few: int = 64
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that ``queries`` marks its k best other rows.

    All, if there are fewer; ties go to the smaller key.  Rows whose key is
    NULL or whose vector is NULL, empty or holds a NULL or non-finite component
    take no part.  Vectors of other lengths than the query's are no candidates.
    Rows with the query's key are not candidates either; other repeated rows
    are separate candidates.  A repeated query key asks with the smallest of its vectors
    of a length (component by component) and gives those rows once.  Scores must fit 64 bits.
    An empty table gives no rows.
    """
    whole = packed(vectors, id=F.col(f"`{key}`").cast("long"), raw=F.col(f"`{vector}`"), asked=F.coalesce(queries, F.lit(False))).drop("row")
    whole = whole.filter(usable(F.col("raw")) & F.col("id").isNotNull())
    whole = whole.select("id", "asked", F.transform("raw", lambda x: F.floor(x.cast("double") * scale)).alias("x"), F.size("raw").alias("size"))
    counted = whole.groupBy("size", "id", "x").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"), F.bool_or("asked").alias("asked"))
    points = stage(counted, "points")
    # How many blocks each length needs: a row per length.
    lengths = points.groupBy("size").agg(
        F.ceil(F.sum("copies") / block).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.count_if("asked") / query_block), F.lit(1)).cast("int").alias("query_blocks"),
    )
    pairs = lengths.agg(F.sum(F.col("blocks").cast("long") * F.col("query_blocks"))).first()[0] or 1
    sized = points.join(lengths, "size")
    spread = F.xxhash64("id", "x")
    candidates = sized.select(
        "size",
        F.pmod(spread, F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"),
        "id",
        "x",
        "copies",
    )
    single = sized.filter("asked").groupBy("size", "id", "blocks", "query_blocks").agg(F.min("x").alias("x"))
    asked = single.select(
        "size",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(spread, F.col("query_blocks")).cast("int").alias("query_block"),
        "id",
        "x",
        F.lit(0).alias("copies"),
    )

    def run(table: pa.Table) -> pa.Table:
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        query = copies == 0
        lists, out = Lists(np.repeat(ids, copies), np.repeat(x, copies, axis=0)), []
        asked_ids, asked_x = ids[query], x[query]
        for at in range(0, len(asked_ids) if len(lists.ids) else 0, QUERIES_AT_ONCE):
            out += lists.best(asked_ids[at : at + QUERIES_AT_ONCE], asked_x[at : at + QUERIES_AT_ONCE], k, few)
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    # A number of its own: adaptive execution would merge groups by their few bytes, whatever their work.
    dealt = candidates.unionByName(asked).repartition(int(min(2 * pairs, MOST_TASKS)), "size", "block", "query_block")
    found = dealt.groupBy("size", "block", "query_block").applyInArrow(run, "query_id long, vec_id long, score long")
    # The blocks' results: a small heap per task, then one of k rows per query.
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
