"""Centroid clustering of integer vectors; the nearest centroid by a tournament of bisectors.

Which of two centroids a and b is nearer to x is the side of their bisector x
lies on: the sign of 2 x.(b - a) - (|b|^2 - |a|^2).  Normals b - a and thresholds
are integers, made once per round for all pairs.  A vector starts with centroid
0 as the winner and meets the others in order of their number, so k - 1 linear
tests leave one; the sign zero is a tie, which the smaller number wins.  The
distance is then computed once, to the winner, exactly.

Tasks keep a sum and a count per centroid and hand on at most k rows each; the
driver sees k rows of sums a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.staging import stage

#: Vectors met by a tournament together.
AT_ONCE = 4096


@dataclass(frozen=True)
class Clustering:
    """count: centroids.  rounds: assignments followed by new centroids.  size: components of a vector.  scale: of the integer grid.  seed: of the first centroids."""

    count: int = 16
    rounds: int = 3
    size: int = 64
    scale: int = 64
    seed: int = 1


class Bisectors:
    """Integer normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        # Half of 64 bits for every product and sum; wider numbers go through Python's integers.
        self.most = int(np.abs(centroids).max(initial=0))
        self.normals = centroids[None, :, :] - centroids[:, None, :]  # [a, b] points from a to b
        squares = (centroids.astype(object) ** 2).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def _kind(self, x: np.ndarray) -> type:
        most = max(self.most, int(np.abs(x).max(initial=0)))
        reach = 8 * most * most * x.shape[1]  # of a doubled product, a threshold and a squared distance
        return np.float64 if reach < 1 << 53 else np.int64 if reach < 1 << 62 else object  # floating point is exact up to there

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row, the smaller number among equals."""
        kind = self._kind(x)
        points, doubled = x.astype(kind), 2 * self.normals.astype(kind)
        thresholds = self.thresholds.astype(kind)
        best = np.zeros(len(x), np.int64)
        for b in range(1, len(self.centroids)):
            if kind is object:
                side = (points * doubled[best, b]).sum(axis=1)
            else:
                side = np.einsum("ij,ij->i", points, doubled[best, b])
            best[side > thresholds[best, b]] = b
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        kind = self._kind(x)
        apart = x.astype(object if kind is object else np.int64) - self.centroids[best]
        return (apart * apart).sum(axis=1)


def _points(batch: pa.RecordBatch, how: Clustering) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their integer components) of the list column ``x``."""
    lists = batch.column("x")
    right = pc.equal(pc.fill_null(pc.list_value_length(lists), -1), how.size)
    rows = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    flat = lists.take(pa.array(rows)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), how.size)  # NULL becomes NaN
    whole = np.isfinite(values).all(axis=1) if len(rows) else np.empty(0, bool)
    grid = np.floor(values[whole] * how.scale)
    if (np.abs(grid) >= 1 << 62).any():
        raise OverflowError("components times the scale must fit 62 bits")
    return rows[whole], grid.astype(np.int64)


def _parts(batches, how: Clustering) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        rows, x = _points(batch, how)
        for at in range(0, len(rows), AT_ONCE):
            yield batch.column("id").take(pa.array(rows[at : at + AT_ONCE])), x[at : at + AT_ONCE]


def _vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    return vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("x"))


def first_centroids(vectors: DataFrame, how: Clustering, *, key: str, vector: str) -> np.ndarray:
    """The ``how.count`` vectors whose key has the smallest hash, NULL keys last; equal hashes in the order of their components."""
    x = F.col("x")
    fits = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != F.lit(float("inf"))))
    kept = _vectors(vectors, key, vector).filter((F.size("x") == how.size) & fits)
    grid = F.transform(x, lambda v: F.floor(v.cast("double") * how.scale).cast("long"))
    order = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("id").cast("string")), 256)
    rows = kept.select(order.alias("at"), grid.alias("grid")).orderBy(F.col("at").asc_nulls_last(), "grid").limit(how.count).collect()
    return np.array([r.grid for r in rows], np.int64).reshape(len(rows), how.size)


def moved(vectors: DataFrame, centroids: np.ndarray, how: Clustering, *, key: str, vector: str) -> np.ndarray:
    """The floor of each centroid's mean after one assignment; one without vectors stays."""
    count, size = centroids.shape

    def run(batches):
        bisectors = Bisectors(centroids)
        sums, counts = np.zeros((count, size), object), np.zeros(count, np.int64)
        for _, x in _parts(batches, how):
            best = bisectors.winners(x)
            for c in np.unique(best):
                mine = x[best == c]
                sums[c] += mine.sum(axis=0, dtype=np.int64 if np.abs(mine).max() < 1 << 48 else object)
                counts[c] += len(mine)
        for c in np.flatnonzero(counts):
            yield pa.RecordBatch.from_pydict(
                {"cluster": [int(c)] * size, "place": list(range(size)), "total": [str(v) for v in sums[c]], "n": [int(counts[c])] * size},
                pa.schema([("cluster", pa.int32()), ("place", pa.int32()), ("total", pa.string()), ("n", pa.int64())]),
            )

    parts = _vectors(vectors, key, vector).mapInArrow(run, "cluster int, place int, total string, n long")
    totals = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for row in totals.collect():  # count x size numbers
        out[row.cluster, row.place] = int(row.total) // row.n
    return out


def fit(vectors: DataFrame, how: Clustering = Clustering(), *, key: str = "vec_id", vector: str = "embedding") -> np.ndarray:
    """Centroids (integers, one a row) after ``how.rounds`` rounds; fewer if fewer vectors take part, none for an empty table."""
    centroids = first_centroids(vectors, how, key=key, vector=vector)
    for _ in range(how.rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids, how, key=key, vector=vector)
    return centroids


def assigned(vectors: DataFrame, centroids: np.ndarray, how: Clustering = Clustering(), *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, cluster, distance)`` of every vector that takes part: the nearest centroid and the squared distance to it."""

    def run(batches):
        bisectors = Bisectors(centroids)
        for ids, x in _parts(batches, how):
            best = bisectors.winners(x)
            away = bisectors.distances(x, best)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(away.tolist(), pa.int64())], ["id", "cluster", "distance"])

    rows = _vectors(vectors, key, vector)
    return (rows if len(centroids) else rows.limit(0)).mapInArrow(run, "id long, cluster int, distance long")


def written(centroids: np.ndarray) -> list[str]:
    """A digest of each centroid's components as decimal integers."""
    return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]


def clusters(vectors: DataFrame, how: Clustering = Clustering(), *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, a row for every vector that takes part.

    Vectors with exactly ``how.size`` components, none NULL or non-finite, take
    part, each component x as floor(scale * x); a NULL key does too, but starts a
    centroid only if there are too few others.  Rows that repeat a key are vectors
    of their own.  Sums of squared distances must fit 64 bits.  An empty table
    gives no rows.  Columns other than the two named ones are not read.
    """
    centroids = fit(vectors, how, key=key, vector=vector)
    rows = stage(assigned(vectors, centroids, how, key=key, vector=vector), "assigned")
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row for each centroid
    digests = written(centroids)
    facts = rows.sparkSession.createDataFrame(
        [(r.cluster, r.cluster_inertia, sum(s.cluster_inertia for s in sums), digests[r.cluster]) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    joined = rows.join(F.broadcast(facts), "cluster")
    return joined.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
