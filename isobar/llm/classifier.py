"""Quality scores: document statistics, random Fourier features, ridge by summed normal equations, isotonic calibration.

* ``statistics`` turns a text into shares and logarithms: kinds of characters,
  word lengths, repetition of words, neighbours, windows and lines.
* cos(W x + b) with Gaussian W stands for a Gaussian kernel on the standardised
  statistics; the draws follow a fixed seed.
* The normal equations Z'Z and Z'y are summed per partition with numpy, then
  by Spark per matrix row; the driver solves ``features`` unknowns.
* Pool-adjacent-violators on the training scores maps the ridge output to the
  share of label 1, linear between blocks.

Fitting takes at most ``fit_rows`` labelled documents, those whose key has the
smallest hash; rows that share a key share one weight; all other work covers
every row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.text import each, packed, text_udf
from isobar.staging import discard, stage

# Byte classes: 0 other ASCII, 1 blank, 2 digit, 3 upper, 4 lower, 5 sentence marks, 6 loud marks, 7 symbols, 8 first byte of a longer character, 9 its other bytes.
CLASSES = np.zeros(256, np.uint8)
for _mark, _bytes in {1: b" \t\n\x0b\x0c\r", 2: b"0123456789", 5: b".,;:'\"()-", 6: b"!?", 7: b"#*$%&|<>{}[]\\/=+_~^@`"}.items():
    CLASSES[list(_bytes)] = _mark
CLASSES[65:91], CLASSES[97:123], CLASSES[0xC0:], CLASSES[0x80:0xC0] = 3, 4, 8, 9

STATISTICS = 24


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one text; blank and NULL texts give zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(STATISTICS)
    kinds = np.bincount(CLASSES[np.frombuffer(raw, np.uint8)], minlength=10)
    n = len(words)
    chars = max(1, int(kinds[:9].sum() - kinds[1]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = len(set(words))
    pairs, windows = max(1, n - 1), max(1, n - 2)
    return np.array(
        [
            1.0,
            np.log1p(n),
            np.log1p(n / len(lines)),
            lengths.mean() / 10,
            np.log1p(lengths.std()),
            np.log1p(lengths.max()),
            kinds[2] / chars,
            kinds[3] / chars,
            kinds[4] / chars,
            kinds[5] / chars,
            kinds[6] / chars,
            kinds[7] / chars,
            kinds[8] / chars,
            kinds[0] / chars,
            kinds[7] / n,
            kinds[6] / n,
            distinct / n,
            np.log(distinct) / np.log1p(n),
            sum(map(eq, words, words[1:])) / pairs,
            len(set(zip(words, words[1:]))) / pairs,
            len(set(zip(words, words[1:], words[2:]))) / windows if n > 2 else 1.0,
            len(set(lines)) / len(lines),
            float(np.mean(lengths == 1)),
            kinds[3] / n,
        ]
    )


def table(texts: Iterable[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(-1, STATISTICS)


@dataclass(frozen=True)
class Kernel:
    """features: length of the random map.  width: of the Gaussian kernel.  ridge: penalty per training row."""

    features: int = 384
    width: float = 4.0
    ridge: float = 1e-4
    seed: int = 20
    fit_rows: int = 20_000

    def draws(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        return rng.normal(0, 1 / self.width, (STATISTICS, self.features)), rng.uniform(0, 2 * np.pi, self.features)


@dataclass(frozen=True)
class Model:
    """Everything a score needs; a few KB whatever the data."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    knots: np.ndarray
    levels: np.ndarray
    kernel: Kernel

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return lifted(stats, self.mean, self.scale, self.kernel) @ self.weights + self.bias

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.levels)


def lifted(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray, kernel: Kernel) -> np.ndarray:
    w, b = kernel.draws()
    return np.sqrt(2 / kernel.features) * np.cos((stats - mean) / scale @ w + b)


#: Different texts of one key that are fitted on at most.
TEXTS_PER_KEY = 16


def isotonic(x: np.ndarray, y: np.ndarray, share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares levels of y (weighted by ``share``) along x, as knots for interpolation; equal x are one point."""
    points, inverse = np.unique(x, return_inverse=True)
    share = np.ones(len(y)) if share is None else share
    weight = np.bincount(inverse, share)
    mean = np.bincount(inverse, share * y) / weight
    blocks: list[list[float]] = []  # mean, weight, first x, last x
    for p, m, w in zip(points, mean, weight):
        blocks.append([m, w, p, p])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _, last = blocks.pop()
            m1, w1, first, _ = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, first, last])
    knots = np.array([k for b in blocks for k in ([b[2], b[3]] if b[3] > b[2] else [b[2]])])
    levels = np.array([v for b in blocks for v in ([b[0]] * 2 if b[3] > b[2] else [b[0]])])
    return knots, levels


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Mean and spread of the statistics, mean label and count of keys, summed per partition."""

    def run(batches):
        total = np.zeros(2 * STATISTICS + 2)
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            share = batch.column("share").to_numpy(zero_copy_only=False)
            weighted = x * share[:, None]
            total += np.concatenate((weighted.sum(0), (weighted * x).sum(0), [(share * y).sum(), share.sum()]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "part"])

    sums = rows.mapInArrow(run, "at long, part double").groupBy("at").agg(F.sum("part").alias("part")).orderBy("at").collect()
    values = np.array([r.part for r in sums]) if sums else np.zeros(2 * STATISTICS + 2)
    n = round(values[-1])
    if not n:
        return np.zeros(STATISTICS), np.ones(STATISTICS), 0.0, 0
    mean = values[:STATISTICS] / n
    spread = np.sqrt(np.maximum(values[STATISTICS:-2] / n - mean * mean, 0))
    return mean, np.where(spread > 1e-9, spread, 1.0), values[-2] / n, n


def _normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, bias: float, kernel: Kernel) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'(y - bias): one row per matrix row and partition, summed by Spark."""
    size = kernel.features

    def run(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            z = lifted(x, mean, scale, kernel)
            weighted = (z * batch.column("share").to_numpy(zero_copy_only=False)[:, None]).T
            total += np.column_stack((weighted @ z, weighted @ (y - bias)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(list(total), pa.list_(pa.float64()))], ["at", "part"])

    def add(batches):
        total = {}
        for batch in batches:
            for at, part in zip(batch.column("at").to_pylist(), batch.column("part").to_numpy(zero_copy_only=False)):
                total[at] = total.get(at, 0) + part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["at", "part"])

    parts = rows.mapInArrow(run, "at long, part array<double>").repartition(8, "at").mapInArrow(add, "at long, part array<double>")
    whole = np.array([r.part for r in parts.orderBy("at").collect()])
    return whole[:, :-1], whole[:, -1]


def fit(docs: DataFrame, labels: DataFrame, kernel: Kernel = Kernel(), *, text: str = "text", key: str = "doc_id") -> Model | None:
    """Fit on the rows of ``docs`` that ``labels`` (``doc_id``, ``y`` in 0..1) marks; None without any such row.

    A document labelled more than once counts with its mean label; NULL labels
    and keys are left out.  A key weighs the same however many rows carry it:
    equal texts count once, different ones share its weight, ``TEXTS_PER_KEY``
    of them at most.
    """
    chosen = labels.filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.avg("y").cast("double").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(kernel.fit_rows)

    def measure(texts: pa.Array) -> pa.Array:
        return pa.array(list(table(each(texts))), pa.list_(pa.float64()))

    rows = packed(docs, id=F.col(f"`{key}`"), body=F.col(f"`{text}`")).drop("row")
    rows = rows.join(F.broadcast(chosen), F.col("id") == F.col("doc_id"))  # fit_rows rows of 16 bytes at most
    # Repeated rows are dropped before the shuffle; a slot of a key keeps the text of smallest hash.
    body = F.coalesce("body", F.lit(""))
    placed = rows.select("id", "y", body.alias("body"), F.xxhash64(body).alias("hash"))
    rows = placed.groupBy("id", "y", F.pmod("hash", F.lit(TEXTS_PER_KEY)).alias("slot")).agg(F.min(F.struct("hash", "body"))["body"].alias("body"))
    share = 1 / F.count(F.lit(1)).over(Window.partitionBy("id"))  # TEXTS_PER_KEY rows at most
    rows = rows.select("id", "y", share.alias("share"), text_udf(measure, "array<double>")("body").alias("stats"))
    # One order of summing whatever the partitions were.
    rows = stage(rows.repartition(4, "id").sortWithinPartitions("id", "stats"), "fit")
    mean, scale, bias, n = _moments(rows)
    if not n:
        discard(rows)
        return None
    gram, moment = _normal_equations(rows, mean, scale, bias, kernel)
    weights = np.linalg.solve(gram + kernel.ridge * n * np.eye(len(gram)), moment)
    trained = Model(mean, scale, weights, bias, np.zeros(1), np.zeros(1), kernel)
    # At most fit_rows x TEXTS_PER_KEY rows of numbers.
    pairs = rows.select("stats", "y", "share").toArrow()
    discard(rows)
    stats = pairs.column("stats").combine_chunks().flatten().to_numpy().reshape(-1, STATISTICS)
    knots, levels = isotonic(np.round(trained.raw(stats), 9), pairs.column("y").to_numpy(), pairs.column("share").to_numpy())
    return Model(mean, scale, weights, bias, knots, levels, kernel)


def score(model: Model | None, text: Column) -> Column:
    """Score of a text in 0..1; without a model (no labelled row) every score is 1, so nothing is rejected unseen."""
    if model is None:
        return F.lit(1.0)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.clip(model.score(table(each(texts))), 0, 1) if len(texts) else [], pa.float64())

    return text_udf(run, "double")(text)


def held_out(key: Column) -> Column:
    """Whether a document is kept for testing: crc32 of the key as text, modulo 4, is 2; a NULL key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame, kernel: Kernel = Kernel(), *, text: str = "text", key: str = "doc_id") -> Model | None:
    """The model of ``labels.quality``, fitted on rows that are not held out."""
    marked = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("double").alias("y"))
    return fit(docs, marked, kernel, text=text, key=key)
