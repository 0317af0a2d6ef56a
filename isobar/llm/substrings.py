"""Removing passages of ``window`` words that occur earlier, by difference-cover anchors.

* Anchors.  Places p with p mod ``period`` in a difference cover get a hash of
  the ``window - period + 1`` words from there.  For any two places there is a
  shift below the period that puts both on the cover, so two equal windows
  share an aligned anchor; only cover places are hashed and shuffled.
* Extension.  Only windows that contain a repeated anchor are looked at again:
  each is hashed over all its words (128 bits), and every occurrence but the
  first (smallest key, then smallest start) is marked.
* Words covered by marked windows go.

A task first settles what repeats inside its own rows and sends one row per
hash, so a passage that fills the corpus sends one row per task and batch, not
one per occurrence.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.text import BLANKS, each, small_batches, text_udf
from isobar.staging import discard, stage

#: Words a task compares at once; it holds some hundred bytes for each.
WORDS_AT_ONCE = 500_000
BYTES_AT_ONCE = 250_000
#: Rows handed to Spark at once, whatever a task has compared.
ROWS_AT_ONCE = 50_000


@dataclass(frozen=True)
class Cover:
    """Matches of ``window`` words; places on ``residues`` modulo ``period`` are anchors.

    Every difference modulo ``period`` is one between two residues.
    """

    window: int = 20
    period: int = 13
    residues: tuple[int, ...] = (0, 1, 3, 9)

    def __post_init__(self):
        differences = {(a - b) % self.period for a in self.residues for b in self.residues}
        if len(differences) != self.period or self.window < self.period:
            raise ValueError("residues must cover every difference, and the window must hold a period")

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1

    def places(self, count: int) -> np.ndarray:
        """Anchor places in a text of ``count`` words."""
        if count < self.window:
            return np.empty(0, np.int64)
        at = np.arange(count - self.anchor + 1)
        return at[np.isin(at % self.period, self.residues)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Powers:
    """Powers of a random odd number modulo 2**64 and of its inverse, for hashes of stretches by running sums."""

    def __init__(self, seed: int):
        self.base = int(np.random.default_rng(seed).integers(1 << 62, 1 << 63)) * 2 + 1
        self.up = self.down = np.ones(1, np.uint64)

    def hashes(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of ``values[begin:end]`` for each pair; equal stretches hash alike wherever they lie."""
        if len(self.up) < len(values) + 1:
            size = max(len(values) + 1, 1 << 16)
            for name, factor in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                setattr(self, name, np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, factor, np.uint64)))))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)])))
        return _mixed((sums[end] - sums[begin]) * self.down[begin])


class Hasher:
    """64-bit hashes of words, and of stretches of them."""

    def __init__(self):
        self.letters = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.blank = np.isin(np.arange(256), list(BLANKS.encode()))
        self.powers = {seed: Powers(seed) for seed in range(4)}

    def words(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Word hashes of each text; ``data`` holds the bytes of all, text k from ``offsets[k]`` to ``offsets[k + 1]``."""
        out: list[np.ndarray] = []
        k, count = 0, len(offsets) - 1
        while k < count:
            last = max(k + 1, int(np.searchsorted(offsets, offsets[k] + BYTES_AT_ONCE, "right")) - 1)
            out += self._some(data[offsets[k] : offsets[last]], offsets[k : last + 1] - offsets[k])
            k = last
        return out

    def _some(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        solid = ~self.blank[data]
        edge = np.zeros(len(data) + 1, bool)  # a text begins or ends before this byte
        edge[offsets] = True
        before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
        after = np.concatenate((solid[1:], [False])) & ~edge[1:]
        begin, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
        hashes = self.powers[0].hashes(self.letters[data], begin, end)
        return np.split(hashes, np.searchsorted(begin, offsets[1:-1]))

    def runs(self, words: np.ndarray, places: np.ndarray, length: int, seed: int) -> np.ndarray:
        """A hash of ``length`` words from each place."""
        return self.powers[seed].hashes(words, places, places + length)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each value begins, without making Python strings."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, edges, data = column.buffers()
    offsets = np.frombuffer(edges, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same for compressed texts."""
    texts = [zstandard.decompress(x) for x in each(column)]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def _spans_of(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(begins, ends) of each value of an array<struct<begin, end>> column; NULL has none."""
    flat, sizes = column.flatten(), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    cuts = np.cumsum(sizes)[:-1]
    begin, end = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    return list(zip(np.split(begin, cuts), np.split(end, cuts))) if len(sizes) else []


def _documents(batches, hasher: Hasher, read):
    """Lists of (th, id, word hashes, spans) in document order, one of each text, of about ``WORDS_AT_ONCE`` words."""
    held, size = [], 0
    for batch in batches:
        words = hasher.words(*read(batch.column("body"))) if batch.num_rows else []
        spans = _spans_of(batch.column("spans")) if "spans" in batch.schema.names else [None] * batch.num_rows
        for row in zip(batch.column("th").to_pylist(), batch.column("id").to_pylist(), words, spans):
            held.append(row)
            size += len(row[2])
            if size >= WORDS_AT_ONCE:
                yield _distinct(held)
                held, size = [], 0
    if held:
        yield _distinct(held)


def _firsts(low: np.ndarray, high: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Whether a row is the first with its key, and, of those, which have another row."""
    _, index, inverse, counts = np.unique(low, return_index=True, return_inverse=True, return_counts=True)
    if high is not None and len(low) and (high != high[index][inverse]).any():  # two windows with one half in common
        whole = np.rec.fromarrays((low, high))
        _, index, counts = np.unique(whole, return_index=True, return_counts=True)
    first, again = np.zeros(len(low), bool), np.zeros(len(low), bool)
    first[index], again[index] = True, counts > 1
    return first, again[first]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _distinct(rows: list[tuple]) -> list[tuple]:
    """Rows (th, id, ...) in document order, one of each text hash."""
    return sorted({r[0]: r for r in rows}.values(), key=lambda r: (r[1] is None, r[1] or 0, r[0]))


def _ranges(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of consecutive ``at`` within a document."""
    opens = np.ones(len(at), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(opens)
    return first, np.append(first[1:], len(at)) - 1 if len(at) else first


def _spread(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keys for rows that need no comparison, so that they do not meet in one task."""
    return _mixed(at.astype(np.uint64) + (doc.astype(np.uint64) << np.uint64(32)))


def _taken(values: list, at: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.Array:
    return pa.array(values, kind).take(pa.array(at))


def _slices(batch: pa.RecordBatch):
    """The rows of a batch in small ones, so that neither side of the pipe holds all of them once more."""
    for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(begin, ROWS_AT_ONCE)


def _anchor_rows(docs: list[tuple], hasher: Hasher, cover: Cover) -> pa.RecordBatch:
    hashes = [hasher.runs(words, cover.places(len(words)), cover.anchor, 1) for _, _, words, _ in docs]
    counts = [len(h) for h in hashes]
    key, doc = np.concatenate(hashes), np.repeat(np.arange(len(docs)), counts)
    number = np.concatenate([np.arange(c) for c in counts])
    first, twice = _firsts(key)
    again = np.flatnonzero(~first)
    low, high = _ranges(doc[again], number[again])
    owner = np.concatenate((doc[first], doc[again][low]))
    begin = np.concatenate((number[first], number[again][low]))
    end = np.concatenate((number[first], number[again][high]))
    sure = np.concatenate((twice, np.ones(len(low), bool)))
    keys = np.concatenate((key[first], _spread(doc[again][low], number[again][low])))
    return pa.RecordBatch.from_arrays(
        [_signed(keys), _taken([d[0] for d in docs], owner, pa.binary()), pa.array(begin * 2 + sure, pa.int64()), pa.array(end - begin, pa.int32())],
        ["key", "th", "begin", "more"],
    )


def anchor_batches(batches, cover: Cover):
    """Rows (key, th, begin, more) of one task, in small batches: its anchors by hash and the runs that repeat within it."""
    hasher = Hasher()
    for docs in _documents(batches, hasher, _bytes_of):
        yield from _slices(_anchor_rows(docs, hasher, cover))


def repeated_anchors(rows: DataFrame, cover: Cover) -> DataFrame:
    """``(th, spans)``: per text the runs (first, last) of anchors, by number, that occur elsewhere too."""

    def run(batches):
        return anchor_batches(batches, cover)

    found = rows.mapInArrow(run, "key long, th binary, begin long, more int")
    same = Window.partitionBy("key")
    met = F.min("th").over(same) != F.max("th").over(same)
    found = found.withColumn("met", met).filter((F.col("begin") % 2 == 1) | F.col("met"))
    begin = F.shiftright("begin", 1).cast("int")
    # A set: a text that many chunks hold names its anchors once, not once for each of them.
    return found.groupBy("th").agg(F.collect_set(F.struct(begin.alias("begin"), (begin + F.col("more")).alias("end"))).alias("spans"))


def _covered(count: int, begin: np.ndarray, end: np.ndarray, *, back: int = 0, reach: int = 0) -> np.ndarray:
    """Which of ``count`` places lie in [begin - back, end + reach] of a pair."""
    edges = np.bincount(np.clip(begin - back, 0, count), minlength=count + 1) - np.bincount(np.clip(end + reach + 1, 0, count), minlength=count + 1)
    return np.cumsum(edges[:-1]) > 0


def _windows(count: int, begin: np.ndarray, end: np.ndarray, cover: Cover) -> np.ndarray:
    """Starts of windows of a text of ``count`` words that hold a whole anchor of the spans (anchors by number)."""
    places = cover.places(count)
    chosen = places[_covered(len(places), begin, end)]
    return np.flatnonzero(_covered(max(0, count - cover.window + 1), chosen, chosen, back=cover.period - 1))


def _window_rows(docs: list[tuple], hasher: Hasher, cover: Cover) -> pa.RecordBatch:
    begins = [_windows(len(words), *spans, cover) for _, _, words, spans in docs]
    low, high = (
        np.concatenate([hasher.runs(d[2], at, cover.window, seed) for d, at in zip(docs, begins)]) for seed in (2, 3)
    )
    doc, begin = np.repeat(np.arange(len(docs)), [len(b) for b in begins]), np.concatenate(begins)
    first, _ = _firsts(low, high)
    again = np.flatnonzero(~first)  # these start earlier in the chunk already
    a, b = _ranges(doc[again], begin[again])
    owner = np.concatenate((doc[first], doc[again][a]))
    none = np.zeros(len(a), np.uint64)
    return pa.RecordBatch.from_arrays(
        [
            _signed(np.concatenate((low[first], _spread(doc[again][a], begin[again][a])))),
            _signed(np.concatenate((high[first], none)) >> np.uint64(1)),
            pa.array(np.arange(len(owner)) >= first.sum()),
            _taken([d[0] for d in docs], owner, pa.binary()),
            _taken([d[1] for d in docs], owner),
            pa.array(np.concatenate((begin[first], begin[again][a])), pa.int32()),
            pa.array(np.concatenate((begin[first], begin[again][b])), pa.int32()),
        ],
        ["key", "more", "sure", "th", "id", "begin", "end"],
    )


def window_batches(batches, cover: Cover):
    """Rows (key, more, sure, th, id, begin, end) of one task, in small batches: windows by hash and the ranges that are surely later."""
    hasher = Hasher()
    for docs in _documents(batches, hasher, _unpacked):
        yield from _slices(_window_rows(docs, hasher, cover))


def later_windows(rows: DataFrame, cover: Cover) -> DataFrame:
    """``(th, begin, end)``: ranges of starts of windows that also start earlier; from texts with their repeated anchors."""

    def run(batches):
        return window_batches(batches, cover)

    found = rows.mapInArrow(run, "key long, more long, sure boolean, th binary, id long, begin int, end int")
    # A row that stands twice in the table ties with itself and does not count as later.
    order = Window.partitionBy("key", "more", "sure").orderBy(F.col("id").asc_nulls_last(), "th", "begin")
    return found.withColumn("at", F.rank().over(order)).filter("sure or at > 1").select("th", "begin", "end")


def _shut(texts: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=3).compress
    return pa.array([pack((t or "").encode("utf-8", "surrogatepass")) for t in each(texts)], pa.binary())


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``th id body``: the text's hash (128 bits), the key and the text of every row; NULL texts are empty."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.unhex(F.md5(body)).alias("th"), F.col(f"`{key}`").cast("long").alias("id"), body.alias("body"))


def _travelling(rows: DataFrame) -> DataFrame:
    """``rows`` with compressed texts, for a shuffle."""
    return rows.select("th", "id", text_udf(_shut, "binary")("body").alias("body"))


def later(docs: DataFrame, cover: Cover = Cover(), *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(t, first_id, ranges)`` for texts, by hash ``t``, that lose words or stand several times.

    ``first_id`` is the smallest key of the text; other rows with this text
    are copies.  ``ranges`` are starts of windows of the first row that start
    earlier elsewhere.  Documents come in the order of the key, NULL last, then
    of the text's hash (128 bits; texts are taken as equal if it is).  NULL,
    empty and short texts have no window.  An empty table gives no rows.
    """
    small_batches()
    rows = _rows(docs, text, key)
    texts = rows.groupBy("th").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")).withColumnRenamed("th", "t")
    anchors = stage(repeated_anchors(rows, cover), "anchors")
    wanted = anchors.join(texts, F.col("th") == F.col("t")).select("t", "first_id", "spans")
    chosen = _travelling(rows).join(wanted, (F.col("th") == F.col("t")) & F.col("id").eqNullSafe(F.col("first_id")))
    found = later_windows(chosen.select("th", "id", "body", "spans"), cover)
    ranges = found.groupBy("th").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    joined = texts.join(ranges, F.col("th") == F.col("t"), "left")
    # Texts and ranges are not written on their own: on a local shared folder every file costs its executor a process or more.
    marks = stage(joined.filter("ranges is not null or copies > 1").select("t", "first_id", "ranges"), "marks")
    discard(anchors)
    return marks


def kept(docs: DataFrame, cover: Cover = Cover(), *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``, one row per row of ``docs``: the words that stay, joined by a space.

    All windows of a copy start earlier, in its first row; of rows that agree
    in key and text one counts as the first.
    """
    return _finished(docs, cover, text, key, "kept", lambda words: b" ".join(words).decode("utf-8", "surrogatepass"))


def digests(docs: DataFrame, cover: Cover = Cover(), *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``kept`` with the SHA-256 of the words that stay, ``kept_sha256``, in their place."""
    return _finished(docs, cover, text, key, "kept_sha256", lambda words: hashlib.sha256(b" ".join(words)).hexdigest())


def _finished(docs: DataFrame, cover: Cover, text: str, key: str, name: str, show) -> DataFrame:
    # ``later`` writes its rows, so that the join below has a shuffle of its own on both sides and a text with many copies can be split.
    marks = later(docs, cover, text=text, key=key)
    joined = _travelling(_rows(docs, text, key)).join(marks, F.col("th") == F.col("t"), "left")
    joined = joined.withColumn("first", F.col("t").isNull() | F.col("id").eqNullSafe(F.col("first_id")))
    window = cover.window

    def run(bodies: pa.Array, spans: pa.Array) -> pa.Array:
        counts, gone, out = [], [], []
        for body, (begin, end) in zip(each(bodies), _spans_of(spans)):
            words = zstandard.decompress(body).split()
            counts.append(len(words))
            if len(begin):
                stays = ~_covered(len(words), begin, end, reach=window - 1)
                words = list(compress(words, stays.tolist()))
            gone.append(counts[-1] - len(words))
            out.append(show(words))
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())], ["n_words", "n_removed", "out"])

    made = joined.select("th", "id", "first", text_udf(run, "n_words long, n_removed long, out string")("body", "ranges").alias("made"))
    made = made.select("th", "id", "first", "made.*")
    # Rows that agree in key and text: one is the first.  Only digests or kept words travel here.
    nth = F.row_number().over(Window.partitionBy("id", "th").orderBy(F.lit(0)))
    copy = (~F.col("first") | (nth > 1)) & (F.col("n_words") >= window)
    made = made.withColumn("copy", copy)
    return made.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(F.col("copy"), F.lit(show([]))).otherwise(F.col("out")).alias(name),
    )
