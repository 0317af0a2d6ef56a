"""Importance resampling towards a target distribution over hashed n-grams.

A document's weight is the sum of gains of its n-grams' buckets; a bucket gains
by how much more often the target texts hold it than the corpus does.  Documents
are drawn without replacement by the largest weight plus Gumbel noise.

Texts are read in pieces of some hundred kilobytes.  Inside a piece

* words are hashed together by XXH64 over flat arrays and interned in an
  open-addressed table of slots, a hash counting as equal only if the bytes are;
* a run of two or three words is the bytes of its words' slots, hashed and
  interned the same way in a table per length;
* a slot stores its bucket and how often the piece holds it.  Checksums of runs
  come from their words' by shifting over GF(2), so no run is spelled out.

The counting pass sums counts by bucket, the weighing pass gathers the gains of
each occurrence through its slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.text import small_batches
from isobar.operators.ordered import number_rows
from isobar.staging import discard, stage

#: Bytes of text that are taken together.
PIECE = 400_000

# The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _with_lane(h: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turned(h ^ (_turned(lane * P2, 31) * P1), 27) * P1 + P4


def _avalanche(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


#: Longer words are hashed one by one.
SHORT = 31


def lanes_of(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first 32 bytes of each stretch as four numbers, zero beyond its end; ``data`` has 32 bytes to spare."""
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    keep = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    out = np.zeros((4, len(begin)), np.uint64)
    for lane in range(4):
        some = slice(None) if lane == 0 else np.flatnonzero(size > 8 * lane)
        raw = np.ascontiguousarray(eight[begin[some] + 8 * lane]).view("<u8").ravel()
        out[lane, some] = raw & keep[np.clip(size[some] - 8 * lane, 0, 8)]
    return out


def short_hashes(lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 with seed 0 of stretches of at most ``SHORT`` bytes."""
    h = P5 + size.astype(np.uint64)
    for lane in range(3):
        some = np.flatnonzero(size >= 8 * (lane + 1))
        h[some] = _with_lane(h[some], lanes[lane, some])
    tail = lanes[np.minimum(size >> 3, 3), np.arange(len(size))]
    some = np.flatnonzero(size & 4)
    h[some] = _turned(h[some] ^ ((tail[some] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
    tail[some] >>= np.uint64(32)
    for n in range(3):
        some = np.flatnonzero((size & 3) > n)
        h[some] = _turned(h[some] ^ (((tail[some] >> np.uint64(8 * n)) & np.uint64(255)) * P5), 11) * P1
    return _avalanche(h)


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """XXH64 with seed 0 of rows of at most three numbers of eight bytes; ``rows`` is numbers x rows."""
    h = np.full(rows.shape[1], P5 + np.uint64(8 * len(rows)), np.uint64)
    for lane in rows:
        h = _with_lane(h, lane)
    return _avalanche(h)


def interned(keys: np.ndarray, content: np.ndarray, extra=None) -> tuple[np.ndarray, np.ndarray]:
    """(slot of each occurrence, first occurrence of each slot): equal content has one slot.

    An open-addressed table of twice as many places as occurrences, at least.
    All occurrences probe together: a free place goes to one of those that
    want it, the others compare their key and then their content (numbers x
    occurrences, and ``extra(a, b)`` for what it doesn't hold) with its owner's.
    """
    count = len(keys)
    mask = (1 << max(4, int(2 * count).bit_length())) - 1
    table = np.full(mask + 1, -1, np.int64)
    owner = np.empty(count, np.int64)
    waiting, at = np.arange(count), (keys & np.uint64(mask)).astype(np.int64)
    while len(waiting):
        free = table[at] < 0
        # Written backwards, so that the first one of those that want a place gets it.
        table[at[free][::-1]] = waiting[free][::-1]
        held = table[at]
        same = keys[held] == keys[waiting]
        for lane in content:
            same &= lane[held] == lane[waiting]
        if extra is not None and same.any():
            same[same] = extra(held[same], waiting[same])
        owner[waiting[same]] = held[same]
        waiting, at = waiting[~same], (at[~same] + 1) & mask
    first = np.flatnonzero(owner == np.arange(count))
    number = np.empty(count, np.int64)
    number[first] = np.arange(len(first))
    return number[owner], first


# ---- checksums ---------------------------------------------------------------


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)  # the CRC-32 polynomial
    return table


class Shifts:
    """What a checksum becomes when so many bytes follow it, as a table per byte of the checksum."""

    most = 64

    def __init__(self):
        one = _byte_table()
        images = np.uint32(1) << np.arange(32, dtype=np.uint32)  # of the 32 single bits
        tables = []
        for _ in range(self.most + 1):
            tables.append(self._spread(images))
            images = one[images & 255] ^ (images >> 8)
        self.tables = np.array(tables)

    @staticmethod
    def _spread(images: np.ndarray) -> np.ndarray:
        out = np.zeros((4, 256), np.uint32)
        for bit in range(32):
            out[bit // 8] ^= np.where((np.arange(256) >> (bit % 8)) & 1, images[bit], np.uint32(0))
        return out

    def after(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``crc`` shifted over ``size`` bytes each."""
        crc, size = crc.copy(), size.copy()
        while (far := np.flatnonzero(size > self.most)).size:
            crc[far] = self._once(crc[far], np.full(len(far), self.most))
            size[far] -= self.most
        return self._once(crc, size)

    def _once(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        t = self.tables
        return t[size, 0, crc & 255] ^ t[size, 1, (crc >> 8) & 255] ^ t[size, 2, (crc >> 16) & 255] ^ t[size, 3, crc >> 24]


# ---- pieces of text ----------------------------------------------------------


@dataclass(frozen=True)
class Resampling:
    """longest: words of a feature.  buckets: of the checksums.  least: words of a document that may be drawn.  percent: of those that are drawn.  seed: of the draw."""

    longest: int = 3
    buckets: int = 10_000
    least: int = 20
    percent: int = 5
    seed: int = 42


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _word_bytes() -> np.ndarray:
    """Digits, a-z and all bytes beyond ASCII, so a code point beyond it is whole in a word."""
    return np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@dataclass
class Piece:
    """Features of a piece by occurrence: the document each one ends in, its slot, and the bucket of each slot."""

    doc: np.ndarray
    slot: np.ndarray
    bucket: np.ndarray
    words: np.ndarray  # words that end here, by document


class Reader:
    """Pieces of a list of texts."""

    def __init__(self, how: Resampling):
        self.how, self.lower, self.solid, self.shifts = how, _lower(), _word_bytes(), Shifts()

    def pieces(self, texts: list[bytes]) -> Iterator[Piece]:
        """All features of the texts, each in one piece; a long text is cut between words and read on with the last words before the cut."""
        held: list[tuple[int, bytes, int]] = []  # document, bytes, leading words that were counted before
        size = 0
        for doc, text in enumerate(texts):
            begin = known = cut = 0
            while len(text) - cut > PIECE:
                cut = self._gap(text, cut + PIECE)
                if cut >= len(text):
                    break
                if held:
                    yield self._piece(held)
                    held, size = [], 0
                yield self._piece([(doc, text[begin:cut], known)])
                begin, known = self._back(text, cut)
            if size and size + len(text) - begin > PIECE:
                yield self._piece(held)
                held, size = [], 0
            held.append((doc, text[begin:] if begin else text, known))
            size += len(text) - begin
        if held:
            yield self._piece(held)

    def _gap(self, text: bytes, at: int) -> int:
        """The first place from ``at`` that is in no word."""
        while at < len(text):
            some = self.lower[np.frombuffer(text, np.uint8, min(4096, len(text) - at), at)]
            outside = np.flatnonzero(~self.solid[some])
            if len(outside):
                return at + int(outside[0])
            at += len(some)
        return at

    def _back(self, text: bytes, cut: int) -> tuple[int, int]:
        """Where the last ``longest - 1`` words before ``cut`` begin, and how many they are."""
        reach = 4096
        while True:
            low = max(0, cut - reach)
            solid = self.solid[self.lower[np.frombuffer(text, np.uint8, cut - low, low)]]
            before = np.concatenate(([low > 0], solid[:-1]))
            starts = np.flatnonzero(solid & ~before)
            wanted = self.how.longest - 1
            if len(starts) >= wanted or not low:
                chosen = starts[len(starts) - min(wanted, len(starts)) :]
                return (low + int(chosen[0]) if len(chosen) else cut), len(chosen)
            reach *= 4

    def _piece(self, held: list[tuple[int, bytes, int]]) -> Piece:
        how = self.how
        sizes = np.array([len(t) + 1 for _, t, _ in held])
        data = self.lower[np.frombuffer(b"\0".join(t for _, t, _ in held) + bytes(40), np.uint8)]
        solid = self.solid[data]
        edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        if solid[0]:
            edges = np.concatenate(([0], edges))
        begin, size = edges[::2], edges[1::2] - edges[::2]
        part = np.searchsorted(np.cumsum(sizes), begin, "right")
        doc = np.array([d for d, _, _ in held])[part]
        first = np.searchsorted(part, np.arange(len(held)))
        place = np.arange(len(begin)) - first[part]  # of a word in its part
        fresh = place >= np.array([k for _, _, k in held])[part]

        word, kept = self._words(data, begin, size)
        raw = data.tobytes()
        spelled = [raw[b : b + s] for b, s in zip(begin[kept].tolist(), size[kept].tolist())]
        alone = np.array([zlib.crc32(w) for w in spelled], np.uint32)
        spaced = np.array([zlib.crc32(b" " + w) for w in spelled], np.uint32)
        long = (size[kept] + 1).astype(np.int64)

        docs, slots, buckets, base = [], [], [], 0
        crc = alone[word] if len(word) else np.empty(0, np.uint32)
        for n in range(1, how.longest + 1):
            ends = np.flatnonzero((place >= n - 1) & fresh)
            if n == 1:
                slot, held_crc = word[ends], alone
            else:
                # A run's checksum is that of the run without its last word, moved on by this word and a blank.
                crc = np.concatenate((np.zeros(1, np.uint32), crc[:-1]))
                crc = self.shifts.after(crc, long[word]) ^ spaced[word] if len(word) else crc
                rows = np.array([word[ends - k] for k in range(n - 1, -1, -1)]).astype(np.uint64)
                slot, owner = interned(row_hashes(rows) if n <= 3 else _rows_one_by_one(rows), rows)
                held_crc = crc[ends[owner]]
            docs.append(doc[ends])
            slots.append(slot + base)
            buckets.append((held_crc % np.uint32(how.buckets)).astype(np.int64))
            base += len(held_crc)
        words = np.bincount(doc[fresh], minlength=(held[-1][0] + 1) if held else 0)
        return Piece(np.concatenate(docs), np.concatenate(slots), np.concatenate(buckets), words)

    def _words(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(begin):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lanes = lanes_of(data, begin, size)
        short = size <= SHORT
        keys = short_hashes(lanes, np.where(short, size, 0))
        wide = np.flatnonzero(~short)
        keys[wide] = [xxhash.xxh64_intdigest(data[b : b + s].tobytes()) for b, s in zip(begin[wide].tolist(), size[wide].tolist())]

        def rest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Whether long words agree beyond their first 32 bytes."""
            return np.array([s <= 32 or bool((data[x : x + s] == data[y : y + s]).all()) for x, y, s in zip(begin[a].tolist(), begin[b].tolist(), size[b].tolist())])

        content = np.concatenate((lanes, size[None].astype(np.uint64)))
        return interned(keys, content, rest if len(wide) else None)


def _rows_one_by_one(rows: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(r.tobytes()) for r in np.ascontiguousarray(rows.T)], np.uint64)


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of a column as bytes, some at a time; NULL is empty."""
    for at in range(0, len(column), 64):
        yield [b"" if t is None else t for t in column.slice(at, 64).cast(pa.large_binary()).to_pylist()]


def bucket_counts(docs: DataFrame, how: Resampling = Resampling(), *, text: str = "text") -> DataFrame:
    """``(bucket, n)``: how many features of all texts fall into each bucket that has any."""

    def run(batches):
        reader, counts = Reader(how), np.zeros(how.buckets, np.int64)
        for batch in batches:
            for texts in _texts(batch.column(0)):
                for piece in reader.pieces(texts):
                    stored = np.bincount(piece.slot, minlength=len(piece.bucket))
                    counts += np.bincount(piece.bucket, stored, how.buckets).astype(np.int64)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], ["bucket", "n"])

    small_batches()
    parts = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(target: DataFrame, source: DataFrame, how: Resampling = Resampling()) -> np.ndarray:
    """The gain of every bucket, in thousandths, from two tables of ``bucket_counts``."""
    t, s = np.zeros(how.buckets), np.zeros(how.buckets)
    for counts, out in ((target, t), (source, s)):
        rows = counts.toArrow()  # a row for each bucket
        out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    ratio = (t + 1) * (s.sum() + how.buckets) / ((s + 1) * (t.sum() + how.buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, how: Resampling = Resampling(), *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(id, n_words, n_features, weight)``, a row for every row of ``docs``."""

    def run(batches):
        reader = Reader(how)
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            at = 0
            for texts in _texts(batch.column("body")):
                here = slice(at, at + len(texts))
                for piece in reader.pieces(texts):
                    worth = gain[piece.bucket][piece.slot]
                    n_words[here][: len(piece.words)] += piece.words
                    n_features[here] += np.bincount(piece.doc, minlength=len(texts))
                    weight[here] += np.bincount(piece.doc, worth, len(texts)).astype(np.int64)  # exact below 2**53
                at += len(texts)
            columns = [batch.column("id"), *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    small_batches()
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))
    return rows.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def noise(key: Column, how: Resampling = Resampling()) -> Column:
    """Gumbel noise in thousandths, from the key alone; a NULL key has that of an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resampled(
    docs: DataFrame, target: DataFrame, how: Resampling = Resampling(), *, text: str = "text", key: str = "doc_id", target_text: str = "text"
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)``, a row for every row of ``docs``.

    Of the documents with at least ``how.least`` words ``how.percent`` in a
    hundred are drawn (rounded down), those of highest score, ties to the
    smaller key, NULL last; ``rank`` counts them from 1 and is NULL for the others.
    NULL, empty and wordless texts have no feature and weight 0.  Rows that
    repeat a key are documents of their own with equal noise; of such rows with equal
    scores the one with fewer features goes first, and equal rows in any
    order.  Without target texts the gains still sum as if every bucket had
    been seen once.  An empty table gives no rows.
    """
    gain = gains(bucket_counts(target, how, text=target_text), bucket_counts(docs, how, text=text), how)
    rows = weighed(docs, gain, how, text=text, key=key)
    rows = rows.withColumns({"score": F.col("weight") + noise(F.col("id"), how), "able": F.col("n_words") >= how.least})
    # The last column splits equal rows over ranges; it is written, so it stays as it is.
    written = stage(rows.withColumn("nth", F.monotonically_increasing_id()), "weights")
    drawn = written.filter("able").count() * how.percent // 100
    order = [F.col("able").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features").asc(), F.col("nth").asc()]
    numbered = number_rows(written, order)
    place = F.col("__seq") + 1
    discard(written)
    return numbered.select(
        F.col("id").alias("doc_id"), "n_words", "n_features", "weight", "score", F.when(F.col("able") & (place <= drawn), place).alias("rank")
    )
