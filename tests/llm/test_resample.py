import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from isobar.llm import resample
from isobar.llm.queries import QUERIES, SQL
from isobar.llm.resample import Reader, Resampling

from .helpers import ODD_TEXTS, SMALL, documents, duck, same_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, how):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, how.longest + 1) for i in range(len(words) - n + 1)]


def bucket(feature, how):
    return zlib.crc32(feature.encode()) % how.buckets


def plain(docs, target, how):
    read = [(i, *features(t, how)) for i, t in docs]
    s = Counter(bucket(f, how) for _, _, fs in read for f in fs)
    t = Counter(bucket(f, how) for x in target for f in features(x, how)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + how.buckets) / ((s[b] + 1) * (t.total() + how.buckets)))) for b in s}
    rows = []
    for i, n, fs in read:
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f, how)] for f in fs)
        rows.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    rows.sort(key=lambda r: (r[1] < how.least, -r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = how.percent * sum(r[1] >= how.least for r in rows) // 100
    return sorted([(*r, k + 1 if k < drawn else None) for k, r in enumerate(rows)], key=str)


def found(docs, target, how):
    return sorted(map(tuple, resample.resampled(docs, target, how).collect()), key=str)


def test_query_equals_sql(spark):
    same_rows(QUERIES["op12_resample"](spark, SMALL), SQL["op12_resample"], duck(SMALL))


@pytest.mark.parametrize("how", [Resampling(least=3, percent=50), Resampling(longest=1, buckets=7, least=0, percent=100), Resampling(longest=5, buckets=64, least=2, percent=10, seed=7)])
def test_equals_plain(spark, how):
    rng = random.Random(3)
    vocabulary = [*(f"w{i}" for i in range(40)), "É", "ABC", "東京", "q" * 40, "q" * 39 + "z"]
    texts = [*ODD_TEXTS, *(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for _ in range(60))]
    rows = [*enumerate(texts), (5, "one more two"), (5, "one more two"), (None, "w1 w2 w3 w4"), (None, None)]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows], more="id weight score able nth rank body").repartition(4)
    target = ["w1 w2 w3 w1 w2", "abc É", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert found(docs, frame, how) == plain(rows, target, how)


def test_hashes_are_xxh64():
    rng = random.Random(1)
    words = [bytes(rng.randrange(256) for _ in range(rng.randrange(resample.SHORT + 1))) for _ in range(2000)]
    data = np.frombuffer(b" ".join(words) + bytes(40), np.uint8)
    size = np.array([len(w) for w in words])
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    assert resample.short_hashes(resample.lanes_of(data, begin, size), size).tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    for n in (1, 2, 3):
        rows = np.random.default_rng(n).integers(0, 1 << 40, (n, 50)).astype(np.uint64)
        assert resample.row_hashes(rows).tolist() == [xxhash.xxh64_intdigest(r.tobytes()) for r in np.ascontiguousarray(rows.T)]


def test_table_verifies_bytes_behind_equal_hashes():
    content = np.array([[1, 2, 1, 3, 2, 1]], np.uint64)
    slot, first = resample.interned(np.zeros(6, np.uint64), content)  # every hash collides
    assert slot.tolist() == [0, 1, 0, 2, 1, 0] and first.tolist() == [0, 1, 3]
    slot, first = resample.interned(np.full(3, (1 << 64) - 1, np.uint64), np.zeros((1, 3), np.uint64), lambda a, b: a == b)
    assert first.tolist() == [0, 1, 2]  # what the rest of the bytes tells apart


def test_checksums_by_shifts():
    shifts = resample.Shifts()
    for tail in (b"", b"x", b" word", b"y" * 64, b"z" * 65, b"long " * 100):
        crc = np.array([zlib.crc32(b"head")], np.uint32)
        assert int(shifts.after(crc, np.array([len(tail)]))[0]) ^ zlib.crc32(tail) == zlib.crc32(b"head" + tail)


@pytest.mark.parametrize("piece", [1, 30, 500])
def test_pieces_of_a_long_text_hold_every_run_once(monkeypatch, piece):
    monkeypatch.setattr(resample, "PIECE", piece)
    how, rng = Resampling(), random.Random(piece)
    texts = [rng.choice(["", "é", "-"]) + " ".join(rng.choice(["a", "bb", "ccc", "é" * 30, "x" * 200]) for _ in range(rng.randrange(80))) for _ in range(12)]
    got = [Counter() for _ in texts]
    count = [0] * len(texts)
    for p in Reader(how).pieces([t.encode() for t in texts]):
        for d, s in zip(p.doc.tolist(), p.slot.tolist()):
            got[d][int(p.bucket[s])] += 1
        for d, n in enumerate(p.words.tolist()):
            count[d] += n
    for text, buckets, n in zip(texts, got, count):
        words, fs = features(text, how)
        assert (n, buckets) == (words, Counter(bucket(f, how) for f in fs))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(documents(spark, []).limit(0), none, Resampling()) == []
    rows = [(i, f"word{i} " * 30) for i in range(40)]
    assert found(documents(spark, [(i, t, "en", "s") for i, t in rows]), none, Resampling()) == plain(rows, [], Resampling())
