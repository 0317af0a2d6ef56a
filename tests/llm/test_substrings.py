import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isobar.llm import substrings
from isobar.llm.queries import QUERIES

from .helpers import SMALL, documents


def plain(rows, window=20):
    """[(id, words, removed flags)] of rows (id, text) by looking at every window."""
    listed = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    listed.sort(key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), []
    for i, words in listed:
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            run = tuple(words[p : p + window])
            if run in seen:
                gone[p : p + window] = [True] * window
            seen.add(run)
        out.append((i, words, gone))
    return out


def expected(rows, window=20):
    return sorted(
        (str(i), len(w), sum(g), " ".join(x for x, y in zip(w, g) if not y)) for i, w, g in plain(rows, window)
    )


def found(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in df.collect())


def test_query_equals_all_windows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op8_substrings"](spark, SMALL).collect())
    assert got == [(i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in expected(rows)]
    assert sum(m for _, _, m, _ in got) > 0


def test_hashes_follow_the_words():
    """Equal words and stretches hash alike wherever they lie, different ones apart; texts that touch stay apart."""
    texts = ["ab cd ab", "", "  ab\tcd\x0bab\n", "abcd", "x" * 3000 + " ab", "é ab", "cd ab cd ab cd"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    hasher = substrings.Hasher()
    listed = hasher.words(data, offsets)
    assert [len(h) for h in listed] == [len(b.split()) for b in raw]
    by_word = {}
    for words, hashes in zip((b.split() for b in raw), listed):
        for w, h in zip(words, hashes.tolist()):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    last = listed[-1]
    runs = hasher.runs(last, np.arange(3), 3, 2).tolist()
    assert runs[0] == runs[2] != runs[1]
    assert hasher.runs(listed[0], np.arange(1), 3, 2).tolist()[0] == runs[1]


@pytest.mark.parametrize("at_once", [1, 60, 2_000_000])
def test_planted_passages(spark, at_once, monkeypatch):
    monkeypatch.setattr(substrings, "WORDS_AT_ONCE", at_once)
    monkeypatch.setattr(substrings, "BYTES_AT_ONCE", at_once)
    rng = random.Random(at_once)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passages = [fresh(n) for n in (19, 20, 21, 33, 60)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(4)):
            words += fresh(rng.randrange(30)) + rng.choice(passages)
        rows.append((i * 7 % 120, " ".join(words)))
    rows += [(500 + i, " ".join(passages[4] * 3)) for i in range(5)] + [(600, "a b " * 40), (601, "b a " * 25)]
    frame = documents(spark, [(i, t, None, None) for i, t in rows]).repartition(5)
    assert found(substrings.kept(frame)) == expected(rows)


def test_any_cover(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(60)))) for i in range(60)]
    frame = documents(spark, [(i, t, None, None) for i, t in rows])
    for cover in (substrings.Cover(window=9, period=7, residues=(0, 1, 3)), substrings.Cover(window=6, period=3, residues=(0, 1))):
        assert found(substrings.kept(frame, cover)) == expected(rows, cover.window)
    with pytest.raises(ValueError):
        substrings.Cover(window=20, period=13, residues=(0, 1, 3))


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(45))
    rows = [(1, long), (1, long), (None, long), (None, long), (2, None), (2, ""), (None, None), (3, "short text"), (3, "short text"), (0, "x " + long)]
    frame = documents(spark, [(i, t, None, None) for i, t in rows], more="th id first out ranges")
    assert found(substrings.kept(frame)) == expected(rows)
    assert substrings.kept(documents(spark, [])).count() == 0
    odd = documents(spark)
    assert found(substrings.kept(odd)) == expected([(r.doc_id, r.text) for r in odd.collect()])


def test_a_text_in_many_chunks_names_its_anchors_once(spark, monkeypatch):
    """Chunks of one text each: the longest list does not grow with the copies."""
    monkeypatch.setattr(substrings, "WORDS_AT_ONCE", 1)
    passage = " ".join(f"p{i}" for i in range(60))
    longest = []
    for copies in (5, 60):
        rows = [(i, "own start " + passage, "en", "s") for i in range(copies)] + [(1000, passage + " other end", "en", "s")]
        frame = substrings._rows(documents(spark, rows), "text", "doc_id").repartition(6)
        lists = substrings.repeated_anchors(frame, substrings.Cover()).select(F.size("spans").alias("n")).collect()
        longest.append(max(r.n for r in lists))
    assert longest[0] == longest[1] > 0


def test_texts_are_told_apart_by_128_bits(spark):
    rows = substrings._rows(documents(spark, [(1, "a", "en", "s"), (2, None, "en", "s"), (3, "", "en", "s")]), "text", "doc_id").collect()
    assert [len(r.th) for r in rows] == [16, 16, 16] and rows[1].th == rows[2].th != rows[0].th


@pytest.mark.parametrize("step", ["anchors", "windows"])
def test_a_task_holds_and_hands_on_little(step):
    """Many long texts: what a task allocates and each batch it gives to Spark stay small, whatever it reads."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(5000)]
    read = []
    for k in range(24):
        texts = [" ".join(rng.choices(words, k=10_000)) for _ in range(10)]
        keys = [hashlib.md5(t.encode()).digest() for t in texts]
        body = pa.array(texts) if step == "anchors" else substrings._shut(pa.array(texts))
        batch = {"th": pa.array(keys, pa.binary()), "id": pa.array(range(10 * k, 10 * k + 10), pa.int64()), "body": body}
        if step == "windows":
            batch["spans"] = pa.array([[{"begin": 0, "end": 4000}]] * 10)
        read.append(pa.RecordBatch.from_pydict(batch))
    run = substrings.anchor_batches if step == "anchors" else substrings.window_batches
    count = 0
    tracemalloc.start()
    for made in run(iter(read), substrings.Cover()):
        assert made.num_rows <= substrings.ROWS_AT_ONCE <= 100_000
        count += made.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count > (700_000 if step == "anchors" else 2_300_000)
    assert peak < 150e6, peak
