import random
import re

import numpy as np
import xxhash

from isobar.llm import simhash
from isobar.llm.components import components
from isobar.llm.queries import QUERIES

from .helpers import SMALL, documents


def plain_print(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=3):
    """{id: smallest id reachable}, ids that are None last."""
    ids = list(prints)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_query_equals_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    groups = plain_groups(prints)
    got = QUERIES["op2_simhash"](spark, SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", groups[i]) for i in texts}
    assert len(got) == len(texts) and len(set(groups.values())) < len(texts)


def test_close_prints_share_a_block():
    rng = random.Random(1)
    masks = simhash.masks(3, 3)
    assert len(masks) == 20
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any((a ^ b) & m & (1 << 64) - 1 == 0 for m in masks)


def test_tiles_and_components_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    centers = rng.integers(-(2**62), 2**62, 6)
    prints = {int(c ^ sum(1 << int(b) for b in rng.choice(62, 3, replace=False))) for c in centers for _ in range(60)}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    wanted = plain_groups({p: p & (1 << 64) - 1 for p in prints})
    wanted = {p: r for p, r in wanted.items()}
    for tile in (5, 8192):
        labels = components(simhash.links(frame, tile=tile))
        got = {r.node: r.root for r in labels.collect()}
        assert {p: got.get(p, p) for p in prints} == wanted


def test_long_chain(spark):
    chain = spark.range(1, 300).selectExpr("id as u", "id - 1 as v")
    got = components(chain.unionByName(spark.createDataFrame([(1000, 999), (5, 5)], "u long, v long")))
    assert {r.node: r.root for r in got.collect()} == {i: 0 for i in range(300)} | {1000: 999, 999: 999}


def test_odd_rows(spark):
    frame = documents(spark, more="fp root u v")
    frame = frame.unionByName(frame).unionByName(frame.limit(0))
    got = simhash.near_duplicates(frame).collect()
    assert len(got) == 22
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].fp == by_id[1].fp == by_id[2].fp == 0
    assert by_id[2].component_id == 0 and by_id[6].component_id == 5
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in got})


def test_keyless_rows(spark):
    rows = [(None, "alone in the world of words", None, None)] * 2 + [(None, "shared text of some rows", None, None), (4, "shared text of some rows", None, None)]
    frame = documents(spark, rows)
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(frame).collect()) == ["4", "4", "None", "None"]
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(frame).collect()) == ["4", "None"]


def test_empty_table(spark):
    empty = documents(spark, [])
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0
