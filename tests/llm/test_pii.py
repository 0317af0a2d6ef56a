import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import pii
from isobar.llm.queries import QUERIES

from .helpers import SMALL, documents

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + n % 2), 10)) for n, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


SAMPLES = ["write to ann.lee@mail.example.com or 10.0.0.255", "pay 4111 1111 1111 1111 or call +1 (487) 555-7209 now", "id 4111-1111-1111-1112, host 300.1.1.1"] * 4


@pytest.fixture(scope="module")
def weights():
    return pii.train(SAMPLES)


def test_base_spans_equal_plain_patterns():
    rng = random.Random(2)
    for alphabet in ("01.", "0123456789 -", "+0(). -1", "ab@.-1_", "a@.b %", "é@1.+ -\n9"):
        for _ in range(800):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert pii.base_spans(text) == plain_base(text), text


def test_query_keeps_the_base(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op5_pii"](spark, SMALL).collect()
    assert len(got) == len(texts) and sum(r.n_email for r in got) > 0
    for r in got:
        base = plain_base(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, pii.joined(base).split(","))) <= set(r.spans.split(","))


def every_segmentation(lat, scores):
    """All segmentations with their scores, by brute force."""
    by_begin = {}
    for s, (i, j) in enumerate(zip(lat.begin, lat.end)):
        by_begin.setdefault(int(i), []).append((s, int(j)))

    def go(i):
        if i == lat.size:
            yield ()
            return
        yield from go(i + 1)
        for s, j in by_begin.get(i, []):
            for rest in go(j):
                for kind in range(scores.shape[1]):
                    yield ((s, kind), *rest)

    return [(p, sum(scores[s, k] for s, k in p)) for p in go(0)]


def test_dynamic_programming_equals_enumeration():
    rng = np.random.default_rng(1)
    part = "12345 6789.1234 77-88"
    lat = pii.lattice(part)
    assert 3 < len(lat.begin) < 20
    for _ in range(5):
        weights = rng.normal(0, 1, (len(pii.KINDS), pii.FEATURES))
        scores = lat.phi @ weights.T
        every = every_segmentation(lat, scores)
        path = max(every, key=lambda x: x[1])
        token = {a: n for n, a in enumerate(lat.offsets)}
        chosen = [(k, token[a], token[b]) for k, a, b in pii.best(part, weights)]
        found = sum(scores[np.flatnonzero((lat.begin == i) & (lat.end == j))[0], k] for k, i, j in chosen)
        assert np.isclose(found, path[1])
        probabilities, whole = pii.marginals(lat, scores)
        z = sum(np.exp(v) for _, v in every)
        assert np.isclose(np.exp(whole), z)
        for s, k in itertools.product(range(len(lat.begin)), range(len(pii.KINDS))):
            assert np.isclose(probabilities[s, k], sum(np.exp(v) for p, v in every if (s, k) in p) / z)


def test_field_separates_neighbours(weights):
    base, every = pii.find("call +1 (487) 555-7209 4111111111111111 now", weights)
    assert base == [] and every == [("card", 23, 39), ("phone", 5, 22)]
    assert pii.masked("call +1 (487) 555-7209 4111111111111111 now", weights) == "call [PHONE] [CARD] now"
    for clean in ("the year 2024 had 365 days", "v1.2.3 of 12 parts", "no digits here", "a + b @ c"):
        assert pii.find(clean, weights)[1] == []


def seconds(text, weights):
    least = float("inf")
    for _ in range(3):
        began = time.perf_counter()
        pii.find(text, weights)
        least = min(least, time.perf_counter() - began)
    return least


@pytest.mark.parametrize(
    "part",
    ["9", "a@", "1.", "1 ", "+1", "@", "9" * 40 + ".", "10.0.0.255 ", "some words of prose, then 10.0.0.255 and ", "a.b@mail.example.com ", "+1 (487) 555-7209 4111111111111111 "],
    ids=lambda part: part[:12],
)
def test_time_grows_with_the_text_and_no_faster(weights, part):
    count = 12_000 // len(part)
    once, four = seconds(part * count, weights), seconds(part * (4 * count), weights)
    assert four < 8 * once + 0.05  # 16 times would be quadratic
    base, every = pii.find(part * count, weights)
    assert set(base) <= set(every)


def plain_added(text, base, weights):
    """The field's spans by the whole lattice of each stretch, each compared with every base span."""
    out = []
    for begin, end in pii.stretches(text):
        lat = pii.lattice(text[begin:end], text[max(0, begin - 1) : begin], text[end : end + 1])
        if not len(lat.begin):
            continue
        scores = lat.phi @ weights.T
        value = [0.0] * (lat.size + 1)
        path = [[] for _ in range(lat.size + 1)]
        for j in range(1, lat.size + 1):
            value[j], path[j] = value[j - 1], path[j - 1]
            for s in np.flatnonzero(lat.end == j):
                k, i = int(scores[s].argmax()), int(lat.begin[s])
                if scores[s, k] > 0 and value[i] + scores[s, k] > value[j]:
                    value[j], path[j] = value[i] + scores[s, k], [*path[i], (k, begin + lat.offsets[i], begin + lat.offsets[j])]
        out += [(pii.KINDS[k], a, b) for k, a, b in path[-1] if not any(a < y and x < b for _, x, y in base)]
    return sorted(out, key=lambda s: (pii.KINDS.index(s[0]), s[1]))


@pytest.mark.parametrize("at_once", [1, 3, 2000])
def test_added_spans_equal_a_plain_version(spark, weights, monkeypatch, at_once):
    monkeypatch.setattr(pii, "TOKENS_AT_ONCE", at_once)
    rng = random.Random(8)
    bits = ["+1 (487) 555-7209", "4111111111111111", "4111 1111 1111 1111", "10.0.0.255", "300.1.1.1", "a.b@mail.example.com", "x@y", "12", "2024", "é", ",", "\n", "+", "call", "1.2.3.4.5"]
    some = 0
    for _ in range(300):
        text = "".join(rng.choice(bits) + rng.choice([" ", "", "-", ".", " and "]) for _ in range(rng.randrange(30)))
        base = pii.base_spans(text)
        found = pii.added_spans(text, base, weights)
        assert found == plain_added(text, base, weights)
        some += len(found)
    assert some > 50
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    for text in texts:
        assert pii.added_spans(text or "", pii.base_spans(text or ""), weights) == plain_added(text or "", pii.base_spans(text or ""), weights)


def test_chains_begin_where_no_digit_stands_before():
    rng = random.Random(6)
    old = re.compile(r"[0-9]++(?:\.[0-9]++)++")
    for _ in range(3000):
        text = "".join(rng.choice("0123..  a") for _ in range(rng.randrange(40)))
        assert [m.span() for m in old.finditer(text)] == [m.span() for m in pii._DOTTED.finditer(text)]


def test_odd_rows_empty_table_and_columns(spark, weights):
    frame = documents(spark, more="spans found n_ip")
    frame = frame.unionByName(frame)
    rows = frame.select("doc_id", pii.spans(F.col("text"), weights).alias("x")).collect()
    assert len(rows) == 22 and all(r.x.spans == "" for r in rows)
    assert {r.x.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert [r.t for r in frame.filter("doc_id = 0").select(pii.redacted(F.col("text"), weights).alias("t")).collect()] == [None, None]
    empty = documents(spark, [])
    untrained = pii.fit(empty)
    assert not untrained.any() and empty.select(pii.spans(F.col("text"), untrained)).count() == 0


def test_rare_kinds_behind_other_numbers_are_learned(spark):
    filler = "plain words without any numbers in them stand here " * 5
    years = [f"in {1000 + i % 1000} the price was {i}.50 {filler}" for i in range(3000)]
    rng = random.Random(9)
    rare = [f"write to a{i}.lee@mail{i}.example.com now" for i in range(30)] + [f"host 10.{i}.0.255 is up" for i in range(30)]
    rare += [f"call +1 ({200 + i}) 555-{7000 + 13 * i} now" for i in range(30)]
    for i in range(60):
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        digits += next(c for c in "0123456789" if pii.luhn(digits + c))
        rare.append("pay " + (digits if i % 2 else " ".join(digits[k : k + 4] for k in range(0, 16, 4))) + " today")
    texts = [*years, *[f"{y} {r}" for y, r in zip(years, rare)], None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = pii.fit(frame.repartition(3))
    for text in ("call +1 (487) 555-7209 4111111111111111", "call +1 (487) 555-7209 4111111111111111 now"):
        assert pii.find(text, found)[1] == [("card", 23, 39), ("phone", 5, 22)]
    for clean in ("the year 2024 had 365 days", "v1.2.3 of 12 parts", "in 1999 the price was 7.50"):
        assert pii.find(clean, found)[1] == []
    assert (pii.fit(frame.unionByName(frame).repartition(7)) == found).all()


def test_windows_take_every_stretch():
    spans = ["ann.lee@mail.example.com", "10.0.0.255", "4111 1111 1111 1111", "+1 (487) 555-7209"]
    text = " ".join(f"{w}, {n}," for n in range(200) for w in spans)
    assert len(pii.stretches(text)) == 1
    found = list(pii.windows(text))
    assert max(len(w) for w, _ in found) <= pii.WINDOW
    assert all({k for k, _, _ in pii.base_spans(w)} == kinds for w, kinds in found)
    assert sum(len(pii.base_spans(w)) for w, _ in found) == len(pii.base_spans(text)) == 800
    for text in ("9" * 5_000, "1 " * 5_000, "a" * 5_000 + "@b.c", "1." * 5_000, "@" * 5_000, "+1" * 5_000):
        assert all(len(w) <= pii.WINDOW for w, _ in pii.windows(text))


def test_smallest_keeps_a_bound_for_each_kind():
    rng = random.Random(5)
    texts = [f"{rng.randrange(10**6)} parts of {rng.randrange(10**6)}" for _ in range(500)] + [f"host 10.0.{i}.7" for i in range(40)] + ["pay 4111111111111111"]
    kept = pii.smallest(texts, 25)
    assert {k: len(v) for k, v in kept.items()} == {"email": 0, "ip": 25, "card": 1, "phone": 0, "none": 25}
    rng.shuffle(texts)
    assert pii.smallest(texts, 25) == kept
    halves = [pii.smallest(texts[::2], 25), pii.smallest(texts[1::2], 25)]
    assert all(dict(sorted({**halves[0][k], **halves[1][k]}.items())[:25]) == kept[k] for k in kept)
