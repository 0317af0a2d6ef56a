import re
from fractions import Fraction

import pytest

from isobar.llm import mixing
from isobar.llm.queries import QUERIES, SQL

from .helpers import SMALL, documents, duck, same_rows


def test_query_equals_sql(spark):
    same_rows(QUERIES["op1_mix"](spark, SMALL), SQL["op1_mix"], duck(SMALL))


def by_hand(sizes, weights, share, most):
    """Targets by resharing the excess again and again, in exact numbers."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, target, free = Fraction(share) * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        for s in over:
            target[s] = Fraction(most) * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets_taken_and_limits(spark):
    rows = [(i, " ".join(["w"] * (i % 37)), "en", ["hot", "b", "c", "d", None][0 if i % 3 else i % 5]) for i in range(900)]
    frame = documents(spark, rows)
    spec = mixing.Mix(shard_words=500, block_words=4)
    got = mixing.mixed(frame, spec).select("row.doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert len(got) == 900
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    expected = by_hand(sizes, (3, 1, 2), 1.5, 2)
    for s in sizes:
        assert target[s] == pytest.approx(float(expected[s]))
        assert abs(taken[s] - target[s]) <= max(8, 0.02 * target[s])
    again = mixing.mixed(frame.repartition(7), spec).select("row.doc_id", "source", "size", "source_size", "target", "taken")
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_blocks_go_by_highest_quotient(spark):
    weights = [53, 24, 23, 11, 7, 1, 0]
    items = spark.createDataFrame([(i, w, 40) for i, w in enumerate(weights)], "id int, w long, seats long")
    got = {r.id: r.n for r in mixing.apportion(items, [], ["id"], "w", "seats", "n").collect()}
    given = [0] * len(weights)
    for _ in range(40):
        best = max(range(len(weights)), key=lambda i: (Fraction(weights[i], 2 * given[i] + 1), -i))
        given[best] += 1
    assert got == dict(enumerate(given))


def test_sample_holds_the_words_taken(spark):
    frame = documents(spark, more="size target row taken runs s")
    spec = mixing.Mix(block_words=1)
    taken = {r.doc_id: r.taken for r in mixing.mixed(frame, spec).select("row.doc_id", "taken").collect()}
    made = mixing.sample(frame, spec)
    assert made.columns == frame.columns
    count, original = {}, {r.doc_id: r.text for r in frame.collect()}
    for r in made.collect():
        found = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        assert r.text in original[r.doc_id] and r.n_chars == len(r.text) and r.size == "size"
        count[r.doc_id] = count.get(r.doc_id, 0) + len(found)
    assert count == {k: v for k, v in taken.items() if v}
    assert taken[0] == taken[1] == taken[2] == 0


def test_empty_table_ties_and_repeats(spark):
    empty = documents(spark, [])
    assert mixing.mixed(empty).count() == 0 and mixing.sample(empty).count() == 0
    blank = documents(spark, [(1, None, None, None), (1, "", None, None)])
    assert [r.taken for r in mixing.mixed(blank).collect()] == [0, 0]
    twice = documents(spark, [(7, "a b c d", "en", "s")] * 4 + [(None, "e f", None, "s")])
    got = mixing.mixed(twice, mixing.Mix(block_words=1)).collect()
    assert sum(r.taken for r in got) == 27 and all(r.taken <= 2 * r.size for r in got)


def test_large_source_tables_are_joined_by_shuffle(spark, monkeypatch):
    frame = documents(spark, [(i, "w " * (i % 9), "en", f"s{i % 40}") for i in range(300)])
    spec = mixing.Mix(block_words=2, shard_words=20)
    columns = ["row.doc_id", "size", "target", "taken"]
    small = sorted(map(str, mixing.mixed(frame, spec).select(*columns).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    large = mixing.mixed(frame, spec).select(*columns)
    assert "ResolvedHint" not in large._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, large.collect())) == small


def test_a_repeated_key_is_cut_alike_in_every_run(spark):
    rows = [(7, f"{a} b c d", "en", "s") for a in "pqrstuvw"]
    spec = mixing.Mix(block_words=1, share=0.6)
    made = [sorted(r.text for r in mixing.sample(documents(spark, rows[::step]).repartition(n), spec).collect()) for step, n in ((1, 1), (-1, 5))]
    assert made[0] == made[1]
