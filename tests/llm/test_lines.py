import pytest
from pyspark.sql import functions as F

from isobar.llm import lines
from isobar.llm.queries import QUERIES, SQL

from .helpers import SMALL, documents, duck, same_rows

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows, least, shortest=1, keep_first=False):
    """(id, n_lines, n_dropped, kept) of every row; a document is a distinct (id, text)."""
    rows = [(i, t or "") for i, t in rows]
    holders, first = {}, {}
    # The text's hash orders documents of one key; tests of the first place use keys that differ.
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for n, line in enumerate(t.split("\n")):
            k = key_of(line)
            if len(k) >= shortest:
                holders.setdefault(k, set()).add((i, t))
                first.setdefault(k, (i, t, n))
    out = []
    for i, t in rows:
        split = t.split("\n")
        gone = [
            len(holders.get(key_of(x), ())) >= least and not (keep_first and first[key_of(x)] == (i, t, n))
            for n, x in enumerate(split)
        ]
        out.append((i, len(split), sum(gone), "\n".join(x for x, g in zip(split, gone) if not g)))
    return sorted(out, key=str)


def found(docs, **how):
    return sorted(map(tuple, lines.deduplicated(docs, **how).collect()), key=str)


ROWS = [
    *[(i, f"Shared Line\nown {i}\n  SHARED LINE \x0b\n\n\ttail{i % 3}") for i in range(12)],
    (20, "shared line"),
    (21, None),
    (22, ""),
    (23, "\n\n"),
    (24, "naïve ÉCOLE\nNAÏVE école\n東京"),
    (25, "naïve ÉCOLE\nplain"),
    (25, "plain\r\nÉcole"),
    (25, "plain\r\nÉcole"),
    (None, "shared line\nplain"),
    (None, "x\n" * 300 + "shared line\n" + "y\n" * 300),
    (26, "\n".join(f"long {n}" if n % 7 else "shared line" for n in range(5000))),
]


def test_query_equals_sql(spark):
    same_rows(QUERIES["op13_lines"](spark, SMALL), SQL["op13_lines"], duck(SMALL))


@pytest.mark.parametrize("heaviest, heavy_rows", [(0, 1), (1000, 100_000), (2, 1), (1000, 1)])
@pytest.mark.parametrize("least, shortest, keep_first", [(10, 1, False), (2, 1, False), (3, 6, False), (2, 1, True), (1, 1, True)])
def test_equals_plain_whichever_way_lines_are_counted(spark, least, shortest, keep_first, heaviest, heavy_rows):
    # One document a key where the first place counts.
    rows = [r for n, r in enumerate(ROWS) if not keep_first or r[0] not in [q[0] for q in ROWS[:n]]]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows], more="id th pos h1 keep line body").repartition(5)
    got = found(docs, least=least, shortest=shortest, keep_first=keep_first, heaviest=heaviest, heavy_rows=heavy_rows)
    assert got == plain(rows, least, shortest, keep_first)


def test_repeated_rows_are_one_document_and_get_one_bitmap(spark):
    docs = documents(spark, [(1, "a\nb", "en", "s")] * 30 + [(2, "a", "en", "s")])
    assert found(docs, least=2) == [(1, 2, 1, "b")] * 30 + [(2, 1, 1, "")]
    assert {r[2] for r in found(docs, least=3)} == {0}


def test_bitmaps_hold_words_with_dropped_lines_only(spark):
    text = "\n".join("same" if n in (3, 700) else f"line {n}" for n in range(1000))
    docs = documents(spark, [(1, text, "en", "s"), (2, "same", "en", "s")])
    marks = {r.id: r for r in lines.keep_bitmaps(docs, least=2).collect()}
    assert [(w.word, w.bits) for w in marks[1].keep] == [(0, ~(1 << 3)), (10, ~(1 << 60))]
    assert (marks[1].n_dropped, marks[2].n_dropped) == (2, 1)


def test_no_exchange_by_hash_besides_the_ranges(spark):
    seen = documents(spark, [(i, f"l{i}", "en", "s") for i in range(50)])
    plan = lines._ranged(lines.places(seen), 2, True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_a_text_of_many_lines_takes_time_in_proportion(spark):
    docs = documents(spark, [(1, "same\nother\n" * 100_000, "en", "s"), (2, "same", "en", "s")])
    row = lines.deduplicated(docs, least=2).filter("id = 1").select("n_lines", "n_dropped", F.length("kept")).first()
    assert tuple(row) == (200_001, 100_000, 600_000)


def test_empty_table(spark):
    assert found(documents(spark, []).limit(0)) == []
