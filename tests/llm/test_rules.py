import itertools
import random

from pyspark.sql import functions as F

from isobar.llm import rules
from isobar.llm.queries import QUERIES, SQL
from isobar.llm.text import words

from .helpers import SMALL, documents, duck, same_rows


def test_query_equals_sql(spark):
    same_rows(QUERIES["op6_rules"](spark, SMALL), SQL["op6_rules"], duck(SMALL))


def plain_repeats(listed):
    windows = [tuple(listed[i : i + 3]) for i in range(len(listed) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_repeat_words(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc"[: 1 + i % 3]) for _ in range(rng.randrange(30))) for i in range(200)]
    frame = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = frame.withColumn("words", words(F.col("text"))).select("text", rules.repeat_words(F.col("words")).alias("n")).collect()
    for r in got:
        assert r.n == plain_repeats(r.text.split()), r.text


def test_ledger_bits_policies_and_ablations(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = rules.ledger(frame)
    data = rows.collect()
    names = list(rules.RULES)
    tests = rows.selectExpr("failures", *[f"({t}) as `{n}`" for n, t in rules.RULES.items()]).collect()
    for r in tests:
        assert r.failures == sum(1 << k for k, n in enumerate(names) if r[n])
    old = rules.Policy("base", 2, ("few_words", "many_symbols"))
    judged = rules.verdicts(rows, [rules.BASE, old, rules.STRICT]).collect()
    for r in judged:
        assert r.base_v1 == (not r.failures & rules.BASE.mask()) and r.base_v2 == (not r.failures & old.mask())
    table = {r.rule: r for r in rules.ablations(rows, rules.STRICT).collect()}
    assert set(table) == set(rules.STRICT.rules)
    for k, name in enumerate(names):
        bit = 1 << k
        assert table[name].failed == sum(bool(r.failures & bit) for r in data)
        assert table[name].failed_alone == sum(r.failures == bit for r in data)
        assert table[name].kept_without == sum(r.failures in (0, bit) for r in data)
        assert (table[name].kept, table[name].total) == (sum(r.failures == 0 for r in data), len(data))


def test_odd_rows_and_columns(spark):
    frame = documents(spark, more="words failures n_words")
    frame = frame.unionByName(frame)
    got = rules.ledger(frame).orderBy("doc_id").collect()
    assert len(got) == 22
    by_id = {r.doc_id: r for r in got}
    for i in (0, 1, 2):
        assert (by_id[i].n_words, by_id[i].word_chars, by_id[i].n_dup_lines, by_id[i].n_repeat_words) == (0, 0, 0, 0)
        assert by_id[i].failures & 1
    assert by_id[8].word_chars == 5000 and by_id[9].n_repeat_words == 6000 and by_id[10].n_dup_lines == 0
    assert all(a == b for a, b in itertools.batched(got, 2))
    assert rules.ledger(documents(spark, [])).count() == 0
    assert rules.ablations(rules.ledger(documents(spark, [])), rules.BASE).count() == 0
