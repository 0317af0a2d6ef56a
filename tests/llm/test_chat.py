import json
import random

from isobar.llm import chat
from isobar.llm.queries import QUERIES, SQL

from .helpers import SMALL, duck, same_rows

TOOLS = {"search": {"query": ("string", True), "limit": ("integer", False), "tags": ("array", False)}, "sum": {"a": ("number", True), "b": ("number", True)}, "ping": {}}


def test_query_equals_sql(spark):
    same_rows(QUERIES["op3_chat"](spark, SMALL), SQL["op3_chat"], duck(SMALL))


def log(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as seq", "1 as position", "2 as first")


def call(*calls, text="so"):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls], "text": text})


def answer(i, content="done"):
    return json.dumps({"tool_call_id": i, "content": content})


def test_links_order_and_validation(spark):
    rows = [
        (1, 0, "user", "what is 1 + 2"),
        (1, 1, "assistant", call(("a", "sum", {"b": 2, "a": 1.5}), ("b", "search", {"limit": "3", "zz": None}))),
        (1, 2, "tool", answer("b")),
        (1, 0, "tool", answer("a", "3")),  # logged before its call
        (1, 3, "tool", answer("nobody")),
        (1, 4, "assistant", call(("a", "sum", {"a": 1, "b": 1}))),  # the identifier again
        (1, 5, "assistant", call(("c", "search", [1]), ("d", "nothing", {}), ("e", "ping", {}), ("f", "search", {"query": "x", "limit": 2, "tags": ["t"]}))),
        (2, 0, "tool", answer("a")),
        (None, 0, "assistant", call(("a", "ping", {"q": 1}))),
        (None, 1, "tool", answer("a")),
    ]
    got = chat.formatted(chat.embedded(log(spark, rows)), TOOLS).collect()
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.seq)
    assert [r.seq for r in one] == list(range(len(one)))
    place = {(r.kind, r.call_id, r.turn): r.seq for r in one if r.kind != "message"}
    assert place["call", "a", 1] < place["result", "a", 0] and place["call", "b", 1] < place["result", "b", 2]
    calls = {(r.call_id, r.turn): r for r in one if r.kind == "call"}
    assert calls["a", 1].status == "answered" and calls["a", 1].valid
    assert calls["a", 4].status == "duplicate" and calls["c", 5].status == "unanswered"
    assert calls["b", 1].problems == ["missing query", "not integer: limit", "unknown zz"]
    assert calls["c", 5].problems == ["no object"] and calls["d", 5].problems == ["unknown tool"]
    assert calls["e", 5].valid and calls["f", 5].valid
    results = {r.call_id: r.status for r in one if r.kind == "result"}
    assert results == {"a": "linked", "b": "linked", "nobody": "orphan"}
    assert {r.status for r in got if r.conv_id == 2} == {"orphan"}
    assert {(r.kind, r.status) for r in got if r.conv_id is None} == {("message", None), ("call", "answered"), ("result", "linked")}
    for r in got:
        value = json.loads(r.json)
        assert r.json == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_canonical_json(spark):
    texts = ['{"b": 1, "a": {"d": [1, {"z": null, "y": "é\\n"}], "c": true}}', "[ ]", '"x"', "nope", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.c for r in frame.select(chat.canonical(frame.t).alias("c")).collect()]
    assert got == ['{"a":{"c":true,"d":[1,{"y":"é\\n","z":null}]},"b":1}', "[]", '"x"', None, None, None]


def test_hot_identifier_and_repeats(spark):
    rows = [(5, t, "assistant", call(("same", "ping", {}))) for t in range(0, 400, 2)] + [(5, t, "tool", answer("same")) for t in range(1, 400, 2)]
    random.Random(1).shuffle(rows)
    got = chat.formatted(chat.embedded(log(spark, rows + rows[:1])), TOOLS).collect()
    calls = [r for r in got if r.kind == "call"]
    assert sum(r.status == "answered" for r in calls) in (1, 2) and all(r.status == "linked" for r in got if r.kind == "result")
    assert sorted(r.seq for r in got) == list(range(len(got)))


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None, None, None), (None, None, "user", ""), (2, 0, "assistant", "{broken"), (2, 0, "assistant", "{}"), (2, 1, "tool", "plain"), (3, 0, "assistant", '{"tool_calls": [{}, null, 5]}'), (3, 1, "user", "x" * 50_000), (4, 0, "assistant", '{"tool_calls": "no"}')]
    for made in (chat.embedded, chat.exchanges):
        got = chat.formatted(made(log(spark, rows)), TOOLS).collect()
        assert len(got) >= len(rows) and all(json.loads(r.json)["kind"] == r.kind for r in got)
        assert chat.formatted(made(log(spark, [])), TOOLS).count() == 0


def test_long_conversations_are_numbered_in_blocks(spark):
    rows = [(1, t, "assistant", call((f"c{t}", "ping", {}))) for t in range(60)] + [(1, t + 1, "tool", answer(f"c{t}")) for t in range(60)] + [(None, 3, "user", "x"), (2, 0, None, None)]
    random.Random(2).shuffle(rows)
    events = chat.embedded(log(spark, rows))
    whole, parts = (sorted(map(str, chat.formatted(events, TOOLS, block_rows=n).collect())) for n in (1_000_000, 7))
    assert whole == parts and len(whole) == 182


def test_the_query_meets_every_status_and_problem(spark):
    got = QUERIES["op3_chat"](spark, SMALL).collect()
    assert {(r.kind, r.status) for r in got} >= {("call", "answered"), ("call", "unanswered"), ("call", "duplicate"), ("result", "linked"), ("result", "orphan"), ("message", None)}
    assert {r.problems for r in got if r.kind == "call"} >= {"", "missing text", "not integer: turn", "unknown extra", "unknown tool", "no object"}
    first = {(r.conv_id, r.call_id): r.seq for r in got if r.kind == "call" and r.status != "duplicate"}
    assert all(first[r.conv_id, r.call_id] < r.seq for r in got if r.status == "linked")
