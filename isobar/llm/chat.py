"""Chat logs: tool calls linked to their results, ordered, validated and written as canonical JSON.

Events are messages, calls and results.  Calls and results meet in a hash join
on conversation and identifier; the side that is built is one row per
identifier, so an identifier used thousands of times multiplies nothing.

The order is topological for the edges message -> its calls, call -> its
results, message -> next message: an event stands at its own turn, a result
logged too early stands at its call's turn, and within a turn messages come
before calls and calls before results.  Every edge then goes forward, and a
sort needs no rounds.

Everything is SQL functions; JSON is parsed and written as VARIANT, whose
objects keep their keys in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.operators.ordered import BLOCK_ROWS, positions
from isobar.staging import stage

#: What a schema may ask for, and the VARIANT types that fit.
TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$|^DECIMAL\\([0-9]+,0\\)$",
    "number": "^BIGINT$|^DECIMAL|^DOUBLE$|^FLOAT$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY",
    "object": "^OBJECT|^STRUCT",
}

#: tool -> field -> (type, required)
Schemas = dict[str, dict[str, tuple[str, bool]]]

EVENT = "conv_id long, turn long, at int, kind string, role string, call_id string, name string, text string, arguments string"
KIND_ORDER = ("message", "call", "result")


def canonical(text: Column) -> Column:
    """JSON without white space and with sorted keys, at every depth; NULL if the text is no JSON."""
    return F.to_json(F.try_parse_json(text))


def embedded(messages: DataFrame) -> DataFrame:
    """Events of a log ``(conv_id, turn, role, text)`` whose calls stand in the texts as JSON.

    ``{"tool_calls": [{"id", "name", "arguments"}], "text"}`` is a message and
    its calls, a text of role ``tool`` with ``{"tool_call_id", "content"}`` a
    result; everything else is a plain message.
    """
    parsed = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        F.try_parse_json(F.when(F.startswith(F.ltrim("text"), F.lit("{")), F.col("text"))).alias("json"),
    )
    calls = F.try_variant_get("json", "$.tool_calls", "array<variant>")
    parsed = parsed.withColumn("calls", F.when(F.col("role") == "assistant", calls))
    is_result = F.coalesce((F.col("role") == "tool") & F.try_variant_get("json", "$.tool_call_id", "string").isNotNull(), F.lit(False))
    shown = F.when(F.col("calls").isNotNull(), F.try_variant_get("json", "$.text", "string")).otherwise(F.col("text"))
    spoken = parsed.filter(~is_result).select(*_event("message", role=F.col("role"), text=shown))
    made = parsed.select("conv_id", "turn", "role", F.posexplode("calls").alias("at", "call"))
    called = made.select(
        *_event(
            "call",
            at=F.col("at"),
            role=F.col("role"),
            call_id=F.try_variant_get("call", "$.id", "string"),
            name=F.try_variant_get("call", "$.name", "string"),
            arguments=F.to_json(F.try_variant_get("call", "$.arguments", "variant")),
        )
    )
    answered = parsed.filter(is_result).select(
        *_event("result", role=F.col("role"), call_id=F.try_variant_get("json", "$.tool_call_id", "string"), text=F.try_variant_get("json", "$.content", "string"))
    )
    return spoken.unionByName(called).unionByName(answered)


def _event(kind: str, **given: Column) -> list[Column]:
    given = {"conv_id": F.col("conv_id"), "turn": F.col("turn"), "at": F.lit(0), "kind": F.lit(kind)} | given
    return [given.get(n, F.lit(None)).cast(t).alias(n) for n, t in (x.strip().split(" ") for x in EVENT.split(","))]


def problems(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, sorted: unknown tool, no object, missing, unknown or mistyped fields."""
    values = F.try_parse_json(arguments).try_cast("map<string, variant>")
    out = F.array(F.lit("unknown tool"))
    for tool, fields in schemas.items():
        names = F.array(*[F.lit(f) for f in fields]).cast("array<string>")
        found = [
            F.when(~F.map_contains_key(values, f), F.lit(f"missing {f}") if needed else F.lit(None)).when(
                ~F.rlike(F.schema_of_variant(F.try_element_at(values, F.lit(f))), F.lit(TYPES[kind])), F.lit(f"not {kind}: {f}")
            )
            for f, (kind, needed) in fields.items()
        ]
        extra = F.transform(F.array_except(F.map_keys(values), names), lambda k: F.concat(F.lit("unknown "), k))
        listed = F.sort_array(F.concat(F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"), extra))
        out = F.when(name == tool, F.when(values.isNull(), F.array(F.lit("no object"))).otherwise(listed)).otherwise(out)
    return out


def linked(events: DataFrame, schemas: Schemas) -> DataFrame:
    """``events`` with ``position status problems``.

    status: ``answered``, ``unanswered`` or ``duplicate`` (a later call with a
    used identifier) for calls, ``linked`` or ``orphan`` for results, NULL for
    messages.  A call or result without identifier is unanswered or orphan.
    """
    calls, results = events.filter("kind = 'call'"), events.filter("kind = 'result'")
    key = [F.col("conv_id").alias("c"), F.col("call_id").alias("i")]
    named = F.col("call_id").isNotNull()
    first = calls.filter(named).groupBy(*key).agg(F.min(F.struct("turn", "at")).alias("first"))
    answers = results.filter(named).groupBy(*key).agg(F.count(F.lit(1)).alias("answers"))
    meets = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i"))
    both = first.join(answers.withColumnsRenamed({"c": "c2", "i": "i2"}), F.col("c").eqNullSafe(F.col("c2")) & (F.col("i") == F.col("i2")), "left")
    both = both.select("c", "i", "first", F.col("answers").isNotNull().alias("answered"))
    acts = events.filter("kind <> 'message'").join(both.hint("shuffle_hash"), meets, "left")
    is_call = F.col("kind") == "call"
    status = (
        F.when(is_call & F.col("first").isNotNull() & (F.struct("turn", "at") != F.col("first")), "duplicate")
        .when(is_call & F.coalesce("answered", F.lit(False)), "answered")
        .when(is_call, "unanswered")
        .when(F.col("first").isNotNull(), "linked")
        .otherwise("orphan")
    )
    position = F.when(is_call, F.col("turn")).otherwise(F.greatest("turn", "first.turn"))
    wrong = F.when(is_call, problems(F.col("name"), F.col("arguments"), schemas))
    acts = acts.select(*events.columns, position.alias("position"), status.alias("status"), wrong.alias("problems"))
    plain = events.filter("kind = 'message'").select(
        "*", F.col("turn").alias("position"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("array<string>").alias("problems")
    )
    return plain.unionByName(acts)


def formatted(events: DataFrame, schemas: Schemas, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(conv_id, seq, turn, kind, call_id, status, valid, problems, json)``: every event in order, as canonical JSON.

    ``seq`` counts from 0 within a conversation; NULL turns come first and a
    NULL conversation is one of its own.  ``valid`` is NULL but for calls.
    Repeated events all stay; equal ones tie.  Arguments that are no JSON stand
    as text.  An empty table gives no rows.  Events are numbered on a written copy; a
    conversation of more than ``block_rows`` events is range-partitioned for it.
    """
    rows = linked(events, schemas)
    parsed = F.try_parse_json("arguments")
    raw = F.when(parsed.isNull(), F.col("arguments"))
    json = F.to_json(F.struct(parsed.alias("arguments"), raw.alias("arguments_text"), "call_id", "kind", "name", "role", "text", "turn"))
    kind = F.array_position(F.array(*map(F.lit, KIND_ORDER)), F.col("kind"))
    rows = stage(rows.withColumns({"json": json, "kind_order": kind}), "events")
    numbered = positions(rows, ["conv_id"], ["position", "kind_order", "turn", "at", "json"], name="seq", block_rows=block_rows)
    valid = F.when(F.col("kind") == "call", F.size("problems") == 0)
    return numbered.select(
        "conv_id",
        (F.col("seq") - 1).alias("seq"),
        "turn",
        "kind",
        "call_id",
        "status",
        valid.alias("valid"),
        "problems",
        "json",
    )


def exchanges(messages: DataFrame) -> DataFrame:
    """Events of a plain dialogue: a user turn calls ``reply``, the assistant's next turn is the result.

    The identifier is the user's turn; other roles are messages.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    asked = rows.filter("role = 'user'").select(
        *_event(
            "call",
            role=F.col("role"),
            call_id=F.col("turn").cast("string"),
            name=F.lit("reply"),
            arguments=F.to_json(F.struct("text", F.char_length("text").alias("chars"))),
        )
    )
    answered = rows.filter("role = 'assistant'").select(*_event("result", role=F.col("role"), call_id=(F.col("turn") - 1).cast("string"), text=F.col("text")))
    others = rows.filter("role is null or role not in ('user', 'assistant')").select(*_event("message", role=F.col("role"), text=F.col("text")))
    return others.unionByName(asked).unionByName(answered)
