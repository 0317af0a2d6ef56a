"""The registered queries of the text operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import centroids, chat, classifier, lines, mixing, pieces, pii, resample, rules, simhash, substrings, topk, urls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(table: str, sql: str | None = None) -> Callable:
    """Register a function of (table, folder) under its own name."""

    def register(build: Callable[[DataFrame, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(spark.read.parquet(f"{folder}/{table}.parquet"), folder)

        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER before, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM s
  WINDOW before AS (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(source_size * 2.0::DOUBLE, w * max(level) OVER ()) AS target,
         greatest(1, ceil(source_size / greatest(32768, ceil(sum(source_size) OVER () / 8192))))::BIGINT AS n
  FROM l),
-- Every quotient, from the first block on.
q AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS r
  FROM t, unnest(range(0, (target / 4)::BIGINT + 2)) AS u(k)
  WHERE target > 0),
b AS (
  SELECT source, count(*) AS blocks FROM q
  WHERE r <= (SELECT floor(sum(target) / 8 + 0.5) FROM t) GROUP BY source),
p AS (
  SELECT d.*, ('0x' || substr(h, 1, 8))::BIGINT % n AS shard, source_size, target
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
z AS (SELECT source, shard, sum(size)::BIGINT AS shard_size FROM p GROUP BY ALL),
zq AS (
  SELECT source, shard, row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard, k) AS r
  FROM z, unnest(range(0, shard_size // 4 + 2)) AS u(k) WHERE shard_size > 0),
zb AS (
  SELECT zq.source, shard, count(*) AS blocks
  FROM zq JOIN b ON zq.source IS NOT DISTINCT FROM b.source WHERE r <= b.blocks GROUP BY ALL),
y AS (
  SELECT z.*, ('0x' || substr(md5('mix:' || coalesce(z.source, 'null') || ':' || z.shard), 1, 8))::BIGINT
              % greatest(shard_size // 8, 1) * 8 AS f,
         least(coalesce(blocks, 0), shard_size * 2 // 8) * 8 AS len
  FROM z LEFT JOIN zb ON z.source IS NOT DISTINCT FROM zb.source AND z.shard = zb.shard),
a AS (
  SELECT p.*, y.f, y.len, y.shard_size,
         sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY h, doc_id NULLS LAST, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS pos
  FROM p JOIN y ON p.source IS NOT DISTINCT FROM y.source AND p.shard = y.shard)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(0, least(pos + size, f + len) - greatest(pos, f))
        + greatest(0, least(pos + size + shard_size, f + len) - greatest(pos + shard_size, f))
        + greatest(0, least(pos + size + 2 * shard_size, f + len) - greatest(pos + 2 * shard_size, f)))::BIGINT AS taken
FROM a"""


@query("documents", MIX_SQL)
def op1_mix(documents: DataFrame, folder: str) -> DataFrame:
    rows = mixing.mixed(documents, kept=["doc_id"])
    return rows.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("documents")
def op2_simhash(documents: DataFrame, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents, shingle=3, distance=3)
    return found.select("doc_id", simhash.hexed(F.col("fp")).alias("fingerprint"), "component_id")


@query("documents")
def op10_pieces(documents: DataFrame, folder: str) -> DataFrame:
    made = pieces.digests(documents.sparkSession, F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    return documents.select("doc_id", made.alias("made")).select("doc_id", "made.*")


#: A document counts as good from this score on.
GOOD = 0.7


@query("documents")
def op4_quality(documents: DataFrame, folder: str) -> DataFrame:
    labels = documents.sparkSession.read.parquet(f"{folder}/labels.parquet")
    model = classifier.quality_model(documents, labels)
    scored = documents.select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), classifier.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


@query("documents")
def op5_pii(documents: DataFrame, folder: str) -> DataFrame:
    weights = pii.fit(documents)
    return documents.select("doc_id", pii.spans(F.col("text"), weights).alias("found")).select("doc_id", "found.*")


RULES_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         row_number() OVER () AS r
  FROM documents),
-- Places of three-word windows that occur twice or more in their text.
g AS (
  SELECT r, pos, count(*) OVER (PARTITION BY r, w[pos], w[pos + 1], w[pos + 2]) AS n
  FROM d, unnest(range(1, len(w) - 1)) AS u(pos)),
c AS (
  SELECT r, count(DISTINCT pos + k) AS n_repeat_words
  FROM g, unnest([0, 1, 2]) AS v(k) WHERE n > 1 GROUP BY r),
l AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM d, unnest(string_split(t, chr(10))) AS u(line)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN c USING (r) LEFT JOIN l USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 2 * n_words
            OR word_chars > 20 * n_words OR 5 * n_symbols > n_words OR 10 * n_dup_lines > n_words) AS kept
FROM m"""


@query("documents", RULES_SQL)
def op6_rules(documents: DataFrame, folder: str) -> DataFrame:
    rows = rules.ledger(documents.select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        rules.fails(rules.BASE).alias("base_failed"),
        (~rules.fails(rules.STRICT)).alias("kept"),
    )


@query("documents")
def op8_substrings(documents: DataFrame, folder: str) -> DataFrame:
    return substrings.digests(documents)


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
  WHERE q.vec_id % 100 = 0),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10"""


@query("embeddings", TOPK_SQL)
def op7_topk(embeddings: DataFrame, folder: str) -> DataFrame:
    return topk.nearest(embeddings, F.col("vec_id") % 100 == 0, k=10, scale=1024)


URLS_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM p),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
  FROM h)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    PATTERNS
    ELSE 'allow' END AS verdict
FROM r"""
# Every pattern on every URL, in order.
URLS_SQL = URLS_SQL.replace("PATTERNS", "\n    ".join(f"WHEN regexp_matches(low, '{p}') THEN '{a}'" for _, p, _, a in urls.PATTERN_RULES))


@query("pages", URLS_SQL)
def op9_urls(pages: DataFrame, folder: str) -> DataFrame:
    rows = urls.judged(pages.select("page_id", "url"))
    return rows.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


#: What a call in the dialogues may hold.
NOTE: chat.Schemas = {"note": {"turn": ("integer", True), "text": ("string", True), "tags": ("array", False)}}


def with_calls(conversations: DataFrame) -> DataFrame:
    """The dialogues as a log of JSON: every assistant turn calls a tool, every other call is wrong in one of several ways or has no answer at its place.

    By ``(3 * conv_id + turn) % 8``: 0 right, 1 a mistyped field, 2 a missing one and no
    answer, 3 an unknown one and an answer to nobody, 4 an unknown tool, 5 no
    object, 6 answered a turn too early, 7 right; 5 and 7 share an identifier, so the later one is a duplicate.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    way = F.pmod(F.col("conv_id") * 3 + F.col("turn"), F.lit(8))
    name = F.when(F.col("way").isin(5, 7), F.lit("same")).otherwise(F.concat(F.lit("c"), F.col("turn").cast("string")))
    spoken = rows.filter("role = 'assistant'").withColumn("way", way).withColumn("id", name)
    turn, text = F.col("turn"), F.col("text")
    arguments = F.to_json(
        F.struct(
            F.when(F.col("way") != 1, turn).alias("turn"),
            F.when(F.col("way") == 1, turn.cast("string")).alias("TURN"),
            F.when(F.col("way") != 2, text).alias("text"),
            F.when(F.col("way") == 3, F.lit(True)).alias("extra"),
            F.when(F.col("way") == 6, F.array("conv_id")).alias("tags"),
        )
    )
    arguments = F.when(F.col("way") == 5, F.to_json(F.array("turn"))).otherwise(F.replace(arguments, F.lit('"TURN":'), F.lit('"turn":')))
    shown = F.to_json(F.struct("text"))
    tool = F.when(F.col("way") == 4, F.lit("other")).otherwise(F.lit("note"))
    call = F.concat(F.lit('{"arguments":'), arguments, F.lit(',"id":"'), F.col("id"), F.lit('","name":"'), tool, F.lit('"}'))
    body = F.concat(F.lit('{"tool_calls":['), call, F.lit("],"), F.substr(shown, F.lit(2)))
    body = F.when(text.isNull(), F.concat(F.lit('{"tool_calls":['), call, F.lit("]}"))).otherwise(body)
    to = F.when(F.col("way") == 3, F.concat(F.lit("nobody"), turn.cast("string"))).otherwise(F.col("id"))
    content = F.to_json(F.struct(F.concat(F.lit("chars "), F.char_length("text").cast("string")).alias("content"), to.alias("tool_call_id")))
    answers = spoken.filter("way <> 2").select("conv_id", F.when(F.col("way") == 6, turn - 1).otherwise(turn + 1).alias("turn"), F.lit("tool").alias("role"), content.alias("text"))
    others = rows.filter("role is null or role <> 'assistant'")
    return others.unionByName(spoken.select("conv_id", "turn", "role", body.alias("text"))).unionByName(answers)


CHAT_SQL = """
WITH m AS (SELECT conv_id, turn, role, text, ((3 * conv_id + turn) % 8 + 8) % 8 AS way FROM conversations),
a AS (SELECT *, CASE WHEN way IN (5, 7) THEN 'same' ELSE 'c' || turn END AS id FROM m WHERE role = 'assistant'),
calls AS (
  SELECT conv_id, turn, 'call' AS kind, id, role, CASE way WHEN 4 THEN 'other' ELSE 'note' END AS name, CAST(NULL AS VARCHAR) AS text,
         CASE way WHEN 5 THEN '[' || turn || ']' ELSE '{' || concat_ws(',', CASE WHEN way = 3 THEN '"extra":true' END, CASE WHEN way = 6 THEN '"tags":[' || conv_id || ']' END,
              CASE WHEN way <> 2 AND text IS NOT NULL THEN '"text":' || to_json(text) END, '"turn":' || CASE WHEN way = 1 THEN '"' || turn || '"' ELSE turn::VARCHAR END) || '}' END AS arguments,
         CASE WHEN way = 4 THEN ['unknown tool'] WHEN way = 5 THEN ['no object'] ELSE list_sort(list_filter(
              [CASE WHEN way = 2 OR text IS NULL THEN 'missing text' END, CASE WHEN way = 1 THEN 'not integer: turn' END, CASE WHEN way = 3 THEN 'unknown extra' END], lambda p: p IS NOT NULL)) END AS problems
  FROM a),
results AS (
  SELECT conv_id, CASE way WHEN 6 THEN turn - 1 ELSE turn + 1 END AS turn, 'result' AS kind, CASE way WHEN 3 THEN 'nobody' || turn ELSE id END AS id, 'tool' AS role,
         NULL AS name, 'chars ' || length(text) AS text, NULL AS arguments, NULL AS problems
  FROM a WHERE way <> 2),
messages AS (SELECT conv_id, turn, 'message' AS kind, NULL AS id, role, NULL AS name, text, NULL AS arguments, NULL AS problems FROM m),
f AS (SELECT conv_id, id, min(turn) AS first, count(*) AS n FROM calls GROUP BY ALL),
g AS (SELECT DISTINCT conv_id, id, true AS answered FROM results),
e AS (
  SELECT x.*, first, answered FROM (SELECT * FROM calls UNION ALL SELECT * FROM results UNION ALL SELECT * FROM messages) x
  LEFT JOIN f ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND x.id = f.id LEFT JOIN g ON x.conv_id IS NOT DISTINCT FROM g.conv_id AND x.id = g.id),
j AS (
  SELECT *, CASE kind WHEN 'call' THEN CASE WHEN turn <> first THEN 'duplicate' WHEN answered THEN 'answered' ELSE 'unanswered' END
                      WHEN 'result' THEN CASE WHEN first IS NULL THEN 'orphan' ELSE 'linked' END END AS status,
         CASE kind WHEN 'result' THEN greatest(turn, first) ELSE turn END AS position,
         '{' || concat_ws(',', '"arguments":' || arguments, '"call_id":"' || id || '"', '"kind":"' || kind || '"', '"name":"' || name || '"',
                          '"role":' || to_json(role), '"text":' || to_json(text), '"turn":' || turn) || '}' AS json
  FROM e)
SELECT conv_id, turn, kind, id AS call_id, json, status, array_to_string(problems, ';') AS problems,
       CASE WHEN kind = 'call' THEN len(problems) = 0 END AS valid,
       row_number() OVER (PARTITION BY conv_id ORDER BY position NULLS FIRST, list_position(['message', 'call', 'result'], kind), turn NULLS FIRST, json) - 1 AS seq
FROM j"""


@query("conversations", CHAT_SQL)
def op3_chat(conversations: DataFrame, folder: str) -> DataFrame:
    rows = chat.formatted(chat.embedded(with_calls(conversations)), NOTE)
    return rows.withColumn("problems", F.concat_ws(";", "problems")).withColumn("problems", F.when(F.col("kind") == "call", F.col("problems")))


def _round(n: int) -> str:
    """One assignment to the centroids ``c{n}``, and the centroids after it."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT r, min([distance, cluster]) AS won FROM (
    SELECT r, cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
    FROM v, c{n} c) GROUP BY r),
m{n} AS (
  SELECT cluster, place, sum(y) AS total, count(*) AS n
  FROM (SELECT won[2] AS cluster, unnest(x) AS y, generate_subscripts(x, 1) AS place FROM a{n} JOIN v USING (r)) GROUP BY ALL),
c{n + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(y, x) AS x FROM c{n} LEFT JOIN (
    SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY place) AS y FROM m{n} GROUP BY cluster) USING (cluster)),"""


CENTROIDS_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, x) - 1 AS cluster, x
  FROM v QUALIFY cluster < 16),{"".join(map(_round, range(3)))}
{_round(3).strip().partition("m3 AS")[0].rstrip().rstrip(",")}
SELECT vec_id, won[2]::INT AS cluster, won[1] AS distance,
       sum(won[1]) OVER (PARTITION BY won[2])::BIGINT AS cluster_inertia, sum(won[1]) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN v USING (r) JOIN c3 ON c3.cluster = won[2]"""


@query("embeddings", CENTROIDS_SQL)
def op11_centroids(embeddings: DataFrame, folder: str) -> DataFrame:
    return centroids.clusters(embeddings, centroids.Clustering(count=16, rounds=3, size=64, scale=64, seed=1))


RESAMPLE_SQL = r"""
WITH crc AS (
  -- The table of CRC-32: eight steps of its polynomial for each byte.
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
df AS (SELECT r, array_to_string(w[p:p + n - 1], ' ') AS f, count(*) AS k FROM d, unnest([1, 2, 3]) AS u(n), unnest(range(1, len(w) - n + 2)) AS v(p) GROUP BY ALL),
bf AS (SELECT array_to_string(w[p:p + n - 1], ' ') AS f, count(*) AS k FROM b, unnest([1, 2, 3]) AS u(n), unnest(range(1, len(w) - n + 2)) AS v(p) GROUP BY ALL),
x AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
g AS MATERIALIZED (
  SELECT f, xor(list_reduce(range(length(h) // 2),
      lambda c, k: xor(c >> 8, t[(xor(c, ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM x, crc),
s AS (SELECT bucket, sum(k) AS n FROM df JOIN g USING (f) GROUP BY 1),
t AS (SELECT bucket, sum(k) AS n FROM bf JOIN g USING (f) GROUP BY 1),
z AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0) + 10000)::DOUBLE
                  / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
y AS (SELECT r, sum(k) AS n_features, sum(k * gain) AS weight FROM df JOIN g USING (f) JOIN z USING (bucket) GROUP BY r),
o AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN y USING (r)),
q AS (SELECT *, row_number() OVER (ORDER BY (n_words >= 20) DESC, score DESC, doc_id NULLS LAST, n_features) AS place FROM o)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= 5 * (SELECT count(*) FROM o WHERE n_words >= 20) // 100 THEN place END AS rank
FROM q"""


@query("documents", RESAMPLE_SQL)
def op12_resample(documents: DataFrame, folder: str) -> DataFrame:
    benchmark = documents.sparkSession.read.parquet(f"{folder}/benchmark.parquet")
    rows = resample.resampled(documents, benchmark, resample.Resampling(longest=3, buckets=10_000, least=20, percent=5, seed=42))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


LINES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (
  SELECT r, doc_id, md5(t) AS h, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
  FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (
  SELECT key, true AS goes FROM (SELECT DISTINCT doc_id, h, key FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= 10)
SELECT doc_id, count(*) AS n_lines, count(goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE goes IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY r, doc_id"""


@query("documents", LINES_SQL)
def op13_lines(documents: DataFrame, folder: str) -> DataFrame:
    rows = lines.deduplicated(documents, least=10, shortest=1)
    return rows.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
