"""The registered queries of this subpackage: thin calls of the operators with
production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import chat_format as op10
from tokenloom.llm import divergence as op13
from tokenloom.llm import html_extract as op4
from tokenloom.llm import line_dedup as op5
from tokenloom.llm import mixing as op8
from tokenloom.llm import mtree as op6
from tokenloom.llm import packing as op9
from tokenloom.llm import quality_knn as op7
from tokenloom.llm import quality_rules as op2
from tokenloom.llm import simhash as op3
from tokenloom.llm import token_counts as op1
from tokenloom.llm import url_filter as op12
from tokenloom.llm import vector_codes as op11
from tokenloom.llm.common import table
from tokenloom.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Longest document, in tokens, that is not reported as over the limit.
TOKEN_LIMIT = 2048


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = op1.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op3.simhash_duplicates(docs, shingle=3, max_bits=3).drop("row")


@query
def op7_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.mix(table(spark, sf_dir, "documents"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return op9.pack(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), ranks=path("byte_bpe_50k.tiktoken"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op5.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=op5.ANY_WORDS)
    return out.withColumnRenamed("__removed", "n_removed")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row")


@query
def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.extract_pages(table(spark, sf_dir, "pages"))


@query
def op6_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLES["op6_mtree_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


#: The tool that a user's turn calls in the query's derived messages.
ANSWER_SCHEMA = (
    '{"additionalProperties":false,"properties":{"question":{"maxLength":400,"minLength":1,"type":"string"},'
    '"turn":{"minimum":0,"type":"integer"}},"required":["question","turn"],"type":"object"}'
)


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as tool traffic: a user's turn is a call of the tool
    `answer` (every fourth exchange starts anew, the others come after the
    exchange before), an assistant's turn is the result of the call one turn
    earlier, other turns stay messages."""
    call_id = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    after = F.when(F.col("turn") % 8 >= 2, F.array(call_id(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    arguments = F.struct(F.col("turn").alias("turn"), F.col("text").alias("question"))
    call = F.struct(call_id(F.col("turn")).alias("id"), F.lit("answer").alias("name"), arguments.alias("arguments"), after.alias("after"))
    as_call = F.to_json(F.struct(F.array(call).alias("tool_calls")))
    as_result = F.to_json(F.struct(call_id(F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    return conversations.select(
        "conv_id", "turn",
        F.when(user, "assistant").when(assistant, "tool").otherwise(F.col("role")).alias("role"),
        F.when(user, as_call).when(assistant, as_result).otherwise(F.col("text")).alias("text"),
    )


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = spread(table(spark, sf_dir, "conversations"))
    schemas = spark.range(1).select(F.lit("answer").alias("name"), F.lit(ANSWER_SCHEMA).alias("parameters"))
    out = op10.linked_chats(tool_messages(chats), schemas)
    return out.withColumn("errors", F.array_join("errors", ","))


ORACLES["op10_chat_format"] = """
WITH m AS (
  SELECT conv_id, turn, role, text, 'call-' || turn AS own, 'call-' || (turn - 1) AS prior FROM conversations
), u AS (
  SELECT *, turn % 8 >= 2 AS later FROM m WHERE role = 'user'
), l0 AS (
  SELECT conv_id, turn, 0 AS level FROM u WHERE NOT later
), l1 AS (
  SELECT u.conv_id, u.turn, 1 AS level FROM u JOIN l0 ON later AND u.conv_id = l0.conv_id AND u.turn = l0.turn + 2
), l2 AS (
  SELECT u.conv_id, u.turn, 2 AS level FROM u JOIN l1 ON later AND u.conv_id = l1.conv_id AND u.turn = l1.turn + 2
), l3 AS (
  SELECT u.conv_id, u.turn, 3 AS level FROM u JOIN l2 ON later AND u.conv_id = l2.conv_id AND u.turn = l2.turn + 2
), l AS (
  SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3
), a AS (
  SELECT r.conv_id, r.turn, u.turn AS call_turn FROM m r JOIN u ON r.role = 'assistant' AND r.conv_id = u.conv_id AND u.turn = r.turn - 1
)
SELECT u.conv_id, u.turn, CAST(coalesce(l.level, -1) AS INTEGER) AS level, 0 AS place, 'assistant' AS role, 'call' AS kind, own AS call_id,
       a.turn IS NOT NULL AS linked,
       CASE WHEN text IS NULL THEN 'missing question' WHEN length(text) < 1 OR length(text) > 400 THEN 'length question' ELSE '' END AS errors,
       '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"question":' || CAST(to_json(text) AS VARCHAR) || ',' END
         || '"turn":' || u.turn || '},"id":"' || own || '","name":"answer","type":"call"}' AS json
FROM u LEFT JOIN l ON u.conv_id = l.conv_id AND u.turn = l.turn LEFT JOIN a ON u.conv_id = a.conv_id AND u.turn = a.call_turn
UNION ALL
SELECT r.conv_id, r.turn, CAST(coalesce(l.level, -1) AS INTEGER), 0, 'tool', 'result', prior, a.turn IS NOT NULL, NULL,
       '{' || CASE WHEN text IS NULL THEN '' ELSE '"content":' || CAST(to_json(text) AS VARCHAR) || ',' END
         || '"id":"' || prior || '","type":"result"}'
FROM m r LEFT JOIN a ON r.conv_id = a.conv_id AND r.turn = a.turn LEFT JOIN l ON a.conv_id = l.conv_id AND a.call_turn = l.turn
WHERE role = 'assistant'
UNION ALL
SELECT conv_id, turn, -1, -1, role, 'message', NULL, false, NULL,
       '{' || CASE WHEN text IS NULL THEN '' ELSE '"content":' || CAST(to_json(text) AS VARCHAR) || ',' END
         || '"role":' || CAST(to_json(role) AS VARCHAR) || ',"type":"message"}'
FROM m WHERE role NOT IN ('user', 'assistant')
"""


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.divergence(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), kept AS MATERIALIZED (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), c AS MATERIALIZED (
  SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(total) AS size FROM kept GROUP BY lang
), sizes AS (
  SELECT lang, source, sum(n) AS size FROM c GROUP BY lang, source
), groups AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(s.size, 0) AS size, coalesce(l.v, 0) AS v, l.size AS lang_size
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN sizes s USING (lang, source) LEFT JOIN langs l USING (lang)
), p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.size + 5 * g.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 5)) // (g.lang_size + 5 * g.v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


#: The rules of the url filter, host and path with their verdicts.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


@query
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.vector_codes(table(spark, sf_dir, "embeddings"))


def _codes_sql(rounds: int) -> str:
    """Lloyd rounds unrolled: a{i} holds the nearest entries under the codebooks b{i}."""
    parts = ["""
v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT r, CAST(s AS BIGINT) AS part, v[s * (len(v) // 8) + 1 : (s + 1) * (len(v) // 8)] AS x FROM v, range(8) t(s)
), b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM p WHERE r <= 16)"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, part, CAST(m % 256 AS BIGINT) AS entry, CAST(m // 256 AS BIGINT) AS error FROM (
    SELECT p.r, p.part, min(CAST(list_sum(list_transform(list_zip(p.x, b.x), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS HUGEINT) * 256 + b.entry) AS m
    FROM p JOIN b{i} b USING (part) GROUP BY p.r, p.part)
)""")
        if i < rounds:
            parts.append(f"""
b{i + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(n.x, b.x) AS x FROM b{i} b LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % c) + c) % c) // c AS BIGINT) ORDER BY i) AS x FROM (
      SELECT part, entry, i, sum(x[i]) AS s, count(*) AS c
      FROM (SELECT a.part, a.entry, p.x, unnest(generate_series(1, len(p.x))) AS i FROM a{i} a JOIN p USING (r, part))
      GROUP BY part, entry, i)
    GROUP BY part, entry) n USING (part, entry)
)""")
    return "WITH " + ",".join(parts) + f""",
c AS (
  SELECT r, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r
), l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM c JOIN v USING (r) GROUP BY label)
SELECT v.vec_id, c.code, c.error, l.label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN c USING (r) JOIN l ON v.label IS NOT DISTINCT FROM l.label
"""


ORACLES["op11_vector_codes"] = _codes_sql(op11.ROUNDS)
