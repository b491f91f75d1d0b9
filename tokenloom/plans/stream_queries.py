"""Registered queries over the token stream of the encoded `documents`."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import tokens as TK
from tokenloom.plans.registry import derived, register
from tokenloom.plans.tokenizer_queries import ENCODE_SQL, ids_frame
from tokenloom.session import scratch_path
from tokenloom.sources import raw_tokens as RT
from tokenloom.sources import token_stream as TS

WINDOW_T = 32  # context length of the windows
PER_BLOCK = 4096  # windows of one block of the window table
STEPS, BATCH, SEED = 4, 8, 7  # batch sampling parameters
EOT_ID = 0  # the end-of-text special has id 0


def _stream_ctes(more: str = "", ctes: str = "") -> str:
    return (
        ENCODE_SQL(more, ctes)
        + """,
doc_len AS (
  SELECT d.doc_id, count(t.token_id) + 1 AS len FROM documents d LEFT JOIN doc_tokens t USING (doc_id) GROUP BY d.doc_id
),
doc_off AS (
  SELECT doc_id, len, coalesce(sum(len) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM doc_len
),
total AS (SELECT CAST(sum(len) - 1 AS BIGINT) AS n FROM doc_len),
stream AS MATERIALIZED (
  SELECT CAST(o.off + t.ord AS BIGINT) AS gpos, CAST(t.token_id AS BIGINT) AS token_id
  FROM doc_tokens t JOIN doc_off o USING (doc_id)
  UNION ALL
  SELECT CAST(o.off + o.len - 1 AS BIGINT), CAST(0 AS BIGINT) FROM doc_off o
  WHERE o.off + o.len - 1 < (SELECT n FROM total)
)"""
    )


def _windows_sql(T: int) -> str:
    return f"""
, win_rows AS (
  SELECT gpos // {T} AS w, gpos, token_id FROM stream
  UNION ALL SELECT gpos // {T} - 1, gpos, token_id FROM stream WHERE gpos % {T} = 0 AND gpos >= {T}
)
, windows AS (
  SELECT w AS window_id, count(*) AS n_ids, string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY gpos) AS ids
  FROM win_rows WHERE w <= ((SELECT n FROM total) - 2) // {T} GROUP BY w
)"""


class _Stream:
    """Ids, stream length and windows of one data folder; the windows are
    written once per application and shared by the queries that read them."""

    def __init__(self, spark, sf_dir, T=WINDOW_T):
        self.ids = ids_frame(spark, sf_dir)
        self.T = T
        self.n, self.windows = derived(spark, ("windows", sf_dir.rstrip("/"), T), self._build)

    def _build(self):
        n = TK.stream_length(self.ids)
        windows = TK.pack_windows(self.ids, EOT_ID, self.T, n, stable=True)
        return n, TK.write_windows(windows, scratch_path(self.ids.sparkSession, "windows"), PER_BLOCK)


@register("token_stream", lambda: _stream_ctes() + "\nSELECT gpos, token_id FROM stream")
def q_token_stream(spark, sf_dir):
    ids = ids_frame(spark, sf_dir)
    s = TK.token_stream(ids, EOT_ID, stable=True)
    return s.select("gpos", F.col("token_id").cast("long"))


@register(
    "doc_offsets",
    lambda: _stream_ctes() + "\nSELECT doc_id, CAST(off AS BIGINT) AS off, CAST(len AS BIGINT) AS len FROM doc_off",
)
def q_doc_offsets(spark, sf_dir):
    return TK.doc_offsets(ids_frame(spark, sf_dir), stable=True).select("doc_id", F.col("off").cast("long"), "len")


@register(
    "pack_windows",
    lambda: _stream_ctes() + _windows_sql(WINDOW_T) + "\nSELECT window_id, n_ids, ids FROM windows",
)
def q_pack_windows(spark, sf_dir):
    st = _Stream(spark, sf_dir)
    return st.windows.select(
        F.col("window_id").cast("long"), F.size("ids").cast("long").alias("n_ids"), F.array_join("ids", " ").alias("ids")
    )


_PAIRS_SQL = """
, pairs AS (
  SELECT * FROM (SELECT gpos, token_id AS input_id, lead(token_id) OVER (ORDER BY gpos) AS target_id FROM stream)
  WHERE target_id IS NOT NULL
)"""


@register(
    "next_token_pairs", lambda: _stream_ctes() + _PAIRS_SQL + "\nSELECT gpos, input_id, target_id FROM pairs"
)
def q_next_token_pairs(spark, sf_dir):
    st = _Stream(spark, sf_dir)
    p = TK.next_token_pairs(st.windows, st.T)
    return p.select(F.col("gpos").cast("long"), F.col("input_id").cast("long"), F.col("target_id").cast("long"))


@register(
    "bigram_counts",
    lambda: _stream_ctes()
    + _PAIRS_SQL
    + "\nSELECT input_id AS prev_id, target_id AS next_id, count(*) AS n FROM pairs GROUP BY input_id, target_id",
)
def q_bigram_counts(spark, sf_dir):
    st = _Stream(spark, sf_dir)
    c = TK.bigram_counts(TK.next_token_pairs(st.windows, st.T))
    return c.select(F.col("prev_id").cast("long"), F.col("next_id").cast("long"), "n")


def sample_sql(steps: int, batch: int, seed: int, T: int) -> str:
    return f"""
, draws AS (SELECT CAST(s AS BIGINT) AS step, CAST(b AS BIGINT) AS sample FROM range({steps}) t(s), range({batch}) u(b))
, starts AS (
  SELECT step, sample,
         ('0x' || substr(md5('{seed}:' || CAST(step AS VARCHAR) || ':' || CAST(sample AS VARCHAR)), 1, 15))::BIGINT
           % ((SELECT n FROM total) - {T}) AS start
  FROM draws
)
, need AS (SELECT step, sample, o, start + o AS gpos FROM starts, range({T} + 1) v(o))
, drawn AS (
  SELECT n.step, n.sample, n.o, s.token_id AS input_id,
         lead(s.token_id) OVER (PARTITION BY n.step, n.sample ORDER BY n.o) AS target_id
  FROM need n JOIN stream s ON s.gpos = n.gpos
)
, batches AS (
  SELECT step, sample, CAST(o AS BIGINT) AS "offset", input_id, target_id FROM drawn WHERE o < {T}
)"""


@register(
    "sample_batches",
    lambda: _stream_ctes() + sample_sql(STEPS, BATCH, SEED, WINDOW_T) + "\nSELECT * FROM batches",
)
def q_sample_batches(spark, sf_dir):
    st = _Stream(spark, sf_dir)
    starts = TK.sample_starts(spark, STEPS, BATCH, st.n, st.T, SEED)
    b = TK.sample_batches(st.windows, starts, st.T, PER_BLOCK)
    return b.select(
        "step", "sample", F.col("offset").cast("long"), F.col("input_id").cast("long"), F.col("target_id").cast("long")
    )


def _write_shards(spark, sf_dir):
    st = _Stream(spark, sf_dir)
    path = scratch_path(spark, "token-stream")
    TS.write_token_stream(st.windows, path, st.T, st.n)
    return path


@register(
    "write_token_stream",
    lambda: _stream_ctes()
    + _windows_sql(WINDOW_T)
    + f"""
SELECT window_id, window_id * {WINDOW_T} AS first_gpos,
       CAST(CASE WHEN (SELECT n FROM total) - window_id * {WINDOW_T} >= {WINDOW_T + 2} THEN {WINDOW_T}
            ELSE (SELECT n FROM total) - window_id * {WINDOW_T} END AS BIGINT) AS n,
       CAST(2 * CASE WHEN (SELECT n FROM total) - window_id * {WINDOW_T} >= {WINDOW_T + 2} THEN {WINDOW_T}
            ELSE (SELECT n FROM total) - window_id * {WINDOW_T} END AS BIGINT) AS n_bytes
FROM windows""",
)
def q_write_token_stream(spark, sf_dir):
    path = _write_shards(spark, sf_dir)
    df = spark.read.parquet(path)
    return df.select(
        F.col("window_id").cast("long"),
        F.col("first_gpos").cast("long"),
        F.col("n").cast("long"),
        F.length("data").cast("long").alias("n_bytes"),
    )


@register("read_token_stream", lambda: _stream_ctes() + "\nSELECT gpos, token_id FROM stream")
def q_read_token_stream(spark, sf_dir):
    path = _write_shards(spark, sf_dir)
    s = TS.read_token_stream(spark, path)
    return s.select(F.col("gpos").cast("long"), F.col("token_id").cast("long"))


@register("raw_token_stream", lambda: _stream_ctes() + "\nSELECT gpos, token_id FROM stream")
def q_raw_token_stream(spark, sf_dir):
    """The stream written as flat 16-bit files and read back by byte ranges."""
    path = scratch_path(spark, "raw-stream")
    RT.write_raw_stream(spark.read.parquet(_write_shards(spark, sf_dir)), path)
    return RT.read_raw_stream(spark, path).select("gpos", F.col("token_id").cast("long"))
