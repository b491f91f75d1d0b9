"""Registered queries for corpus files, byte decoding and tokenizer storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import bpe, codec
from tokenloom.plans import oracle_sql as O
from tokenloom.plans.registry import NUM_MERGES, SPECIALS, register, table, trained_tokenizer
from tokenloom.plans.tokenizer_queries import ENCODE_SQL, VOCAB_SQL, ids_frame
from tokenloom.session import scratch_path
from tokenloom.sources import corpus as C
from tokenloom.sources import tokenizer_io as TIO

KEEP_MERGES = 8  # the smaller vocabulary of `drop_unknown_ids`


@register("read_delimited_corpus", "SELECT text FROM documents")
def q_read_delimited_corpus(spark, sf_dir):
    path = scratch_path(spark, "corpus-text")
    C.write_delimited_corpus(table(spark, sf_dir, "documents"), path)
    return C.read_delimited_corpus(spark, path)


@register(
    "number_delimited_corpus",
    "SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS doc_id, text FROM documents",
)
def q_number_delimited_corpus(spark, sf_dir):
    """Documents written as text files in order, read back and numbered."""
    path = scratch_path(spark, "corpus-numbered")
    docs = table(spark, sf_dir, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    C.write_delimited_corpus(docs, path)
    return C.read_delimited_corpus(spark, path, with_ids=True)


CUT = 97  # bytes of a range of a text, cut without regard to characters


def _cut_bytes(spark, sf_dir):
    """(doc_id, part, b): every document's bytes in ranges of CUT."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("b"))
    starts = F.sequence(F.lit(0), F.floor((F.length("b") - 1) / CUT).cast("int"))
    parts = docs.where(F.length("b") > 0).select("doc_id", "b", F.explode(starts).alias("part"))
    return parts.select("doc_id", F.col("part").cast("long"), F.substring("b", F.col("part") * CUT + 1, F.lit(CUT)).alias("b"))


def _cut_sql(replacement: str) -> str:
    return f"""
WITH h AS (SELECT doc_id, hex(encode(text)) AS h FROM documents WHERE text <> ''),
parts AS (
  SELECT doc_id, h, unnest(generate_series(0, (length(h) // 2 - 1) // {CUT})) AS part FROM h
)
SELECT doc_id, part, {O.utf8_decode_sql(f"substr(h, part * {2 * CUT} + 1, {2 * CUT})", replacement)} AS text FROM parts"""


@register("replace_bad_utf8", lambda: _cut_sql(chr(0xFFFD)))
def q_replace_bad_utf8(spark, sf_dir):
    """Byte ranges of all documents as text; cut characters become U+FFFD."""
    return _cut_bytes(spark, sf_dir).select("doc_id", "part", C.replace_bad_utf8(F.col("b")).alias("text"))


@register("drop_bad_utf8", lambda: _cut_sql(""))
def q_drop_bad_utf8(spark, sf_dir):
    """Byte ranges of all documents as text; cut characters are dropped."""
    return _cut_bytes(spark, sf_dir).select("doc_id", "part", C.drop_bad_utf8(F.col("b")).alias("text"))


@register(
    "save_tokenizer",
    lambda: VOCAB_SQL()
    + f"""
SELECT 'merges' AS part, count(*) AS n FROM merges
UNION ALL SELECT 'specials', CAST({len(SPECIALS)} AS BIGINT)
UNION ALL SELECT 'vocab', count(*) FROM vocab""",
)
def q_save_tokenizer(spark, sf_dir):
    """Rows written per table: 256 + k + m vocabulary rows, m merges, k specials."""
    path = scratch_path(spark, "tokenizer")
    TIO.save_tokenizer(spark, trained_tokenizer(spark, sf_dir), path)
    parts = [spark.read.parquet(f"{path}/{p}").select(F.lit(p).alias("part")) for p in ("merges", "specials", "vocab")]
    df = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return df.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@register("load_tokenizer", lambda: VOCAB_SQL() + "\nSELECT token_id, token_hex, is_special FROM vocab")
def q_load_tokenizer(spark, sf_dir):
    path = scratch_path(spark, "tokenizer")
    TIO.save_tokenizer(spark, trained_tokenizer(spark, sf_dir), path)
    vocab, _ = TIO.load_tokenizer_frames(spark, path)
    return vocab.select(F.col("token_id").cast("long"), F.hex("token").alias("token_hex"), "is_special")


def _printable_sql() -> str:
    keep = " OR ".join(f"(b BETWEEN {lo} AND {hi})" for lo, hi in TIO.PRINTABLE_RANGES)
    return f"""
, b2c AS (
  SELECT b, CASE WHEN {keep} THEN chr(CAST(b AS INTEGER))
         ELSE chr(CAST(256 + row_number() OVER (PARTITION BY {keep} ORDER BY b) - 1 AS INTEGER)) END AS c
  FROM range(256) t(b)
)
, mside AS (
  SELECT rank, side, CAST(k AS BIGINT) AS k, CAST(('0x' || substr(h, 2 * k + 1, 2))::INTEGER AS BIGINT) AS b
  FROM (SELECT rank, 0 AS side, l AS h FROM merges UNION ALL SELECT rank, 1, r FROM merges) s,
       LATERAL (SELECT unnest(generate_series(0, length(h) // 2 - 1)) AS k)
)
, mprint AS (
  SELECT rank, side, string_agg(c, '' ORDER BY k) AS txt FROM mside JOIN b2c USING (b) GROUP BY rank, side
)"""


@register(
    "export_gpt2_tokenizer",
    lambda: O.with_(O.train_ctes(NUM_MERGES))
    + _printable_sql()
    + """
SELECT a.rank, a.txt || ' ' || b.txt AS line FROM mprint a JOIN mprint b ON a.rank = b.rank AND a.side = 0 AND b.side = 1""",
)
def q_export_gpt2_tokenizer(spark, sf_dir):
    tok = trained_tokenizer(spark, sf_dir)
    path = scratch_path(spark, "gpt2")
    TIO.export_gpt2_tokenizer(bpe.vocab_frame(spark, tok), bpe.merges_frame(spark, tok), path)
    txt = spark.read.text(f"{path}/merges.txt", wholetext=True)
    lines = txt.select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("rank", "line"))
    return lines.select(F.col("rank").cast("long"), "line")


@register("import_gpt2_tokenizer", lambda: VOCAB_SQL() + "\nSELECT token_id, token_hex FROM vocab")
def q_import_gpt2_tokenizer(spark, sf_dir):
    tok = trained_tokenizer(spark, sf_dir)
    path = scratch_path(spark, "gpt2")
    TIO.export_gpt2_tokenizer(bpe.vocab_frame(spark, tok), bpe.merges_frame(spark, tok), path)
    vocab, merges = TIO.import_gpt2_tokenizer(spark, path)
    return vocab.select(F.col("token_id").cast("long"), F.hex("token").alias("token_hex"))


@register(
    "drop_unknown_ids",
    lambda: ENCODE_SQL()
    + f"""
SELECT doc_id, CAST(ord AS BIGINT) AS pos, CAST(token_id AS BIGINT) AS token_id FROM doc_tokens
WHERE token_id < {256 + len(SPECIALS) + KEEP_MERGES}""",
)
def q_drop_unknown_ids(spark, sf_dir):
    """Ids of the full tokenizer checked against a smaller vocabulary (its
    first merges only): ids the smaller one does not know are dropped."""
    tok = trained_tokenizer(spark, sf_dir)
    small = bpe.Tokenizer.from_merges(tok.merges[:KEEP_MERGES], tok.specials)
    toks = codec.token_positions(ids_frame(spark, sf_dir))
    kept = codec.drop_unknown_ids(toks, bpe.vocab_frame(spark, small))
    return kept.select("doc_id", F.col("pos").cast("long"), F.col("token_id").cast("long"))
