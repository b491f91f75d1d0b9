"""Tokenizer storage: parquet tables, and the public GPT-2 text exchange form.

Parquet form: `vocab(token_id, token binary, is_special)` and
`merges(rank, left binary, right binary)` under one folder.

GPT-2 form: a JSON object {printable token: id} and a merges text file with
one `left right` line per merge in rank order, bytes shown as printable
characters.  Both tables are bounded by the vocabulary size; the JSON object
is one row by definition of the format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.bpe import MERGES_SCHEMA, VOCAB_SCHEMA, Tokenizer, merges_frame, vocab_frame

# ---------------------------------------------------------------------------
# Fixed values (the public GPT-2 byte <-> character rule, must match exactly)
#
# Bytes 33..126, 161..172 and 174..255 stand for themselves (as code points);
# the other 68 bytes, in increasing order, stand for code points 256, 257, ...
# ---------------------------------------------------------------------------
PRINTABLE_RANGES = [(33, 126), (161, 172), (174, 255)]


def byte_to_char() -> list[str]:
    keep = {b for lo, hi in PRINTABLE_RANGES for b in range(lo, hi + 1)}
    out, extra = [], 0
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


def _byte_array(token: Column) -> Column:
    """binary -> array<int> of its bytes."""
    h = F.hex(token)
    return F.transform(F.sequence(F.lit(0), (F.length(h) / 2).cast("int") - 1), lambda k: F.conv(F.substring(h, k * 2 + 1, 2), 16, 10).cast("int"))


def printable(token: Column) -> Column:
    """binary token -> GPT-2 printable string (JVM, via a 256-entry array)."""
    table = F.array(*[F.lit(c) for c in byte_to_char()])
    return F.array_join(F.transform(_byte_array(token), lambda b: F.element_at(table, b + 1)), "")


def from_printable(s: Column) -> Column:
    """GPT-2 printable string -> binary; a character that stands for no byte raises."""
    chars = byte_to_char()
    m = F.create_map(*[x for b, c in enumerate(chars) for x in (F.lit(c), F.lit(f"{b:02X}"))])
    byte = lambda c: F.coalesce(
        F.try_element_at(m, c), F.raise_error(F.concat(F.lit("stands for no byte: "), c)).cast("string")
    )
    chars_of = F.filter(F.split(s, ""), lambda c: c != "")
    return F.unhex(F.array_join(F.transform(chars_of, byte), ""))


# ------------------------------------------------------------- parquet form
def save_tokenizer(spark: SparkSession, tok: Tokenizer, path: str) -> None:
    vocab_frame(spark, tok).write.mode("overwrite").parquet(f"{path}/vocab")
    merges_frame(spark, tok).write.mode("overwrite").parquet(f"{path}/merges")
    spark.createDataFrame([(i, s) for i, s in enumerate(tok.specials)], "ord int, special string").write.mode(
        "overwrite"
    ).parquet(f"{path}/specials")


def load_tokenizer_frames(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab"),
        spark.read.schema(MERGES_SCHEMA).parquet(f"{path}/merges"),
    )


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    """Vocabulary and merges back into a (driver-sized) Tokenizer."""
    vocab, merges = load_tokenizer_frames(spark, path)
    v = {int(r["token_id"]): bytes(r["token"]) for r in vocab.collect()}
    m = [(bytes(r["left"]), bytes(r["right"])) for r in merges.orderBy("rank").collect()]
    specials = [r["special"] for r in spark.read.parquet(f"{path}/specials").orderBy("ord").collect()]
    return Tokenizer(v, m, specials)


# --------------------------------------------------------------- GPT-2 form
def export_gpt2_tokenizer(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    """vocab.json (one JSON object) and merges.txt (rank order).  Equal bytes
    under several ids: the greatest id."""
    ids = vocab.groupBy(printable(F.col("token")).alias("k")).agg(F.max("token_id").alias("v"))
    entries = ids.select(F.struct("k", "v").alias("e"))
    obj = entries.agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value"))
    obj.coalesce(1).write.mode("overwrite").text(f"{path}/vocab.json")
    lines = merges.select("rank", F.concat_ws(" ", printable(F.col("left")), printable(F.col("right"))).alias("value"))
    lines.orderBy("rank").select("value").coalesce(1).write.mode("overwrite").text(f"{path}/merges.txt")


def import_gpt2_tokenizer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """-> vocab (token_id, token), merges (rank, left, right).  Merge lines
    are split at the one blank; a leading `#version` line is skipped."""
    js = spark.read.text(f"{path}/vocab.json", wholetext=True)
    vocab = js.select(F.explode(F.from_json("value", "map<string,int>")).alias("k", "token_id")).select(
        "token_id", from_printable(F.col("k")).alias("token")
    )
    txt = spark.read.text(f"{path}/merges.txt", wholetext=True)
    body = F.regexp_replace("value", "\n$", "")
    body = F.when(body.startswith("#version"), F.regexp_replace(body, "^[^\n]*\n?", "")).otherwise(body)
    lines = txt.select(F.posexplode(F.split(body, "\n")).alias("rank", "line")).where(F.length("line") > 0)
    parts = lines.select("rank", F.split("line", " ").alias("p"))
    merges = parts.select(
        F.col("rank").cast("int"),
        from_printable(F.col("p")[0]).alias("left"),
        from_printable(F.col("p")[1]).alias("right"),
    )
    return vocab, merges
