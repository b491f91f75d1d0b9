"""Corpus files: one text file, documents divided by a special token.

Spark's text source splits on a custom `lineSep`; its input splits end at a
separator, so every document is read whole by exactly one task, however the
file is cut (the byte-range chunking of the reference, done by the reader).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import END_OF_TEXT
from tokenloom.session import cut_lineage

# The well-formed UTF-8 byte sequences (Unicode, table 3-7) in hex.
_TAIL = "[89AB][0-9A-F]"
UTF8_CHARACTER = "|".join(
    [
        "[0-7][0-9A-F]",
        f"(?:C[2-9A-F]|D[0-9A-F]){_TAIL}",
        f"E0[AB][0-9A-F]{_TAIL}",
        f"E[1-9A-CEF]{_TAIL}{_TAIL}",
        f"ED[89][0-9A-F]{_TAIL}",
        f"F0[9AB][0-9A-F]{_TAIL}{_TAIL}",
        f"F[1-3]{_TAIL}{_TAIL}{_TAIL}",
        f"F48[0-9A-F]{_TAIL}{_TAIL}",
    ]
)


def read_delimited_corpus(
    spark: SparkSession, path: str, special: str = END_OF_TEXT, bad_bytes: str = "keep", with_ids: bool = False
) -> DataFrame:
    """(text) rows, one per document, cut at `special` (separator removed).
    `bad_bytes`: "keep" invalid UTF-8 as it is, "drop" it (as training does) or
    "replace" it.  `with_ids`: (doc_id, text), documents numbered from 0 in the
    order of the files' names and of the text, however the files are split."""
    rows = spark.read.option("lineSep", special).text(path)
    text = {"keep": lambda b: b.cast("string"), "drop": drop_bad_utf8, "replace": replace_bad_utf8}[bad_bytes]
    value = text(F.col("value").cast("binary")).alias("text")
    if not with_ids:
        return rows.select(value)
    # a split's rows come in order: its place in the file and a counter order them; kept, so that the counters stay
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    kept = cut_lineage(rows.select(*split, F.monotonically_increasing_id().alias("at"), value))
    splits = kept.groupBy("file", "start").agg(F.min("at").alias("first"), F.count("*").alias("n")).collect()
    # one row a split: bounded by the files' sizes over the split size
    bases, base = [], 0
    for r in sorted(splits, key=lambda r: (r.file, r.start)):
        bases.append((r.file, r.start, base - r.first))
        base += r.n
    shift = spark.createDataFrame(bases, "file string, start long, shift long")
    return kept.join(F.broadcast(shift), ["file", "start"]).select((F.col("at") + F.col("shift")).alias("doc_id"), "text")


def write_delimited_corpus(docs: DataFrame, path: str, special: str = END_OF_TEXT, text_col: str = "text") -> None:
    """Write texts separated by `special` (each part file ends with one)."""
    docs.select(F.col(text_col).alias("value")).write.mode("overwrite").option("lineSep", special).text(path)


def replace_bad_utf8(b: Column) -> Column:
    """Bytes -> text, invalid sequences become U+FFFD (decoding side)."""
    return F.make_valid_utf8(b.cast("string"))


def drop_bad_utf8(b: Column) -> Column:
    """Bytes -> text with invalid sequences dropped (training side), in the
    JVM.  Of rows that are not valid, the hex keeps its well-formed characters."""
    valid = F.regexp_replace(F.hex(b), F.lit(f"({UTF8_CHARACTER})|.."), F.lit("$1"))
    return F.when(F.is_valid_utf8(b.cast("string")), b.cast("string")).otherwise(F.unhex(valid).cast("string"))
