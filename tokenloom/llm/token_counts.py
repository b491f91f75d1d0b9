"""Operator 1, token counts: pieces are counted once per distinct pre-token.

A pre-token is a run of bytes between the separators space and 9 to 13.  The
operator is for tokenizers that drop white space, as files of the word kind do:
their own splitting and normalizing never reach across white space, so the
pieces of a text are those of its pre-tokens, special strings included.

`token_counts` never materialises ids.  It learns the corpus' pre-tokens with
their frequencies (a map-side count, then one aggregation), counts the pieces
of each distinct pre-token once with the tokenizer library, and joins the
counts to the per-document pre-token frequencies.  The join is split by
frequency: pre-tokens at or above a threshold, chosen from the histogram of
frequencies so that at most HEAD_ROWS pass it, travel as a broadcast map; the
others are joined by a shuffle, in which no key can be hot, because every
pre-token left there is rarer than the threshold.

Defined results: a null text counts as empty and an empty text has 0 tokens;
every input row gives one row, repeated rows and null ids included; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import kept, rows_of, slices, written

#: Most pre-tokens sent to every worker; those of more bytes travel as their MD5.
HEAD_ROWS = 1 << 17
HEAD_BYTES = 64
#: Distinct pre-tokens a task counts before it passes them on.
FLUSH = 1 << 19

def tokenizer(path: str):
    """One per worker process and file."""

    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return t

    return kept(("token counts", path), make)


def n_pieces(path: str, texts: list[str]) -> list[int]:
    return [len(e) for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (pretoken, n), summed over as much of the partition as FLUSH allows."""
    total: Counter = Counter()

    def out():
        names = pa.array(total.keys(), pa.binary())
        return pa.RecordBatch.from_arrays([names, pa.array(total.values(), pa.int64())], ["pretoken", "n"])

    for batch in slices(batches):
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            total.update(text.split())
            if len(total) > FLUSH:
                yield out()
                total.clear()
    if total:
        yield out()


def pretoken_pieces(docs: DataFrame, path: str) -> DataFrame:
    """(pretoken, n, pieces): corpus frequency and piece count of each distinct pre-token."""
    texts = rows_of(docs, "text")
    counts = texts.mapInArrow(_frequencies, "pretoken binary, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))

    def pieces(batches):
        for b in batches:
            got = n_pieces(path, b.column(0).cast(pa.string()).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.int32())], ["pretoken", "n", "pieces"])

    return counts.mapInArrow(pieces, "pretoken binary, n long, pieces int")


def _head_threshold(pieces: DataFrame, most: int) -> int:
    """Smallest frequency that at most `most` pre-tokens reach: from the number
    of pre-tokens per eighth of an octave of frequency (under 600 classes)."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    rows = pieces.groupBy(step.alias("k")).agg(F.count("*").alias("c"), F.min("n").alias("n")).collect()
    threshold, total = 1 << 62, 0
    for r in sorted(rows, key=lambda r: -r["k"]):
        total += r["c"]
        if total > most:
            break
        threshold = r["n"]
    return threshold


def token_counts(docs: DataFrame, path: str, head_rows: int = HEAD_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of `docs`."""
    spark = docs.sparkSession
    rows = rows_of(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    pieces = written(pretoken_pieces(docs, path), "pretoken_pieces")
    in_head = F.col("n") >= _head_threshold(pieces, head_rows)
    short = F.when(F.length("pretoken") <= HEAD_BYTES, F.col("pretoken")).otherwise(F.unhex(F.md5("pretoken")))
    head = spark.sparkContext.broadcast(
        {bytes(r[0]): r[1] for r in pieces.where(in_head).select(short, "pieces").collect()}
    )

    def split(batches):
        known = head.value
        for b in slices(batches, 1024):
            row, doc_id = b.column(0).to_pylist(), b.column(1).to_pylist()
            n_bytes, n_known, owner, names, counts = [], [], [], [], []
            for r, text in zip(row, b.column(2).cast(pa.binary()).to_pylist()):
                total = 0
                for name, n in Counter(text.split()).items():
                    k = known.get(name if len(name) <= HEAD_BYTES else hashlib.md5(name).digest())
                    if k is None:
                        owner.append(r)
                        names.append(name)
                        counts.append(n)
                    else:
                        total += k * n
                n_bytes.append(len(text))
                n_known.append(total)
            none = [None] * len(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + owner, pa.int64()), pa.array(doc_id + none, pa.int64()), pa.array(n_bytes + none, pa.int64()),
                    pa.array(n_known + counts, pa.int64()), pa.array([None] * len(row) + names, pa.binary()),
                ],
                ["row", "doc_id", "n_bytes", "n", "pretoken"],
            )

    parts = rows.mapInArrow(split, "row long, doc_id long, n_bytes long, n long, pretoken binary")
    rare = pieces.where(~in_head).select(F.col("pretoken").alias("p"), "pieces")
    # a document's own row has no pre-token: its key is its number after a space, so those rows spread and match nothing
    key = F.coalesce(F.col("pretoken"), F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary"))
    joined = parts.withColumn("key", key).join(rare, F.col("key") == F.col("p"), "left")
    tokens = F.when(F.col("pretoken").isNull(), F.col("n")).otherwise(F.col("n") * F.col("pieces"))
    return (
        joined.groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens")
    )
