"""Corpus -> pretokens -> piece frequencies.

Shapes:
  docs      (doc_id long, text string, ...)
  pretokens (doc_id long, pos int, piece string)
  freqs     (piece string, n long)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.session import spread


def training_pieces(docs: DataFrame, specials: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """Training-side pretokenizing: fold newlines, cut out specials, split.

    Map-only; one output row per piece occurrence: (doc_id, part, pos, piece),
    without doc_id if the documents have none.
    """
    specials = list(specials or [])
    ids = [c for c in ("doc_id",) if c in docs.columns]
    parts = spread(docs).select(
        *ids,
        F.posexplode(T.split_special_drop(T.normalize_newlines(text_col), specials)).alias("part", "chunk"),
    )
    return parts.select(
        *ids, "part", F.posexplode(T.pretokenize("chunk")).alias("pos", "piece")
    )


def pretokenize_docs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Plain pretokenizing of each text as is: (doc_id, pos, piece)."""
    return spread(docs).select("doc_id", F.posexplode(T.pretokenize(text_col)).alias("pos", "piece"))


def word_frequencies(docs: DataFrame, specials: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """Count equal pieces over the corpus: (piece, n).

    Hot pieces (' the') are pre-aggregated map-side (partial hash aggregate)
    before the shuffle, so a key holding a third of all rows costs one row
    per task in the exchange."""
    pieces = training_pieces(docs, specials, text_col)
    return pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))


def piece_bytes(freqs: DataFrame) -> DataFrame:
    """(piece, n) -> (piece, sym, n) with sym the bracketed hex bytes."""
    return freqs.select("piece", T.hex_symbols("piece").alias("sym"), "n")
