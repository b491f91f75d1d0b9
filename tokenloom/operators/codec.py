"""Corpus-level encoding and decoding.

Encoding is map-only: specials are cut and text is pretokenized by JVM regex
expressions, then one Arrow map turns each document's piece array into ids with
the broadcast tokenizer (bounded by the vocabulary size) and a bounded memo per
worker, so hot pieces are merged once per worker and only the distinct pieces of
a few documents are Python objects at a time.  No shuffle,
so a hot piece or a huge document never lands on one reducer.

Shapes:
  ids       (doc_id long, ids array<int>)
  tokens    (doc_id long, pos int, token_id int)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty
from pyspark.sql.window import Window

from tokenloom.functions import text as T
from tokenloom.functions.bpe_kernel import BpeKernel, kernel_for
from tokenloom.operators.bpe import Tokenizer
from tokenloom.session import bounded_broadcast, ship_package, spread

_BROADCASTS: dict[tuple[str, str], object] = {}


def broadcast_tokenizer(spark: SparkSession, tok: Tokenizer):
    """Broadcast the tokenizer once per application and content (a model
    artifact bounded by its vocabulary, never data-sized)."""
    key = (spark.sparkContext.applicationId, tok.digest())
    bc = _BROADCASTS.get(key)
    ship_package(spark)
    if bc is None:
        bc = spark.sparkContext.broadcast((dict(tok.vocab), list(tok.merges), list(tok.specials)))
        _BROADCASTS[key] = bc
    return bc


def pieces_for_encoding(text: str | Column, specials: list[str]) -> Column:
    """array<string>: specials kept whole, other parts pretokenized."""
    if not specials:
        return T.pretokenize(text)
    return _pieces_expr(T.split_special_keep(text, specials), specials)


def _pieces_expr(parts: Column, specials: list[str]) -> Column:
    pat = F.lit(T.JAVA_PRETOKEN_PATTERN)
    spec = F.array(*[F.lit(s) for s in specials])
    return F.flatten(
        F.transform(
            parts,
            lambda x: F.when(F.array_contains(spec, x), F.array(x)).otherwise(F.regexp_extract_all(x, pat, F.lit(0))),
        )
    )


#: Documents whose distinct pieces are Python objects at a time.
ENCODE_ROWS = 256


def _encoded(k: BpeKernel, pieces: pa.Array) -> pa.Array:
    """Ids of every list of pieces (null: none): a slice's distinct pieces are
    encoded once, and their ids taken for each occurrence."""
    found = pieces.flatten().dictionary_encode()
    each = pa.array([k.encode_piece(p) for p in found.dictionary.to_pylist()], pa.list_(pa.int32()))
    ids = each.take(found.indices)
    sizes = pc.list_value_length(pieces).fill_null(0).to_numpy().astype(np.int64)
    per_piece = np.r_[0, np.cumsum(pc.list_value_length(ids).to_numpy().astype(np.int64))]
    ends = per_piece[np.r_[0, np.cumsum(sizes)]]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids.flatten())


def encode_udf(bc):
    @F.arrow_udf(Ty.ArrayType(Ty.IntegerType()))
    def encode_batch(pieces: pa.Array) -> pa.Array:
        k = kernel_for(bc)
        parts = [_encoded(k, pieces.slice(at, ENCODE_ROWS)) for at in range(0, len(pieces), ENCODE_ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    # marked non-deterministic only so the optimizer never evaluates it twice
    # (a filter inferred from explode would otherwise be pushed below it)
    return encode_batch.asNondeterministic()


def encoded(pieces: DataFrame, bc) -> DataFrame:
    """(doc_id, pieces) -> (doc_id, ids), a few documents at a time: neither the
    JVM nor the worker holds the ids of a whole Arrow batch."""

    def run(batches):
        k = kernel_for(bc)
        for b in batches:
            for at in range(0, b.num_rows, ENCODE_ROWS):
                part = b.slice(at, ENCODE_ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), _encoded(k, part.column(1))], ["doc_id", "ids"])

    ids = Ty.StructField("ids", Ty.ArrayType(Ty.IntegerType()))
    return pieces.mapInArrow(run, Ty.StructType([pieces.schema["doc_id"], ids]))


def encode_corpus(docs: DataFrame, tok: Tokenizer, text_col: str = "text", normalize: bool = False) -> DataFrame:
    """Documents -> (doc_id, ids array<int>), ids in text order."""
    bc = broadcast_tokenizer(docs.sparkSession, tok)
    text = T.normalize_newlines(text_col) if normalize else F.col(text_col)
    return encoded(spread(docs, order="doc_id").select("doc_id", pieces_for_encoding(text, tok.specials).alias("pieces")), bc)


def encode_words(words: DataFrame, tok: Tokenizer, piece_col: str = "piece") -> DataFrame:
    """Distinct pieces -> ids: (piece, ids)."""
    bc = broadcast_tokenizer(words.sparkSession, tok)
    return words.select(piece_col, encode_udf(bc)(F.array(piece_col)).alias("ids"))


def token_positions(ids: DataFrame) -> DataFrame:
    """(doc_id, ids) -> (doc_id, pos, token_id), 0-based positions; map-only."""
    return ids.select("doc_id", F.posexplode("ids").alias("pos", "token_id"))


#: Ids of the longest vocabulary that decodes by lookup in one array.
MAX_LITERAL_IDS = 1 << 17


def decode_corpus(ids: DataFrame, tok: Tokenizer, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text), map-only and in the JVM: ids become
    their entries' hex by array lookup, joined before decoding, so a character
    split over tokens comes back whole; bad bytes become U+FFFD and unknown ids
    are skipped.  `keep` names further columns to carry along."""
    if not tok.vocab or not tok.merges:
        raise ValueError("tokenizer has no vocabulary or no merges")
    top = max(tok.vocab)
    if top >= MAX_LITERAL_IDS:
        raise ValueError(f"ids beyond {MAX_LITERAL_IDS} are not supported")
    # a constant that the optimizer folds into one array
    entries = F.split(F.lit(",".join(tok.vocab.get(i, b"").hex() for i in range(top + 1))), ",")
    known = F.filter(F.col(ids_col), lambda i: (i >= 0) & (i <= top))
    text = F.unhex(F.array_join(F.transform(known, lambda i: F.get(entries, i)), ""))
    return ids.select("doc_id", F.make_valid_utf8(text.cast("string")).alias("text"), *(keep or []))


def token_frequencies(ids: DataFrame) -> DataFrame:
    """(token_id, n): count of each id; partial aggregation before the shuffle."""
    return ids.select(F.explode("ids").alias("token_id")).groupBy("token_id").agg(F.count(F.lit(1)).alias("n"))


def corpus_stats(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Characters and tokens in total (one row)."""
    chars = docs.agg(F.sum(F.length("text")).alias("n_chars"), F.count(F.lit(1)).alias("n_docs"))
    toks = ids.agg(F.sum(F.size("ids")).alias("n_tokens"))
    return _one_row(chars, toks)


def _one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two one-row aggregates on a constant key (both sides are one row)."""
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k").drop("_k")


# ----------------------------------------------------------- vocab joins
def token_to_id(symbols: DataFrame, vocab: DataFrame, hex_col: str = "token_hex") -> DataFrame:
    """Symbol bytes (hex) -> id; equal bytes under two ids: the greatest id.
    The vocabulary side is broadcast after a size check (else shuffle join)."""
    inv = vocab.where(~F.col("is_special")).groupBy(F.hex("token").alias(hex_col)).agg(
        F.max("token_id").alias("token_id")
    )
    return symbols.join(bounded_broadcast(inv), hex_col, "left")


def id_to_token(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Id -> bytes; unknown ids are dropped (inner join), as decoding skips them."""
    return tokens.join(bounded_broadcast(vocab.select("token_id", "token")), "token_id", "inner")


def drop_unknown_ids(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    return tokens.join(bounded_broadcast(vocab.select("token_id")), "token_id", "left_semi")


def merge_rank_lookup(pairs: DataFrame, merges: DataFrame) -> DataFrame:
    """(l, r) hex pairs -> rank; unknown pairs keep a null rank.  A repeated
    pair keeps its later rank."""
    m = merges.groupBy(F.hex("left").alias("l"), F.hex("right").alias("r")).agg(F.max("rank").alias("rank"))
    return pairs.join(bounded_broadcast(m), ["l", "r"], "left")


def register_special_tokens(vocab: DataFrame, specials: list[str]) -> DataFrame:
    """Add specials missing from the vocabulary after the largest id, in the
    given order; present ones keep their id, repeated ones get one."""
    spark = vocab.sparkSession
    sdf = spark.createDataFrame(
        [(i, bytearray(s.encode("utf-8"))) for i, s in enumerate(dict.fromkeys(specials))], "ord int, token binary"
    )
    missing = sdf.join(vocab.select("token"), "token", "left_anti")
    top = vocab.agg(F.max("token_id").alias("top"))
    w = F.row_number().over(Window.orderBy("ord"))  # specials list: small, given by the caller
    added = _one_row(missing.withColumn("rn", w), top).select(
        (F.col("top") + F.col("rn")).cast("int").alias("token_id"), "token", F.lit(True).alias("is_special")
    )
    return vocab.unionByName(added)
