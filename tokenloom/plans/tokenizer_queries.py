"""Registered queries for corpus splitting, pretokenizing, BPE learning and
the codec, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.operators import bpe, codec, pretoken
from tokenloom.plans import oracle_sql as O
from tokenloom.plans.registry import NUM_MERGES, SPECIALS, derived, register, table, trained_tokenizer
from tokenloom.session import cut_lineage

PAD = "<|pad|>"


def framed_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns framed with special tokens, one row per turn:
    `<|endoftext|>role: text<|endoftext|><|endoftext|>` (single, double and
    adjacent specials)."""
    conv = table(spark, sf_dir, "conversations")
    return conv.select(
        "conv_id",
        "turn",
        F.concat(F.lit(T.END_OF_TEXT), F.col("role"), F.lit(": "), F.col("text"), F.lit(T.END_OF_TEXT * 2)).alias(
            "text"
        ),
    )


FRAMED_SQL = f"""framed AS (
  SELECT conv_id, turn, {O.q(T.END_OF_TEXT)} || role || ': ' || text || {O.q(T.END_OF_TEXT * 2)} AS text
  FROM conversations
)"""


# ------------------------------------------------------------ corpus level
@register(
    "normalize_newlines",
    "SELECT doc_id, regexp_replace(text, '\\r\\n?', chr(10), 'g') AS text FROM documents",
)
def q_normalize_newlines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_newlines("text").alias("text"))


@register(
    "split_special_drop",
    lambda: O.with_(FRAMED_SQL)
    + f"""
SELECT conv_id, turn, CAST(unnest(generate_series(0, len(string_split(text, {O.q(T.END_OF_TEXT)})) - 1)) AS BIGINT) AS part,
       unnest(string_split(text, {O.q(T.END_OF_TEXT)})) AS chunk
FROM framed""",
)
def q_split_special_drop(spark, sf_dir):
    return framed_turns(spark, sf_dir).select(
        "conv_id", "turn", F.posexplode(T.split_special_drop("text", SPECIALS)).alias("part", "chunk")
    ).select("conv_id", "turn", F.col("part").cast("long"), "chunk")


@register(
    "split_special_keep",
    lambda: O.with_(
        FRAMED_SQL,
        f"""marked AS (
  SELECT conv_id, turn, string_split(regexp_replace(text, {O.q(O.SPECIAL_RE * 2 + '|' + O.SPECIAL_RE)}, chr(2) || '\\0' || chr(2), 'g'), chr(2)) AS parts
  FROM framed
)""",
        """flat AS (
  SELECT conv_id, turn, unnest(generate_series(1, len(parts))) AS i, unnest(parts) AS piece FROM marked
)""",
    )
    + f"""
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) - 1 AS BIGINT) AS part, piece,
       piece IN ({O.q(T.END_OF_TEXT)}, {O.q(T.END_OF_TEXT * 2)}) AS is_special
FROM flat WHERE piece <> ''""",
)
def q_split_special_keep(spark, sf_dir):
    specials = [T.END_OF_TEXT, T.END_OF_TEXT * 2]
    parts = framed_turns(spark, sf_dir).select(
        "conv_id", "turn", F.posexplode(T.split_special_keep("text", specials)).alias("part", "piece")
    )
    return parts.select(
        "conv_id",
        "turn",
        F.col("part").cast("long"),
        "piece",
        F.col("piece").isin(specials).alias("is_special"),
    )


@register(
    "pretokenize",
    lambda: O.with_(O.encode_pieces_cte()) + "\nSELECT doc_id, CAST(pos AS BIGINT) AS pos, piece FROM ep_pieces",
)
def q_pretokenize(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pretoken.pretokenize_docs(docs).select("doc_id", F.col("pos").cast("long"), "piece")


@register("word_frequencies", lambda: O.with_(O.freqs_cte()) + "\nSELECT piece, n FROM freqs")
def q_word_frequencies(spark, sf_dir):
    return pretoken.word_frequencies(table(spark, sf_dir, "documents"), SPECIALS)


@register(
    "piece_bytes",
    lambda: O.with_(O.freqs_cte()) + f"\nSELECT piece, {O.hex_sym('piece')} AS sym, n FROM freqs",
)
def q_piece_bytes(spark, sf_dir):
    return pretoken.piece_bytes(pretoken.word_frequencies(table(spark, sf_dir, "documents"), SPECIALS))


def _words(spark, sf_dir):
    return bpe.words_table(pretoken.word_frequencies(table(spark, sf_dir, "documents"), SPECIALS))


@register("pair_counts", lambda: O.with_(O.train_ctes(0)) + "\nSELECT l, r, c FROM (" + O.pairs_sql("w0") + ")")
def q_pair_counts(spark, sf_dir):
    return bpe.pair_counts(_words(spark, sf_dir))


@register("best_pair", lambda: O.with_(O.train_ctes(1)) + "\nSELECT c, l, r FROM m1")
def q_best_pair(spark, sf_dir):
    return bpe.best_pair(bpe.pair_counts(_words(spark, sf_dir)))


@register(
    "top_pairs",
    lambda: O.with_(O.train_ctes(0))
    + "\nSELECT c, l, r FROM ("
    + O.pairs_sql("w0")
    + ") ORDER BY c DESC, l DESC, r DESC LIMIT 20",
)
def q_top_pairs(spark, sf_dir):
    return bpe.top_pairs(bpe.pair_counts(_words(spark, sf_dir)), 20)


@register("apply_merge", lambda: O.with_(O.train_ctes(1)) + "\nSELECT sym, n FROM w1 WHERE instr(sym, '><') > 0")
def q_apply_merge(spark, sf_dir):
    words = _words(spark, sf_dir)
    best = bpe.best_pair(bpe.pair_counts(words)).collect()  # one row
    return bpe.apply_merge(words, [(best[0]["l"], best[0]["r"])]) if best else words


@register(
    "train_bpe",
    lambda: O.with_(O.train_ctes(NUM_MERGES))
    + "\nSELECT rank, l AS left_hex, r AS right_hex, c AS pair_count FROM merges",
)
def q_train_bpe(spark, sf_dir):
    tok = trained_tokenizer(spark, sf_dir)
    rows = [(i, a.hex().upper(), b.hex().upper(), int(c)) for i, ((a, b), c) in enumerate(zip(tok.merges, tok.merge_counts))]
    return spark.createDataFrame(rows, "rank long, left_hex string, right_hex string, pair_count long")


def _vocab_df(spark, sf_dir) -> DataFrame:
    return bpe.vocab_frame(spark, trained_tokenizer(spark, sf_dir))


VOCAB_SQL = lambda: O.with_(O.train_ctes(NUM_MERGES), O.vocab_cte())


@register(
    "init_vocab",
    lambda: O.with_(O.train_ctes(0))
    + f"""
SELECT CAST(0 AS BIGINT) AS token_id, hex(encode({O.q(T.END_OF_TEXT)})) AS token_hex, CAST(0 AS BIGINT) AS n
UNION ALL
SELECT CAST(1 + b AS BIGINT), v.h, CAST(coalesce(sum(s.n), 0) AS BIGINT)
FROM (SELECT b, upper(lpad(to_hex(b), 2, '0')) AS h FROM range(256) t(b)) v
LEFT JOIN (SELECT unnest(string_split(substr(sym, 2, length(sym) - 2), '><')) AS h, n FROM w0 WHERE sym <> '') s ON s.h = v.h
GROUP BY b, v.h""",
)
def q_init_vocab(spark, sf_dir):
    """The vocabulary before any merge, with each byte's occurrences in the corpus."""
    vocab = bpe.vocab_frame(spark, bpe.Tokenizer.from_merges([], SPECIALS))
    words = pretoken.piece_bytes(pretoken.word_frequencies(table(spark, sf_dir, "documents"), SPECIALS))
    used = words.select(F.explode(T.symbol_array("sym")).alias("token_hex"), "n").groupBy("token_hex").agg(F.sum("n").alias("n"))
    out = vocab.select(F.col("token_id").cast("long"), F.hex("token").alias("token_hex"), "is_special")
    n = F.when(F.col("is_special"), F.lit(0)).otherwise(F.coalesce("n", F.lit(0))).cast("long")
    return out.join(used, "token_hex", "left").select("token_id", "token_hex", n.alias("n"))


@register("extend_vocab", lambda: VOCAB_SQL() + "\nSELECT token_id, token_hex, is_special FROM vocab")
def q_extend_vocab(spark, sf_dir):
    tok = trained_tokenizer(spark, sf_dir)
    init = bpe.vocab_frame(spark, bpe.Tokenizer.from_merges([], SPECIALS))
    vocab = bpe.extend_vocab(init, bpe.merges_frame(spark, tok), len(SPECIALS))
    return vocab.select(F.col("token_id").cast("long"), F.hex("token").alias("token_hex"), "is_special")


@register(
    "longest_token",
    lambda: VOCAB_SQL()
    + "\nSELECT token_id, CAST(length(token_hex) / 2 AS BIGINT) AS length, token_hex FROM vocab "
    + "ORDER BY length(token_hex) DESC, token_id ASC LIMIT 1",
)
def q_longest_token(spark, sf_dir):
    lt = bpe.longest_token(_vocab_df(spark, sf_dir))
    return lt.select(F.col("token_id").cast("long"), F.col("length").cast("long"), F.hex("token").alias("token_hex"))


@register(
    "register_special_tokens",
    lambda: VOCAB_SQL()
    + f"""
SELECT token_id, token_hex, is_special FROM vocab
UNION ALL SELECT (SELECT max(token_id) + 1 FROM vocab), hex(encode({O.q(PAD)})), true""",
)
def q_register_special_tokens(spark, sf_dir):
    v = bpe.vocab_frame(spark, trained_tokenizer(spark, sf_dir))
    out = codec.register_special_tokens(v, [T.END_OF_TEXT, PAD])
    return out.select(F.col("token_id").cast("long"), F.hex("token").alias("token_hex"), "is_special")


# ------------------------------------------------------------------ codec
def ids_frame(spark, sf_dir) -> DataFrame:
    """The encoded corpus (doc_id, ids), written once per application."""
    return derived(
        spark,
        ("ids", sf_dir.rstrip("/")),
        lambda: cut_lineage(codec.encode_corpus(table(spark, sf_dir, "documents"), trained_tokenizer(spark, sf_dir))),
    )


def ENCODE_SQL(more: str = "", ctes: str = "") -> str:  # noqa: N802
    """Training and encoding of `documents`; `more`: SQL of further pieces to
    encode, over the CTEs `ctes`."""
    pieces = "SELECT piece FROM ep_pieces" + (f" UNION ALL {more}" if more else "")
    return O.with_(
        O.encode_pieces_cte(), ctes, O.train_ctes(NUM_MERGES, pieces), O.vocab_cte(), O.encode_ctes(NUM_MERGES), O.doc_tokens_cte()
    )


@register(
    "encode_words",
    lambda: O.with_(O.train_ctes(NUM_MERGES), O.vocab_cte(), O.encode_ctes(NUM_MERGES))
    + "\nSELECT piece, string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY k) AS ids FROM enc_piece_ids GROUP BY piece",
)
def q_encode_words(spark, sf_dir):
    words = pretoken.word_frequencies(table(spark, sf_dir, "documents"), SPECIALS).select("piece")
    enc = codec.encode_words(words, trained_tokenizer(spark, sf_dir))
    return enc.select("piece", F.array_join("ids", " ").alias("ids"))


@register(
    "encode_corpus",
    lambda: ENCODE_SQL()
    + """
SELECT d.doc_id, CAST(count(t.token_id) AS BIGINT) AS n_tokens,
       coalesce(string_agg(CAST(t.token_id AS VARCHAR), ' ' ORDER BY t.ord), '') AS ids
FROM documents d LEFT JOIN doc_tokens t USING (doc_id) GROUP BY d.doc_id""",
)
def q_encode_corpus(spark, sf_dir):
    ids = ids_frame(spark, sf_dir)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.array_join("ids", " ").alias("ids"))


@register("decode_corpus", "SELECT doc_id, text FROM documents")
def q_decode_corpus(spark, sf_dir):
    return codec.decode_corpus(ids_frame(spark, sf_dir), trained_tokenizer(spark, sf_dir))


@register(
    "token_positions",
    lambda: ENCODE_SQL() + "\nSELECT doc_id, CAST(ord AS BIGINT) AS pos, CAST(token_id AS BIGINT) AS token_id FROM doc_tokens",
)
def q_token_positions(spark, sf_dir):
    t = codec.token_positions(ids_frame(spark, sf_dir))
    return t.select("doc_id", F.col("pos").cast("long"), F.col("token_id").cast("long"))


@register(
    "token_frequencies",
    lambda: ENCODE_SQL() + "\nSELECT CAST(token_id AS BIGINT) AS token_id, count(*) AS n FROM doc_tokens GROUP BY token_id",
)
def q_token_frequencies(spark, sf_dir):
    f = codec.token_frequencies(ids_frame(spark, sf_dir))
    return f.select(F.col("token_id").cast("long"), "n")


@register(
    "corpus_stats",
    lambda: ENCODE_SQL()
    + """
SELECT (SELECT CAST(sum(length(text)) AS BIGINT) FROM documents) AS n_chars,
       (SELECT count(*) FROM documents) AS n_docs,
       (SELECT count(*) FROM doc_tokens) AS n_tokens""",
)
def q_corpus_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return codec.corpus_stats(docs, ids_frame(spark, sf_dir)).select(
        F.col("n_chars").cast("long"), "n_docs", F.col("n_tokens").cast("long")
    )


@register(
    "id_to_token",
    lambda: ENCODE_SQL()
    + """
SELECT CAST(t.token_id AS BIGINT) AS token_id, v.token_hex, count(*) AS n
FROM doc_tokens t JOIN vocab v ON v.token_id = t.token_id GROUP BY t.token_id, v.token_hex""",
)
def q_id_to_token(spark, sf_dir):
    freq = codec.token_frequencies(ids_frame(spark, sf_dir))
    out = codec.id_to_token(freq, _vocab_df(spark, sf_dir))
    return out.select(F.col("token_id").cast("long"), F.hex("token").alias("token_hex"), "n")


@register(
    "token_to_id",
    lambda: O.with_(O.train_ctes(NUM_MERGES), O.vocab_cte())
    + f"""
, syms AS (
  SELECT DISTINCT unnest(string_split(substr(sym, 2, length(sym) - 2), '><')) AS token_hex FROM w{NUM_MERGES}
)
SELECT s.token_hex, CAST(max(v.token_id) AS BIGINT) AS token_id
FROM syms s LEFT JOIN vocab v ON v.token_hex = s.token_hex AND NOT v.is_special GROUP BY s.token_hex""",
)
def q_token_to_id(spark, sf_dir):
    tok = trained_tokenizer(spark, sf_dir)
    words = pretoken.piece_bytes(pretoken.word_frequencies(table(spark, sf_dir, "documents"), SPECIALS)).where("sym <> ''")
    words = bpe.walked(words, [(a.hex().upper(), b.hex().upper()) for a, b in tok.merges])
    syms = words.select(F.explode(T.symbol_array("sym")).alias("token_hex")).distinct()
    out = codec.token_to_id(syms, _vocab_df(spark, sf_dir))
    return out.select("token_hex", F.col("token_id").cast("long"))


@register(
    "merge_rank_lookup",
    lambda: O.with_(O.train_ctes(NUM_MERGES))
    + "\nSELECT p.l, p.r, p.c, coalesce(m.rank, -1) AS rank FROM ("
    + O.pairs_sql("w0")
    + ") p LEFT JOIN merges m ON m.l = p.l AND m.r = p.r",
)
def q_merge_rank_lookup(spark, sf_dir):
    pairs = bpe.pair_counts(_words(spark, sf_dir))
    merges = bpe.merges_frame(spark, trained_tokenizer(spark, sf_dir))
    out = codec.merge_rank_lookup(pairs, merges)
    return out.select("l", "r", "c", F.coalesce(F.col("rank").cast("long"), F.lit(-1).cast("long")).alias("rank"))
