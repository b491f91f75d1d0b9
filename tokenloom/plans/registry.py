"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the given tables (or data Spark derives from them) whole.
Parameters shared by all queries are fixed here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tokenloom.functions.text import END_OF_TEXT

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# shared parameters of the registered queries
SPECIALS = [END_OF_TEXT]
NUM_MERGES = 243  # learned merges (vocabulary 256 + 1 + 243 = 500)
BATCH_MERGES = 64  # merges guessed in the first round of the merge loop


def register(name: str, oracle: str | Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle() if callable(oracle) else oracle
        return fn

    return deco


def rnd(col, digits: int):
    """Rounded double with negative zero folded to zero (stable hashing)."""
    from pyspark.sql import functions as F

    return F.round(col, digits) + F.lit(0.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_TOKENIZERS: dict[tuple, object] = {}
_DERIVED: dict[tuple, object] = {}


def derived(spark: SparkSession, key: tuple, build):
    """A table Spark derives from the given tables once per application (the
    encoded corpus, its windows), materialized by the builder with a reliable
    checkpoint so later queries read it instead of recomputing it."""
    k = (spark.sparkContext.applicationId,) + tuple(key)
    if k not in _DERIVED:
        _DERIVED[k] = build()
    return _DERIVED[k]


def trained_tokenizer(spark: SparkSession, sf_dir: str):
    """The tokenizer learned from `documents` (cached per data folder)."""
    from tokenloom.operators.bpe import train_bpe

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), NUM_MERGES, tuple(SPECIALS))
    tok = _TOKENIZERS.get(key)
    if tok is None:
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        tok = train_bpe(docs, 256 + len(SPECIALS) + NUM_MERGES, SPECIALS, batch=BATCH_MERGES)
        _TOKENIZERS[key] = tok
    return tok
