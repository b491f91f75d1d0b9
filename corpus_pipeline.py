"""The corpus pipeline: raw documents -> packed training sequences.

Five stages, each one of the operators of `tokenloom.llm`; a stage's rows are
written as Parquet and read again as the next stage's documents:

1. quality classifier: documents predicted as label 0 go;
2. line dedup: lines similar to an earlier line go, documents stay;
3. SimHash near-dedup: of each component the row with the smallest doc_id stays
   (3-word shingles, at most 3 differing bits);
4. mixing: documents are repeated or dropped so that the sources meet their
   target weights; a document taken twice is two rows;
5. packing: the rows become pieces of sequences of at most 2,048 tokens.

All stages but the last return the columns of `documents`.  `n_chars` is
counted anew where line dedup shortens a text.  There is no SQL form: the
classifier, the fingerprints and the packing have none, so the pipeline is
tested against its operators' brute-force versions on small tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm.common import scratch_path, table
from tokenloom.llm.line_dedup import ANY_WORDS, dedup_lines
from tokenloom.llm.mixing import mixed
from tokenloom.llm.packing import pack
from tokenloom.llm.quality_knn import accepted
from tokenloom.llm.simhash import one_of_each

TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier predicts as label 1."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that repeat an earlier one."""
    return dedup_lines(docs, min_words=ANY_WORDS).drop("__removed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return one_of_each(docs, shingle=3, max_bits=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack(docs, public_tokenizers.path(TOKENIZER), ranks=public_tokenizers.path(RANKS))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between stages, tables in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        if i:
            path = scratch_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        docs = stage(spark, docs, sf_dir)
    return docs

