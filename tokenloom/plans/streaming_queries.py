"""Registered streaming queries: the `documents` file is the stream source;
each query runs its stream to the end (availableNow) and returns the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.plans.registry import ORACLES, SPECIALS, register, table, trained_tokenizer
from tokenloom.session import ship_package, scratch_path
from tokenloom.streaming import corpus_streams as CS


def _source(spark, sf_dir):
    """The documents file as a file-stream source: a file source lists a
    folder or a glob, so the single file is named by a one-file glob."""
    path = f"{sf_dir.rstrip('/')}/documents.parque[t]"
    return path, table(spark, sf_dir, "documents").schema


@register("stream_encode")
def q_stream_encode(spark, sf_dir):
    ship_package(spark)
    src, schema = _source(spark, sf_dir)
    sink, ck = scratch_path(spark, "stream-encode"), scratch_path(spark, "stream-encode-ck")
    q = CS.stream_encode(spark, src, schema, trained_tokenizer(spark, sf_dir), sink, ck)
    q.awaitTermination()
    ids = spark.read.parquet(sink)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.array_join("ids", " ").alias("ids"))


@register("stream_word_frequencies")
def q_stream_word_frequencies(spark, sf_dir):
    src, schema = _source(spark, sf_dir)
    out, ck = scratch_path(spark, "stream-wf"), scratch_path(spark, "stream-wf-ck")
    q = CS.stream_word_frequencies(spark, src, schema, SPECIALS, out, ck)
    q.awaitTermination()
    return CS.read_word_frequencies(spark, out)


# the streams must equal their batch forms: same oracles
ORACLES["stream_encode"] = ORACLES["encode_corpus"]
ORACLES["stream_word_frequencies"] = ORACLES["word_frequencies"]
