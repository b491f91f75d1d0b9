"""Operator 7, quality classifier: nearest-neighbour voting in a latent-semantic space.

Every text becomes one vector: hashed words (log frequency times inverse
document frequency), and hashed word shapes ("Aa", "a%", "A!", "|", an immediate
repetition) as square roots of their shares.  A truncated singular value
decomposition of a bounded sample of labelled texts (at most SAMPLE per label,
those of smallest hash) gives LATENT directions.  The sample's latent vectors
travel to every worker; each document is compared with all of them by exact
cosine products, a block at a time, and its NEIGHBOURS nearest vote with their
labels, weighted by a power of the similarity.

Only the fitting uses a sample; scoring covers every whole text.  Labels, ids,
languages and sources never enter a vector.

Defined results: null texts count as empty; an empty text, and any text if no
labels are given, gets the share of label 1 among the learnable labels (0.5
without labels); repeated labels of a document count by their mean; null labels
and null ids are never learned from; one row per input row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import kept, rows_of, slices
from tokenloom.session import ship_package

WORDS, SHAPES = 1536, 512
#: Labelled texts per label that the space is fitted on and that vote.
SAMPLE = 1536
LATENT = 48
NEIGHBOURS = 24
POWER = 8
SHAPE_WEIGHT = 1.5
BLOCK = 256
#: Words remembered by a worker.
MEMO = 1 << 17

_RUNS = [(re.compile(p), r) for p, r in ((r"[^\W\d_A-ZÀ-ÖØ-Þ]+", "a"), (r"[A-ZÀ-ÖØ-Þ]+", "A"), (r"\d+", "0"), (r"([^aA0])\1+", r"\1"))]


def _buckets(word: str, memo: dict[str, tuple[int, int]]) -> tuple[int, int]:
    got = memo.get(word)
    if got is None:
        shape = word
        for pattern, to in _RUNS:
            shape = pattern.sub(to, shape)
        core = word.lower().strip(".,;:!?\"'()")
        got = (
            zlib.crc32(core.encode("utf-8", "replace")) % WORDS,
            WORDS + zlib.crc32(shape.encode("utf-8", "replace")) % (SHAPES - 1),
        )
        if len(memo) < MEMO:
            memo[word] = got
    return got


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(word counts, shape part of unit length) of the whole text."""
    words = text.split()
    x = np.zeros(WORDS, dtype=np.float32)
    s = np.zeros(SHAPES, dtype=np.float32)
    if words:
        freq = Counter(words)
        memo = kept(("quality",), dict)
        at = np.array([_buckets(w, memo) for w in freq], dtype=np.int64)
        n = np.fromiter(freq.values(), dtype=np.float64, count=len(freq))
        x[:] = np.bincount(at[:, 0], weights=n, minlength=WORDS)
        s[:] = np.bincount(at[:, 1] - WORDS, weights=n, minlength=SHAPES)
        s[SHAPES - 1] = sum(map(eq, words, words[1:]))
        s = np.sqrt(s / s.sum())
    return x, s


def _matrix(texts: list[str], idf: np.ndarray) -> np.ndarray:
    parts = [features(t) for t in texts]
    x = np.log1p(np.stack([p[0] for p in parts])) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return np.hstack([x, SHAPE_WEIGHT * np.stack([p[1] for p in parts])]).astype(np.float32)


def _unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def _decompose(x: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    rank = min(rank, *x.shape)
    q = np.random.default_rng(7).standard_normal((x.shape[1], rank + 8)).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T)[:, :rank].astype(np.float32)


class Model:
    """Inverse document frequencies, latent directions, the voters and their labels."""

    def __init__(self, texts: list[str], labels: np.ndarray, share: float):
        self.share = share
        self.voters = None
        if not texts:
            return
        seen = np.stack([features(t)[0] > 0 for t in texts]).sum(axis=0)
        self.idf = (np.log((1 + len(texts)) / (1 + seen)) + 0.1).astype(np.float32)
        x = _matrix(texts, self.idf)
        self.v = _decompose(x, LATENT)
        self.voters = _unit(x @ self.v)
        self.labels = labels.astype(np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if self.voters is None:
            return out
        k = min(NEIGHBOURS, len(self.voters))
        for at in range(0, len(texts), BLOCK):
            block = texts[at : at + BLOCK]
            z = _unit(_matrix(block, self.idf) @ self.v)
            cos = z @ self.voters.T
            near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(cos, near, axis=1), 0).astype(np.float64) ** POWER
            total = w.sum(axis=1)
            vote = (w * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            known = (total > 1e-9) & np.array([bool(t.strip()) for t in block])
            out[at : at + len(block)] = np.where(known, vote, self.share)
        return np.clip(out, 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of `label` from the learnable rows; at most `sample` texts of each label reach the driver."""
    known = labels.select(labels["doc_id"].alias("id"), labels[label].alias("y")).where("id is not null and y is not null")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    rows = []
    for y in (0, 1):
        chosen = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample)
        ids = F.broadcast(chosen)  # at most `sample` rows
        texts = rows_of(docs, "doc_id", "text").join(ids, F.col("doc_id") == F.col("id"))
        # repeated ids: one text each, the smallest by hash
        one = texts.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
        rows += [(r.id, r.text, y) for r in one.select("id", "t.text").collect()]
    rows.sort(key=lambda r: r[0])
    return Model([r[1] for r in rows], np.array([r[2] for r in rows]), share)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of `docs`."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    texts = rows_of(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches):
            got = np.round(m.scores(b.column(1).to_pylist()), 9)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], ["doc_id", "score"])

    return texts.mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`."""
    out = scored(docs, fit(docs, labels, label))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """The rows of `docs`, all columns unchanged, that the classifier predicts as 1."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(fit(docs, labels, label))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t or "" for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(sent.value.scores(texts) >= 0.5))

    ship_package(spark)
    return docs.mapInArrow(run, docs.schema)
