"""Findings of round 4, on rows of their own."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_findings_r03 import _old_loop

from tokenloom.operators import bpe, codec, model, tokens
from tokenloom.session import cut_lineage


def _counting(folder):
    """A barrier context that leaves a file for every time the first task tells the others."""
    real = model.BarrierTaskContext

    class Counting:
        def __init__(self):
            self.ctx = real.get()
            self.partitionId = self.ctx.partitionId

        get = classmethod(lambda cls: cls())

        def allGather(self, x):
            import os
            import uuid

            if self.partitionId() == 0:
                open(os.path.join(folder, uuid.uuid4().hex), "w").close()
            return self.ctx.allGather(x)

    return Counting


@pytest.mark.parametrize("max_norm,told", [(None, 1), (0.32, 14)])
def test_tasks_tell_each_other_only_where_a_step_is_clipped(spark, tmp_path, monkeypatch, max_norm, told):
    """a telling takes a second, and every step had one."""
    rng, v, steps = np.random.default_rng(5), 6, 20
    counts = [(int(s), int(a), int(b), int(k)) for s in range(steps) if s != 7 for a, b, k in rng.integers(0, [v, v, 50], (12, 3))]
    df = spark.createDataFrame(counts, "step long, prev_id int, next_id int, n long")
    monkeypatch.setattr(model, "BarrierTaskContext", _counting(str(tmp_path)))
    cfgs = [model.RunConfig(0, lr_max=0.1, warmup=3, cycle=9, max_grad_norm=max_norm), model.RunConfig(2, lr_max=0.02, max_grad_norm=1.0)]
    seen = {}
    res = model.train_model(
        model.init_params(spark, v, [0, 2]), df, cfgs, checkpoint_every=3,
        on_checkpoint=lambda p, it: seen.update({(it, r.run_id, r.prev_id): r.w for r in p.collect()}),
    )
    assert len(list(tmp_path.iterdir())) <= told < steps
    for cfg in cfgs:
        w, logged = _old_loop(counts, v, cfg, steps)
        mine = [(m["step"], m["loss"], m["grad_norm"]) for m in res.metrics if m["run_id"] == cfg.run_id]
        assert np.allclose(mine, logged) and [m[0] for m in mine] == list(range(steps))
        if max_norm and cfg.run_id == 0:
            assert 0 < sum(x[2] >= max_norm for x in logged) < steps  # some are clipped, some not
        for it in (3, 6, 9, 12, 15, 18, 20):
            w, _ = _old_loop(counts, v, cfg, it)
            assert np.allclose([seen[it, cfg.run_id, i] for i in range(v)], w)


# ---------------------------------------------------- F2 to F9: an executor's memory
def _parts(spark, parts):
    """Documents (doc_id, ids) in the given partitions, each in the given order."""
    rows = [(p, at, i, [i % 7] * (i % 5)) for p, part in enumerate(parts) for at, i in enumerate(part)]
    df = spark.createDataFrame(rows, "p int, at int, doc_id long, ids array<int>")
    return cut_lineage(df.repartitionByRange(len(parts), "p").sortWithinPartitions("p", "at").select("doc_id", "ids"))


def _offsets(parts):
    docs = sorted(i for part in parts for i in part)
    return dict(zip(docs, itertools.accumulate((i % 5 + 1 for i in docs), initial=0)))


@pytest.mark.parametrize(
    "parts,stay",
    [
        ([[20, 21, 25], [0, 1, 9], [10, 12]], True),  # files, the larger first
        ([[40, 41, 20, 21, 0, 1], [30, 31, 9, 10]], True),  # several files a partition
        ([[20, 21, 0, 1, 40], [9, 30, 31]], False),  # two files read as one run, others between
        ([[0, 5, 9], [6, 20]], False),  # ranges that overlap
        ([[7, 6, 5, 4, 3, 2, 1, 0]], True),
        ([list(range(2 * tokens.MAX_RUNS, 0, -1))], False),
    ],
)
def test_documents_stay_where_runs_do_not_overlap(spark, monkeypatch, parts, stay):
    kept = _parts(spark, parts)
    monkeypatch.setattr(tokens, "cut_lineage", lambda df: moved.append(1) or cut_lineage(df))
    moved = []
    got = dict(map(tuple, tokens.doc_offsets(kept, stable=True).select("doc_id", "off").collect()))
    assert got == {k: v for k, v in _offsets(parts).items()}
    assert moved == ([] if stay else [1])
    stream = [tuple(r) for r in tokens.token_stream(kept, 9, stable=True).orderBy("gpos").collect()]
    flat = [x for i in sorted(got) for x in [i % 7] * (i % 5) + [9]][:-1]
    assert stream == list(enumerate(flat))


def test_runs_of_small_batches(spark):
    parts = [[30, 31, 32, 3, 4, 5, 6, 0], [10, 11, 12, 60, 61, 40, 41, 42]]
    kept, key = _parts(spark, parts), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    for size in (1, 2, 3):
        spark.conf.set(key, str(size))
        try:
            got = dict(map(tuple, tokens.doc_offsets(kept, stable=True).select("doc_id", "off").collect()))
            assert got == _offsets(parts)
            assert [r[:2] for r in tokens.run_totals(kept)] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
        finally:
            spark.conf.set(key, before)


def test_null_and_equal_ids_are_moved_as_before(spark):
    rows = [(None, [1]), (5, [3, 3]), (5, [2]), (1, [4]), (None, [0, 0])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1)
    got = [r.token_id for r in tokens.token_stream(df, 9).orderBy("gpos").collect()]
    assert got == [0, 0, 9, 1, 9, 4, 9, 2, 9, 3, 3]


def test_a_checkpoint_caches_nothing_and_sends_small_batches(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(int(b.nbytes > 12 << 20))
            yield b

    df = spark.range(0, 150, 1, 1).select("id", F.repeat(F.lit("x"), 200_000).alias("s")).mapInArrow(run, "id long, s string")

    def cached(*_):
        raise AssertionError("cached")

    monkeypatch.setattr(type(df), "persist", cached)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    kept = cut_lineage(df)
    assert kept.count() == 150 and seen.value == 0 and spark.conf.get(key) == before



def test_encoding_gives_a_few_documents_at_a_time():
    """Ids leave the worker by `ENCODE_ROWS` documents, not by Arrow batches."""
    import pyarrow as pa

    class Pieces:
        """A frame of one batch, which runs the map here."""

        schema = {"doc_id": T.StructField("doc_id", T.LongType())}

        def mapInArrow(self, run, schema):
            lists = [["ab"] * (i % 4) if i % 9 else None for i in range(1000)]
            return list(run([pa.record_batch([pa.array(range(1000)), pa.array(lists, pa.list_(pa.string()))], ["doc_id", "pieces"])]))

    class Sent:
        value = (bpe.init_vocab_dict([]) | {256: b"ab"}, [(b"a", b"b")], [])

    got = codec.encoded(Pieces(), Sent())
    assert max(b.num_rows for b in got) <= codec.ENCODE_ROWS
    whole = pa.Table.from_batches(got).to_pydict()
    assert whole["doc_id"] == list(range(1000))
    assert whole["ids"] == [[256] * (i % 4) if i % 9 else [] for i in range(1000)]


def test_driver_lists_need_no_python_workers(spark):
    """A list of Python rows starts a second set of Python workers, which stay."""
    tok = bpe.Tokenizer.from_merges([(b"a", b"b"), (b"ab", b"\x00\xff")], ["<|x|>"])
    metrics = [{"run_id": 1, "step": 2, "loss": 0.5, "lr": 1, "grad_norm": float("nan"), "tokens": 7, "seconds": 0.1, "ts": 3.0}]
    empty = bpe.Tokenizer({}, [])
    frames = [bpe.vocab_frame(spark, tok), bpe.merges_frame(spark, tok), model.metrics_frame(spark, metrics), bpe.vocab_frame(spark, empty), bpe.merges_frame(spark, empty), model.metrics_frame(spark, [])]
    for df in frames:
        assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()
    vocab, merges, logged, *none = [df.collect() for df in frames]
    assert [(r.token_id, bytes(r.token), r.is_special) for r in vocab] == [(i, b, i == 0) for i, b in sorted(tok.vocab.items())]
    assert [(r["rank"], bytes(r.left), bytes(r.right)) for r in merges] == [(0, b"a", b"b"), (1, b"ab", b"\x00\xff")]
    assert logged[0][:4] == (1, 2, 0.5, 1.0) and np.isnan(logged[0].grad_norm) and logged[0][5:] == (7, 0.1, 3.0)
    assert none == [[], [], []]
    kinds = [("token_id", "int"), ("token", "binary"), ("is_special", "boolean")]
    assert frames[0].dtypes == kinds == frames[3].dtypes
