"""Findings of round 3, on rows of their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import bpe, codec, model, tokens, vectors


def _old_loop(counts, v, cfg, steps):
    """The training loop in plain NumPy, a step at a time."""
    w, m, s, out = np.zeros((v, v)), np.zeros((v, v)), np.zeros((v, v)), []
    for step in range(steps):
        n = np.zeros((v, v))
        for st, a, b, k in counts:
            if st == step:
                n[a, b] += k
        total = n.sum() or 1.0
        lp = w - np.log(np.exp(w).sum(axis=1, keepdims=True))
        g = (n.sum(axis=1, keepdims=True) * np.exp(lp) - n) / total
        norm = float(np.sqrt((g * g).sum()))
        out.append((step, float(-(n * lp).sum() / total), norm))
        g = g * model.clip_factor(norm, cfg.max_grad_norm)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        alpha = cfg.lr(step) * np.sqrt(1 - 0.999 ** (step + 1)) / (1 - 0.9 ** (step + 1))
        w = (w - alpha * m / (np.sqrt(s) + cfg.eps)) * (1 - cfg.lr(step) * cfg.weight_decay)
    return w, out


def test_training_needs_few_jobs_and_equals_the_loop(spark, tmp_path):
    rng, v, steps = np.random.default_rng(1), 6, 9
    counts = [(int(s), int(a), int(b), int(k)) for s in range(steps) if s != 4 for a, b, k in rng.integers(0, [v, v, 50], (12, 3))]
    df = spark.createDataFrame(counts, "step long, prev_id int, next_id int, n long")
    cfgs = [model.RunConfig(0, lr_max=0.3, max_grad_norm=0.05), model.RunConfig(3, lr_max=0.01, warmup=2, cycle=6)]
    seen, path = [], str(tmp_path / "ckpt")

    def save(p):
        seen.append(sorted(r[0] for r in p.select("iteration").distinct().collect()))
        model.save_checkpoints(p, path)

    res = model.train_model(model.init_params(spark, v, [0, 3]), df, cfgs, checkpoint_every=2, on_checkpoints=save, per_job=5)
    assert seen == [[2, 4], [6, 8, 9]]  # two jobs for nine steps
    got = {(r.run_id, r.prev_id): r.w for r in res.params.collect()}
    for cfg in cfgs:
        w, logged = _old_loop(counts, v, cfg, steps)
        assert np.allclose([got[cfg.run_id, i] for i in range(v)], w)
        mine = [(m["step"], m["loss"], m["grad_norm"]) for m in res.metrics if m["run_id"] == cfg.run_id]
        assert np.allclose(mine, logged)
    back, it = model.load_checkpoint(spark, path)
    assert it == 9 and {(r.run_id, r.prev_id): r.w for r in back.collect()} == got


def test_training_with_tasks_that_hold_no_context(spark):
    df = spark.createDataFrame([(0, 0, 1, 3), (1, 1, 0, 2)], "step long, prev_id int, next_id int, n long")
    res = model.train_model(model.init_params(spark, 2, [0]), df, [model.RunConfig(0)])
    assert res.params.count() == 2 and len(res.metrics) == 2


def test_epoch_counts_of_uneven_windows(spark):
    rows = [(w, [int(x) for x in np.random.default_rng(w).integers(0, 4, 1 + w % 5)]) for w in range(40)]
    got = {tuple(r) for r in model.epoch_counts(spark.createDataFrame(rows, "window_id long, ids array<int>"), 7).collect()}
    want = {}
    for w, ids in rows:
        for a, b in zip(ids, ids[1:]):
            want[w // 7, a, b] = want.get((w // 7, a, b), 0) + 1
    assert got == {(*k, n) for k, n in want.items()}


def test_merges_send_a_bounded_head_to_the_driver(spark):
    words = spark.range(4000).selectExpr("concat('<41><', hex(1000 + id), '>') AS sym", "id + 1 AS n").repartition(8)
    head = bpe._head(words, 1000)
    assert 0 < len(head) <= 1000
    assert [n for _, n in head] == list(range(4000, 4000 - len(head), -1))


def test_memo_is_small_and_encoding_equal(spark):
    from tokenloom.functions import bpe_kernel

    tok = bpe.Tokenizer.from_merges([(b"a", b"b"), (b"ab", b"ab"), (b" ", b"ab")], ["<|endoftext|>"])
    k = bpe_kernel.BpeKernel(tok.vocab, tok.merges, tok.specials)
    for i in range(bpe_kernel.MEMO_PIECES + 5):
        k.encode_piece(str(i))
    k.encode_piece("ab" * 5000)
    assert len(k.memo) <= bpe_kernel.MEMO_PIECES <= 1 << 17 and "ab" * 5000 not in k.memo
    texts = ["", "abab ab x", "<|endoftext|>abab<|endoftext|>", "é ab\n\nabc " * 40] * 150
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(map(tuple, codec.encode_corpus(docs, tok).collect()))
    pieces = docs.select("doc_id", codec.pieces_for_encoding("text", tok.specials).alias("p")).collect()
    assert got == {r.doc_id: k.encode_pieces(r.p) for r in pieces}


def test_packed_ids_are_checked(spark):
    from tokenloom.sources import token_stream

    df = spark.createDataFrame([([1, 65535, 256],), ([],), (None,), ([7],)], "ids array<int>").coalesce(1)
    got = [r[0] and bytes(r[0]) for r in df.select(token_stream.pack_u16(F.col("ids"))).collect()]
    assert got == [b"\x01\x00\xff\xff\x00\x01", b"", None, b"\x07\x00"]
    bad = spark.createDataFrame([([1, 65536],)], "ids array<int>").select(token_stream.pack_u16(F.col("ids")))
    with pytest.raises(Exception, match="out of uint16 range"):
        bad.collect()


def test_lookup_carries_what_a_vector_gives_once(spark):
    emb = spark.createDataFrame([(0, [1.0, 2.0], 3.0), (1, [4.0, 5.0], 9.0), (9, [0.0, 0.0], 0.0)], "vec_id long, embedding array<double>, s double")
    toks, ids = spark.createDataFrame([(1,), (0,), (1,)], "token_id int"), spark.createDataFrame([(0,), (1,), (2,)], "token_id int")
    got = vectors.embedding_lookup(toks, emb, vocab_ids=ids, carry=["s"]).select("token_id", "s").collect()
    assert sorted(map(tuple, got)) == [(0, 3.0), (1, 9.0), (1, 9.0)]
    with pytest.raises(Exception, match="no vector for id"):
        vectors.embedding_lookup(toks.selectExpr("token_id + 1 AS token_id"), emb, vocab_ids=ids, carry=["s"]).select("s").collect()


def test_attention_in_parts_equals_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ATTEND_VALUES", 40)
    mat = np.random.default_rng(3).normal(size=(6, 4))
    bc = spark.sparkContext.broadcast(mat)
    seqs = [[0, 1, 2], [], [5], [3, 3, 1], [2, 4, 0, 1], [1, 1, 1]]
    df = spark.createDataFrame(list(enumerate(seqs)), "window_id int, ids array<int>")
    for project in (None, [1.0] * 4):
        got = dict(map(tuple, vectors.causal_self_attention_ids(df, "ids", bc, project).select("window_id", "attn").collect()))
        for i, q in enumerate(seqs):
            want = vectors._attend_batch(mat[[q]])[0] if q else np.zeros((0, 4))
            assert np.allclose(got[i], want.ravel() if project is None else want.sum(axis=1))


def test_weight_of_a_pair_follows_one_rule():
    from tokenloom.llm import dom

    def row(n, end):
        return dom.parse("<div>" + "<p><b>x</b><i>y</i></p>" * n + f"<p>{end}</p></div>").children[0]

    # every more equal child adds the same to the weight, from small trees to large ones
    w = [dom._weight(dom.measured(row(n, "a")), dom.measured(row(n, "b"))) for n in range(1, 30)]
    assert {b - a for a, b in zip(w, w[1:])} == {w[1] - w[0]}
