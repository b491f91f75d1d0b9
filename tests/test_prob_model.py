import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import model, prob, vectors


def long_form(spark, x):
    rows = [(i, j, float(v)) for i, r in enumerate(x) for j, v in enumerate(r)]
    return spark.createDataFrame(rows, "ctx_id long, token_id long, logit double")


def as_matrix(df, col, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.ctx_id, r.token_id] = r[col]
    return out


@pytest.mark.parametrize("shift", [0.0, 100.0])
def test_softmax_stable(spark, shift):
    x = np.random.default_rng(0).normal(size=(3, 5)) + shift
    got = as_matrix(prob.softmax(long_form(spark, x), "ctx_id"), "prob", x.shape)
    e = np.exp(x - x.max(axis=1, keepdims=True))
    assert np.allclose(got, e / e.sum(axis=1, keepdims=True), atol=1e-12)


@pytest.mark.parametrize("scale", [1.0, 1000.0])
def test_cross_entropy(spark, scale):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(8, 5)) * scale
    t = rng.integers(0, 5, size=8)
    targets = spark.createDataFrame([(i, int(v)) for i, v in enumerate(t)], "ctx_id long, target_id long")
    got = prob.cross_entropy(long_form(spark, x), targets).first().loss
    s = x - x.max(axis=1, keepdims=True)
    lp = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
    assert got == pytest.approx(-lp[np.arange(8), t].mean(), rel=1e-12)


def test_nucleus_keeps_mass_before_p(spark):
    p = np.array([[0.5, 0.3, 0.15, 0.05], [0.25, 0.25, 0.25, 0.25]])
    df = spark.createDataFrame(
        [(i, j, float(v)) for i, r in enumerate(p) for j, v in enumerate(r)], "ctx_id long, token_id long, prob double"
    )
    kept = {(r.ctx_id, r.token_id): r.prob for r in prob.nucleus_filter(df, 0.7).collect()}
    # row 0: before-mass 0, .5, .8 -> keep tokens 0, 1; row 1: 0, .25, .5, .75 -> keep 0..2
    assert set(kept) == {(0, 0), (0, 1), (1, 0), (1, 1), (1, 2)}
    assert kept[(0, 0)] == pytest.approx(0.625)
    assert kept[(1, 2)] == pytest.approx(1 / 3)


def test_sample_token_in_kept_set(spark):
    p = np.random.default_rng(2).dirichlet(np.ones(20), size=50)
    df = spark.createDataFrame(
        [(i, j, float(v)) for i, r in enumerate(p) for j, v in enumerate(r)], "ctx_id long, token_id long, prob double"
    )
    nuc = prob.nucleus_filter(df, 0.6)
    kept = {(r.ctx_id, r.token_id) for r in nuc.collect()}
    draws = prob.sample_token(nuc, prob.hashed_unit(F.lit(3), F.col("ctx_id"))).collect()
    assert len(draws) == 50 and all((r.ctx_id, r.token_id) in kept for r in draws)


def ref_lr(t, a_max, a_min, tw, tc):
    if t < tw:
        return t * a_max / tw
    if t <= tc:
        return a_min + 0.5 * (1 + math.cos((t - tw) / (tc - tw) * math.pi)) * (a_max - a_min)
    return a_min


def test_lr_schedule_25_steps(spark):
    steps = spark.range(25).withColumnRenamed("id", "step")
    got = [r.lr for r in prob.lr_schedule(steps, 1.0, 0.1, 7, 21).orderBy("step").collect()]
    assert got == pytest.approx([ref_lr(t, 1.0, 0.1, 7, 21) for t in range(25)], abs=1e-12)
    cfg = model.RunConfig(0, lr_max=1.0, lr_min=0.1, warmup=7, cycle=21)
    assert [cfg.lr(t) for t in range(25)] == pytest.approx(got, abs=1e-12)
    # warm-up equal to cycle: no division by zero
    assert cfg.__class__(0, 1.0, 0.1, 5, 5).lr(5) == pytest.approx(0.1)


def test_adamw_matches_numpy(spark):
    rng = np.random.default_rng(3)
    grads = [rng.normal(size=6) for _ in range(5)]
    cfg = model.RunConfig(0, lr_max=1e-2, weight_decay=0.01)
    w, m, v = np.zeros(6), np.zeros(6), np.zeros(6)
    params = model.init_params(spark, 1, [0]).withColumns({c: F.array_repeat(F.lit(0.0), 6) for c in "wmv"})
    for t, g in enumerate(grads, start=1):
        b1, b2 = cfg.betas
        m = b1 * m + (1 - b1) * g
        v = b2 * v + (1 - b2) * g * g
        alpha = cfg.lr_max * math.sqrt(1 - b2**t) / (1 - b1**t)
        w = (w - alpha * m / (np.sqrt(v) + cfg.eps)) * (1 - cfg.lr_max * cfg.weight_decay)
        params = model.adamw_step(params.withColumn("g", F.lit([float(x) for x in g])), {0: cfg}, {0: cfg.lr_max})
        params = spark.createDataFrame(params.collect(), params.schema)
    got = np.array(params.first().w)
    assert np.allclose(got, w, atol=1e-12)


def test_clip_factor():
    assert model.clip_factor(0.5, 1.0) == 1.0
    assert model.clip_factor(2.0, 1.0) == pytest.approx(1.0 / (2.0 + 1e-6))


def test_bigram_gradient_and_training_reduce_loss(spark):
    counts = spark.createDataFrame([(0, 1, 3), (0, 2, 1), (1, 0, 2), (2, 0, 2)], "prev_id int, next_id int, n long")
    params = model.init_params(spark, 3, [0])
    g = model.with_gradient(params, counts)
    assert "Window" not in g._jdf.queryExecution().executedPlan().toString()
    got = {(r.prev_id, r.next_id): r.g for r in model.long_form(g, "g").collect()}
    assert len(got) == 9 and model.count_parameters(params).first().n_params == 9
    assert got[(0, 1)] == pytest.approx((4 / 3 - 3) / 8)
    assert sum(got.values()) == pytest.approx(0.0, abs=1e-12)
    steps = counts.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(5))))
    res = model.train_model(params, steps, [model.RunConfig(0, lr_max=0.5, max_grad_norm=None)])
    losses = [m["loss"] for m in res.metrics]
    assert len(losses) == 6  # the steps that have counts
    assert losses[-1] < losses[0]


def test_rms_and_projection(spark):
    x = np.random.default_rng(4).normal(size=(4, 6))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, e array<double>")
    y = np.array([r.y for r in df.select("vec_id", vectors.rms_normalize(F.col("e"), eps=1e-5).alias("y")).orderBy("vec_id").collect()])
    assert np.allclose(y, x / np.sqrt((x * x).mean(axis=1, keepdims=True) + 1e-5))
    W = np.random.default_rng(5).normal(size=(3, 6))
    p = vectors.linear_projection(df, "e", W.tolist(), "y").orderBy("vec_id").collect()
    assert np.allclose(np.array([r.y for r in p]), x @ W.T)
    wl = spark.createDataFrame([(j, i, float(W[j, i])) for j in range(3) for i in range(6)], "j int, i int, w double")
    pj = vectors.linear_projection_join(df, "vec_id", "e", wl, "y").orderBy("vec_id").collect()
    assert np.allclose(np.array([r.y for r in pj]), x @ W.T)


def test_causal_attention_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(5, 4))
    df = spark.createDataFrame([(0, [float(v) for v in x.ravel()])], "id long, x array<double>")
    out = np.array(vectors.causal_attention(df, "x", "x", "x", 4).first().attn).reshape(5, 4)
    s = x @ x.T / 2.0
    s[np.triu_indices(5, 1)] = -np.inf
    p = np.exp(s - s.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    assert np.allclose(out, p @ x)


@pytest.mark.parametrize("causal", [True, False])
def test_attention_of_unequal_lengths(spark, causal):
    """12 queries and 16 keys of their own, large scores, blocks of any size."""
    rng = np.random.default_rng(9)
    data = {seq: (rng.normal(size=(nq, 4)) * 30, rng.normal(size=(nk, 4)), rng.normal(size=(nk, 3))) for seq, nq, nk in (("a", 12, 16), ("b", 5, 2), ("c", 1, 1))}
    qs = spark.createDataFrame([(s, i, x.tolist()) for s, (q, _, _) in data.items() for i, x in enumerate(q)], "seq string, pos long, q array<double>")
    ks = spark.createDataFrame([(s, i, k[i].tolist(), v[i].tolist()) for s, (_, k, v) in data.items() for i in range(len(k))], "seq string, pos long, k array<double>, v array<double>")
    for block in (1, 5, 64):
        got = {(r.seq, r.pos): r.attn for r in vectors.attention(qs, ks, causal, block).collect()}
        for s, (q, k, v) in data.items():
            z = q @ k.T / 2.0
            if causal:
                z[np.triu_indices(len(q), 1, len(k))] = -np.inf
            p = np.exp(z - z.max(axis=1, keepdims=True))
            assert np.allclose([got[s, i] for i in range(len(q))], p / p.sum(axis=1, keepdims=True) @ v)
    one = spark.createDataFrame([([float(x) for x in data["a"][0].ravel()], [float(x) for x in data["a"][1].ravel()])], "q array<double>, k array<double>")
    out = np.array(vectors.causal_attention(one, "q", "k", "k", 4).first().attn).reshape(12, 4)
    z = data["a"][0] @ data["a"][1].T / 2.0
    z[np.triu_indices(12, 1, 16)] = -np.inf
    p = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(out, p / p.sum(axis=1, keepdims=True) @ data["a"][1])


def test_ties_large_values_and_single_token(spark):
    rows = [(0, 0, 5.0), (0, 1, 5.0), (0, 2, 1.0), (1, 7, 1000.0), (2, 3, 1e3), (2, 4, 1e3 - 50)]
    df = spark.createDataFrame(rows, "ctx_id long, token_id long, logit double")
    p = {(r.ctx_id, r.token_id): r.prob for r in prob.softmax(df, "ctx_id").collect()}
    assert p[(1, 7)] == 1.0 and p[(0, 0)] == p[(0, 1)]
    assert p[(2, 3)] == pytest.approx(1.0) and p[(2, 4)] < 1e-20
    # equal probabilities: the smaller id ranks first, so top_p 0.3 keeps token 0 only
    nuc = {(r.ctx_id, r.token_id) for r in prob.nucleus_filter(prob.softmax(df, "ctx_id"), 0.3).collect()}
    assert (0, 0) in nuc and (0, 1) not in nuc and (1, 7) in nuc
    draws = {r.ctx_id: r.token_id for r in prob.sample_token(prob.softmax(df, "ctx_id"), F.lit(0.99)).collect()}
    assert draws[1] == 7


def test_run_throughput_between_records(spark):
    # records at steps 0, 1, 3 (one skipped); the first counts its own step
    ms = [
        {"run_id": 0, "step": 0, "loss": 1.0, "lr": 0.1, "grad_norm": 1.0, "tokens": 100, "seconds": 2.0, "ts": 10.0},
        {"run_id": 0, "step": 1, "loss": 1.0, "lr": 0.1, "grad_norm": 1.0, "tokens": 100, "seconds": 1.0, "ts": 11.0},
        {"run_id": 0, "step": 3, "loss": 1.0, "lr": 0.1, "grad_norm": 1.0, "tokens": 100, "seconds": 1.0, "ts": 15.0},
        {"run_id": 1, "step": 0, "loss": 1.0, "lr": 0.1, "grad_norm": 1.0, "tokens": 50, "seconds": 0.5, "ts": 10.0},
    ]
    out = {(r.run_id, r.step): r.tokens_per_sec for r in model.run_throughput(model.metrics_frame(spark, ms)).collect()}
    assert out == {(0, 0): 50.0, (0, 1): 100.0, (0, 3): 50.0, (1, 0): 100.0}
