"""Registered queries for the table model: gradient, clipping, AdamW,
evaluation, training loop, sweep, checkpoints, metrics and generation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.operators import codec, generate, model
from tokenloom.operators import tokens as TK
from tokenloom.plans.registry import NUM_MERGES, SPECIALS, register, rnd, table, trained_tokenizer
from tokenloom.plans.stream_queries import (
    EOT_ID, _PAIRS_SQL, _Stream, _stream_ctes,
)
from tokenloom.functions.text import END_OF_TEXT
from tokenloom.plans.tokenizer_queries import VOCAB_SQL
from tokenloom.session import scratch_path

V = 256 + len(SPECIALS) + NUM_MERGES
LR, WD, MAX_NORM = 1e-3, 0.01, 1e-3
STEP_WINDOWS = 16384  # windows of one training step; the steps of an epoch follow from the data
SQL_STEPS = 3  # steps that the SQL unrolls, at least an epoch of the checked table
CYCLE = 4
SWEEP_LRS = [1e-2, 3e-3, 1e-3]
GEN_MAX_NEW, GEN_TEMP, GEN_TOP_P, GEN_SEED = 12, 0.8, 0.95, 5


def _corpus_counts(st):
    return TK.bigram_counts(TK.next_token_pairs(st.windows, st.T))


def _zero_grads(spark, sf_dir):
    return model.with_gradient(model.init_params(spark, V, [0]), _corpus_counts(_Stream(spark, sf_dir)))


GRAD_SQL = lambda: (
    _stream_ctes()
    + _PAIRS_SQL
    + f"""
, cnt AS (SELECT input_id AS prev_id, target_id AS next_id, count(*) AS n FROM pairs GROUP BY ALL)
, tot AS (SELECT sum(n) AS n_all FROM cnt)
, nprev AS (SELECT prev_id, sum(n) AS n_prev FROM cnt GROUP BY prev_id)
, grad AS (
  SELECT CAST(p.k AS BIGINT) AS prev_id, CAST(r.k AS BIGINT) AS next_id,
         (coalesce(np.n_prev, 0) * (1.0 / {V}) - coalesce(c.n, 0)) / (SELECT n_all FROM tot) AS g
  FROM range({V}) p(k) CROSS JOIN range({V}) r(k) LEFT JOIN nprev np ON np.prev_id = p.k
  LEFT JOIN cnt c ON c.prev_id = p.k AND c.next_id = r.k
)"""
)


@register(
    "count_parameters",
    lambda: VOCAB_SQL() + "\nSELECT CAST(0 AS INTEGER) AS run_id, CAST(count(*) * count(*) AS BIGINT) AS n_params FROM vocab",
)
def q_count_parameters(spark, sf_dir):
    size = len(trained_tokenizer(spark, sf_dir).vocab)
    return model.count_parameters(model.init_params(spark, size, [0]))


@register("model_gradient", lambda: GRAD_SQL() + "\nSELECT prev_id, next_id, 0.0 + round(g, 10) AS g FROM grad")
def q_model_gradient(spark, sf_dir):
    g = model.long_form(_zero_grads(spark, sf_dir), "g")
    return g.select(F.col("prev_id").cast("long"), F.col("next_id").cast("long"), rnd(F.col("g"), 10).alias("g"))


@register(
    "gradient_norm",
    lambda: GRAD_SQL() + "\nSELECT CAST(0 AS INTEGER) AS run_id, 0.0 + round(sqrt(sum(g * g)), 10) AS norm FROM grad",
)
def q_gradient_norm(spark, sf_dir):
    n = model.gradient_norm(_zero_grads(spark, sf_dir))
    return n.select("run_id", rnd(F.col("norm"), 10).alias("norm"))


CLIP_SQL = lambda: (
    GRAD_SQL()
    + f"""
, nrm AS (SELECT sqrt(sum(g * g)) AS norm FROM grad)
, clipped AS (
  SELECT prev_id, next_id,
         CASE WHEN (SELECT norm FROM nrm) >= {MAX_NORM} THEN g * ({MAX_NORM} / ((SELECT norm FROM nrm) + 1e-6)) ELSE g END AS g
  FROM grad
)"""
)


def _clipped(spark, sf_dir):
    g = _zero_grads(spark, sf_dir)
    norm = model.loss_and_norm(g)[0][1]
    return g, model.clip_factor(norm, MAX_NORM)


@register("clip_gradients", lambda: CLIP_SQL() + "\nSELECT prev_id, next_id, 0.0 + round(g * 1e6, 7) AS g_e6 FROM clipped")
def q_clip_gradients(spark, sf_dir):
    g, factor = _clipped(spark, sf_dir)
    c = model.long_form(model.clip_gradients(g, {0: factor}), "g")
    return c.select(F.col("prev_id").cast("long"), F.col("next_id").cast("long"), rnd(F.col("g") * 1e6, 7).alias("g_e6"))


@register(
    "adamw_step",
    lambda: CLIP_SQL()
    + f"""
, st AS (SELECT prev_id, next_id, 0.1 * g AS m, 0.001 * g * g AS v FROM clipped)
SELECT prev_id, next_id,
       0.0 + round(1e6 * (0.0 - {LR} * sqrt(1 - 0.999) / (1 - 0.9) * m / (sqrt(v) + 1e-8)) * (1 - {LR} * {WD}), 4) AS w_e6,
       0.0 + round(m * 1e6, 7) AS m_e6, 0.0 + round(v * 1e12, 7) AS v_e12, 1 AS t
FROM st""",
)
def q_adamw_step(spark, sf_dir):
    g, factor = _clipped(spark, sf_dir)
    cfg = {0: model.RunConfig(0, lr_max=LR, weight_decay=WD, max_grad_norm=MAX_NORM)}
    p = model.long_form(model.adamw_step(g, cfg, {0: LR}, {0: factor}), "w", "m", "v")
    return p.select(
        F.col("prev_id").cast("long"), F.col("next_id").cast("long"),
        rnd(F.col("w") * 1e6, 4).alias("w_e6"), rnd(F.col("m") * 1e6, 7).alias("m_e6"),
        rnd(F.col("v") * 1e12, 7).alias("v_e12"), F.lit(1).alias("t"),
    )


@register(
    "evaluate",
    lambda: _stream_ctes()
    + _PAIRS_SQL
    + f"""
, cnt AS (SELECT input_id AS prev_id, target_id AS next_id, count(*) AS n FROM pairs GROUP BY ALL)
, rows_of AS (SELECT prev_id, sum(n + 1) + {V} - count(*) AS mass FROM cnt GROUP BY prev_id)
SELECT CAST(0 AS INTEGER) AS run_id, 0.0 + round(-sum(c.n * (ln(c.n + 1) - ln(r.mass))) / sum(c.n), 6) AS eval_loss,
       CAST(sum(c.n) AS BIGINT) AS n_pairs
FROM cnt c JOIN rows_of r USING (prev_id)""",
)
def q_evaluate(spark, sf_dir):
    """The count model's loss over every pair of the corpus."""
    counts = _corpus_counts(_Stream(spark, sf_dir))
    ev = model.evaluate(model.smoothed_params(counts, V), counts)
    return ev.select("run_id", rnd(F.col("eval_loss"), 6).alias("eval_loss"), "n_pairs")


def _train(spark, sf_dir, configs, on_checkpoints=None, checkpoint_every=4):
    st = _Stream(spark, sf_dir)
    params = model.init_params(spark, V, [c.run_id for c in configs])
    counts = model.epoch_counts(st.windows, STEP_WINDOWS)
    return model.train_model(params, counts, configs, checkpoint_every=checkpoint_every, on_checkpoints=on_checkpoints)


TRAIN_LR, TRAIN_WARMUP = 0.5, 1


def _train_sql(configs: list | None = None, output: str = "metrics", extra: str = "") -> str:
    """The training loop unrolled in DuckDB, one chain of CTEs per run: per
    step the counts of its windows, log-softmax rows, gradient, loss and norm,
    clipping, then AdamW with the same schedule.  A step after the epoch's end
    has no counts: it changes nothing and reports nothing."""
    steps = SQL_STEPS
    configs = configs or [model.RunConfig(0, lr_max=TRAIN_LR, warmup=TRAIN_WARMUP, cycle=CYCLE, max_grad_norm=1.0)]
    parts = [
        _stream_ctes()
        + _PAIRS_SQL
        + f"""
, bc AS MATERIALIZED (
  SELECT gpos // {STEP_WINDOWS * 32} AS step, input_id AS prev_id, target_id AS next_id, CAST(count(*) AS DOUBLE) AS n
  FROM pairs GROUP BY ALL
)
, bt AS MATERIALIZED (SELECT step, sum(n) AS n_total FROM bc GROUP BY step)
, p_init AS MATERIALIZED (
  SELECT CAST(p.k AS BIGINT) AS prev_id, CAST(q.k AS BIGINT) AS next_id, 0.0::DOUBLE AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v
  FROM range({V}) p(k) CROSS JOIN range({V}) q(k)
)"""
    ]
    mets = []
    for cfg in configs:
        r = cfg.run_id
        b1, b2 = cfg.betas
        clip = "1.0" if cfg.max_grad_norm is None else (
            f"CASE WHEN norm >= {cfg.max_grad_norm} THEN {cfg.max_grad_norm} / (norm + 1e-6) ELSE 1.0 END"
        )
        prev = "p_init"
        for st in range(steps):
            lr = cfg.lr(st)
            t = st + 1
            alpha = f"({lr!r} * sqrt(1 - pow({b2}, {t})) / (1 - pow({b1}, {t})))"
            decay = f"(1 - {lr!r} * {cfg.weight_decay})" if cfg.weight_decay > 0 else "1.0"
            x = f"r{r}s{st}"
            parts.append(
                f"""
, g_{x} AS (
  SELECT p.prev_id, p.next_id, p.w, p.m, p.v, coalesce(c.n, 0.0) AS n,
         p.w - max(p.w) OVER (PARTITION BY p.prev_id) AS sh
  FROM {prev} p LEFT JOIN bc c ON c.step = {st} AND c.prev_id = p.prev_id AND c.next_id = p.next_id
)
, h_{x} AS MATERIALIZED (
  SELECT *, sh - ln(sum(exp(sh)) OVER (PARTITION BY prev_id)) AS lp, sum(n) OVER (PARTITION BY prev_id) AS n_prev
  FROM g_{x}
)
, k_{x} AS MATERIALIZED (
  SELECT *, (n_prev * exp(lp) - n) / (SELECT n_total FROM bt WHERE step = {st}) AS g FROM h_{x}
)
, met_{x} AS MATERIALIZED (
  SELECT CAST({r} AS INTEGER) AS run_id, CAST({st} AS BIGINT) AS step,
         -sum(n * lp) / (SELECT n_total FROM bt WHERE step = {st}) AS loss, sqrt(sum(g * g)) AS norm, {lr!r} AS lr,
         (SELECT CAST(n_total AS BIGINT) FROM bt WHERE step = {st}) AS tokens
  FROM k_{x}
)
, c_{x} AS (
  SELECT prev_id, next_id, w, {b1} * m + (1 - {b1}) * g * f AS m1, {b2} * v + (1 - {b2}) * (g * f) * (g * f) AS v1
  FROM k_{x}, (SELECT {clip} AS f FROM met_{x})
)
, p_{x} AS MATERIALIZED (
  SELECT prev_id, next_id, (w - {alpha} * m1 / (sqrt(v1) + {cfg.eps})) * {decay} AS w, m1 AS m, v1 AS v
  FROM c_{x} WHERE EXISTS (SELECT 1 FROM bt WHERE step = {st})
  UNION ALL SELECT prev_id, next_id, w, m, v FROM {prev} WHERE NOT EXISTS (SELECT 1 FROM bt WHERE step = {st})
)"""
            )
            mets.append(f"SELECT * FROM met_{x}")
            prev = f"p_{x}"
    if output == "params":  # the state after the last step of the (first) run
        parts.append(f"""
SELECT CAST({configs[0].run_id} AS INTEGER) AS run_id, prev_id, next_id, 0.0 + round(w, 6) AS w,
       0.0 + round(m * 1e6, 3) AS m_e6, 0.0 + round(v * 1e12, 3) AS v_e12,
       (SELECT CAST(count(*) AS INTEGER) FROM bt) AS t, (SELECT CAST(count(*) AS INTEGER) FROM bt) AS iteration
FROM {prev}""")
    else:
        parts.append(f"""
SELECT run_id, step, 0.0 + round(loss, 6) AS loss, 0.0 + round(lr, 9) AS lr, 0.0 + round(norm, 9) AS grad_norm{extra}
FROM ({" UNION ALL ".join(mets)}) WHERE tokens IS NOT NULL""")
    return "".join(parts)


@register("train_model", lambda: _train_sql())
def q_train_model(spark, sf_dir):
    cfg = [model.RunConfig(0, lr_max=TRAIN_LR, warmup=TRAIN_WARMUP, cycle=CYCLE, max_grad_norm=1.0)]
    res = _train(spark, sf_dir, cfg)
    m = model.metrics_frame(spark, res.metrics)
    return m.select(
        "run_id", "step", rnd(F.col("loss"), 6).alias("loss"), rnd(F.col("lr"), 9).alias("lr"),
        rnd(F.col("grad_norm"), 9).alias("grad_norm"),
    )


def _sweep_configs():
    return model.lr_sweep_configs(SWEEP_LRS, warmup=1, cycle=CYCLE)


@register("lr_sweep", lambda: _train_sql(_sweep_configs()))
def q_lr_sweep(spark, sf_dir):
    res = _train(spark, sf_dir, _sweep_configs())
    m = model.metrics_frame(spark, res.metrics)
    return m.select(
        "run_id", "step", rnd(F.col("loss"), 6).alias("loss"), rnd(F.col("lr"), 9).alias("lr"),
        rnd(F.col("grad_norm"), 9).alias("grad_norm"),
    )



def _ckpt_configs():
    return [model.RunConfig(0, lr_max=0.5)]


def _train_with_checkpoints(spark, sf_dir):
    path = scratch_path(spark, "model-ckpt")
    _train(
        spark, sf_dir, _ckpt_configs(), on_checkpoints=lambda p: model.save_checkpoints(p, path), checkpoint_every=1,
    )
    return path


@register(
    "save_checkpoint",
    lambda: _stream_ctes()
    + f"""
, steps AS (SELECT CAST(CASE WHEN n < 2 THEN 0 ELSE ((n - 2) // 32) // {STEP_WINDOWS} + 1 END AS INTEGER) AS k FROM total)
SELECT CAST(i AS INTEGER) AS iteration, CAST({V * V} AS BIGINT) AS n_params FROM steps, range(1, steps.k + 1) t(i)""",
)
def q_save_checkpoint(spark, sf_dir):
    """Parameters written per saved iteration (every step)."""
    path = _train_with_checkpoints(spark, sf_dir)
    df = spark.read.parquet(path).groupBy("iteration").agg(F.sum(F.size("w")).cast("long").alias("n_params"))
    return df.select(F.col("iteration").cast("int"), "n_params")


@register("load_checkpoint", lambda: _train_sql(_ckpt_configs(), "params"))
def q_load_checkpoint(spark, sf_dir):
    """The latest checkpoint read back: parameters and AdamW state after the epoch."""
    path = _train_with_checkpoints(spark, sf_dir)
    params, it = model.load_checkpoint(spark, path)
    steps = params.select("run_id", "prev_id", "t")
    params = model.long_form(params, "w", "m", "v").join(steps, ["run_id", "prev_id"])
    return params.select(
        F.col("run_id").cast("int"), F.col("prev_id").cast("long"), F.col("next_id").cast("long"),
        rnd(F.col("w"), 6).alias("w"), rnd(F.col("m") * 1e6, 3).alias("m_e6"), rnd(F.col("v") * 1e12, 3).alias("v_e12"),
        F.col("t").cast("int"), F.lit(it).cast("int").alias("iteration"),
    )



def _log_configs():
    return [model.RunConfig(0, lr_max=0.5)]


def _log_sql() -> str:
    return _train_sql(_log_configs(), extra=", tokens")


@register("log_metrics", _log_sql)
def q_log_metrics(spark, sf_dir):
    """Training records appended to the metrics table and read back; the
    wall-clock columns are written too but are not part of the compared
    result."""
    path = scratch_path(spark, "run-metrics")
    res = _train(spark, sf_dir, _log_configs())
    model.log_metrics(model.metrics_frame(spark, res.metrics), path)
    back = spark.read.parquet(path)
    return back.select(
        "run_id", "step", rnd(F.col("loss"), 6).alias("loss"), rnd(F.col("lr"), 9).alias("lr"),
        rnd(F.col("grad_norm"), 9).alias("grad_norm"), "tokens",
    )


@register(
    "run_throughput",
    """WITH e AS (
  SELECT user_id AS run_id, value AS tokens, CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events
), s AS (
  SELECT run_id, step, tokens, ts - lag(ts) OVER (PARTITION BY run_id ORDER BY step) AS secs FROM e
)
SELECT run_id, step, 0.0 + round(tokens / nullif(coalesce(secs, 1.0), 0), 6) AS tokens_per_sec FROM s""",
)
def q_run_throughput(spark, sf_dir):
    """Each user's events as the records of a run; the first takes one second."""
    events = table(spark, sf_dir, "events")
    step = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    metrics = events.select(
        F.col("user_id").alias("run_id"), step.cast("long").alias("step"), F.col("value").alias("tokens"),
        F.lit(1.0).alias("seconds"), (F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").cast("double") / 1e6).alias("ts"),
    )
    return model.run_throughput(metrics).select("run_id", "step", rnd("tokens_per_sec", 6).alias("tokens_per_sec"))


def _prompts(spark, sf_dir):
    """Prompts: the `benchmark` texts, encoded."""
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    ids = codec.encode_corpus(bench, trained_tokenizer(spark, sf_dir))
    return ids.select(F.col("doc_id").alias("prompt_id"), "ids")


def _generate(spark, sf_dir):
    st = _Stream(spark, sf_dir)
    logits = model.logits_for(model.smoothed_params(_corpus_counts(st), V))
    return generate.generate_batch(
        _prompts(spark, sf_dir), logits, GEN_MAX_NEW, GEN_TEMP, GEN_TOP_P, EOT_ID, GEN_SEED
    )


def _gen_sql() -> str:
    """Generation in DuckDB: prompts encoded with the corpus, the
    per-context sampling table of the count model, and a recursive CTE with
    one md5-based draw per step (the same rule as `generate_batch`)."""
    from tokenloom.plans import oracle_sql as O

    prompt_pieces = f"""bp_lists AS (SELECT item_id AS prompt_id, {O.pretoken_list('text')} AS ps FROM benchmark),
bp AS (SELECT prompt_id, unnest(generate_series(0, len(ps) - 1)) AS pos, unnest(ps) AS piece FROM bp_lists)"""
    body = (
        _stream_ctes("SELECT piece FROM bp", prompt_pieces)
        + _PAIRS_SQL
        + f"""
, cnt AS (SELECT input_id AS prev_id, target_id AS next_id, count(*) AS n FROM pairs GROUP BY ALL)
, grid AS (
  SELECT CAST(p.k AS BIGINT) AS prev_id, CAST(q.k AS BIGINT) AS next_id, coalesce(ln(c.n + 1), 0) AS w
  FROM range({V}) p(k) CROSS JOIN range({V}) q(k) LEFT JOIN cnt c ON c.prev_id = p.k AND c.next_id = q.k
)
, g_m AS (SELECT prev_id, next_id, w / {GEN_TEMP} - max(w / {GEN_TEMP}) OVER (PARTITION BY prev_id) AS s FROM grid)
, g_p AS (SELECT prev_id, next_id, exp(s) / sum(exp(s)) OVER (PARTITION BY prev_id) AS prob FROM g_m)
, g_before AS (
  SELECT prev_id, next_id, prob,
         coalesce(sum(prob) OVER (PARTITION BY prev_id ORDER BY prob DESC, next_id ASC
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM g_p
)
, g_nuc AS (
  SELECT prev_id, next_id, prob / sum(prob) OVER (PARTITION BY prev_id) AS prob FROM g_before WHERE before <= {GEN_TOP_P}
)
, g_tab AS MATERIALIZED (
  SELECT prev_id, next_id AS token_id,
         row_number() OVER (PARTITION BY prev_id ORDER BY prob DESC, next_id ASC) AS rank,
         coalesce(sum(prob) OVER (PARTITION BY prev_id ORDER BY prob DESC, next_id ASC
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_lo,
         sum(prob) OVER (PARTITION BY prev_id ORDER BY prob DESC, next_id ASC
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_hi,
         sum(prob) OVER (PARTITION BY prev_id) AS tot
  FROM g_nuc
)
, prompts AS (
  SELECT b.item_id AS prompt_id, coalesce(x.ids, CAST([] AS BIGINT[])) AS ids
  FROM benchmark b LEFT JOIN (
    SELECT p.prompt_id, list(CAST(i.token_id AS BIGINT) ORDER BY p.pos, i.k) AS ids
    FROM bp p JOIN enc_piece_ids i USING (piece) GROUP BY p.prompt_id
  ) x ON x.prompt_id = b.item_id
)
, gen AS (
  SELECT prompt_id, CAST(len(ids) AS BIGINT) AS prompt_len, ids, 0 AS i, len(ids) = 0 AS stopped FROM prompts
  UNION ALL
  SELECT g.prompt_id, g.prompt_len, list_append(g.ids, CAST(t.token_id AS BIGINT)), g.i + 1, t.token_id = {EOT_ID}
  FROM gen g JOIN g_tab t ON t.prev_id = g.ids[-1]
  WHERE NOT g.stopped AND g.i < {GEN_MAX_NEW}
    AND (t.run_lo < t.tot * CAST(('0x' || substr(md5('{GEN_SEED}:' || CAST(g.prompt_id AS VARCHAR) || ':' || CAST(g.i AS VARCHAR)), 1, 15))::BIGINT AS DOUBLE)
                        / CAST(1152921504606846976 AS DOUBLE) OR t.rank = 1)
    AND t.run_hi >= t.tot * CAST(('0x' || substr(md5('{GEN_SEED}:' || CAST(g.prompt_id AS VARCHAR) || ':' || CAST(g.i AS VARCHAR)), 1, 15))::BIGINT AS DOUBLE)
                        / CAST(1152921504606846976 AS DOUBLE)
)
, final AS (SELECT prompt_id, arg_max(ids, i) AS ids, max(i) AS n_new, any_value(prompt_len) AS prompt_len FROM gen GROUP BY prompt_id)"""
    )
    return body.replace("WITH ", "WITH RECURSIVE ", 1)


@register(
    "generate_batch",
    lambda: _gen_sql()
    + "\nSELECT prompt_id, prompt_len, CAST(n_new AS BIGINT) AS n_new, array_to_string(ids, ' ') AS ids FROM final",
)
def q_generate_batch(spark, sf_dir):
    g = _generate(spark, sf_dir)
    return g.select(
        "prompt_id", F.col("prompt_len").cast("long"), F.col("n_new").cast("long"), F.array_join("ids", " ").alias("ids")
    )


@register(
    "generation_stats",
    lambda: _gen_sql()
    + f"""
SELECT prompt_id, prompt_len, CAST(n_new AS BIGINT) AS new_tokens, CAST(len(ids) AS BIGINT) AS total_tokens,
       CASE WHEN n_new > 0 AND ids[-1] = {EOT_ID} THEN 'eos' ELSE 'length' END AS stop_reason
FROM final""",
)
def q_generation_stats(spark, sf_dir):
    return generate.generation_stats(_generate(spark, sf_dir), EOT_ID)


def _complete_sql() -> str:
    from tokenloom.plans import oracle_sql as O

    return _gen_sql() + f"""
, fpos AS (SELECT prompt_id, unnest(generate_series(1, len(ids))) AS k, unnest(ids) AS token_id FROM final)
, fhex AS (
  SELECT f.prompt_id, string_agg(v.token_hex, '' ORDER BY f.k) AS h
  FROM fpos f JOIN vocab v ON v.token_id = f.token_id GROUP BY f.prompt_id
)
SELECT f.prompt_id, coalesce({O.utf8_decode_sql('h.h', chr(0xFFFD))}, '') AS text
FROM final f LEFT JOIN fhex h USING (prompt_id)"""


@register("complete_text", _complete_sql)
def q_complete_text(spark, sf_dir):
    prompts = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("prompt_id"), "text")
    candidates = model.logits_for(model.smoothed_params(_corpus_counts(_Stream(spark, sf_dir)), V))
    done = generate.complete_text(
        prompts, trained_tokenizer(spark, sf_dir), candidates, GEN_MAX_NEW, GEN_TEMP, GEN_TOP_P, END_OF_TEXT, GEN_SEED
    )
    return done.select("prompt_id", "text")
