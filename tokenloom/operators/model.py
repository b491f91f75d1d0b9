"""A next-token model trained with DataFrame aggregates.

The network of the reference is replaced (a stated substitution) by a
log-linear bigram model p(next | prev) = softmax(W[prev]).  Its loss and
gradient are exact aggregates over bigram counts n(prev, next):

  loss = -(1/N) * sum n(prev,next) * log p(next|prev)
  g    = (n(prev) * p(next|prev) - n(prev,next)) / N

Parameters are a table `params(run_id, prev_id, w, m, v, t)`: one row per run
and context, holding its whole row of W and the AdamW state as arrays over the
vocabulary.  Softmax, gradient and update are local to a row; what rows share
(loss, norm) is one aggregate of a few numbers.  Bigram counts are joined by
context, pre-aggregated to one row each, at most V entries long.  Training does
many steps in one barrier stage, whose tasks exchange loss and norm.  Several runs
(a learning-rate sweep) live in one table and every operator is keyed by
`run_id`.  The parameters are never collected.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.session import delete_paths, scratch_path, ship_package, small_batches

PARAM_COLS = ["run_id", "prev_id", "w", "m", "v", "t"]
PARAM_SCHEMA = "run_id int, prev_id int, w array<double>, m array<double>, v array<double>, t int"

def as_matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def as_lists(x: np.ndarray) -> pa.Array:
    ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32) if x.shape[1] else np.zeros(len(x) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], list], schema: str) -> DataFrame:
    """`fn` over Arrow batches of rows (bounded in bytes by the session); it
    returns the columns of `schema`."""
    ship_package(df.sparkSession)
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(fn(b), names)

    return df.mapInArrow(run, schema)


def long_form(df: DataFrame, *values: str) -> DataFrame:
    """(run_id, prev_id, next_id, values...): array columns a row per weight."""
    zipped = F.arrays_zip(*values)
    return df.select("run_id", "prev_id", F.posexplode(zipped).alias("next_id", "x")).select(
        "run_id", "prev_id", "next_id", *(F.col(f"x.{c}").alias(c) for c in values)
    )


@dataclass
class RunConfig:
    run_id: int
    lr_max: float = 1e-3
    lr_min: float | None = None
    warmup: int = 0
    cycle: int = 0
    betas: tuple[float, float] = (0.9, 0.999)
    eps: float = 1e-8
    weight_decay: float = 0.01
    max_grad_norm: float | None = 1.0

    def lr_min_effective(self) -> float:
        """min lr defaults to a tenth of the max (also when not below it)."""
        if self.lr_min is None or self.lr_min >= self.lr_max:
            return 0.1 * self.lr_max
        return self.lr_min

    def lr(self, step: int) -> float:
        a_max, a_min, tw, tc = self.lr_max, self.lr_min_effective(), self.warmup, self.cycle
        if step < tw:
            return step * a_max / tw
        if step <= tc:
            if tc <= tw:
                return a_min
            return a_min + 0.5 * (1 + math.cos((step - tw) / (tc - tw) * math.pi)) * (a_max - a_min)
        return a_min


def lr_sweep_configs(lrs: list[float], **kw) -> list[RunConfig]:
    return [RunConfig(run_id=i, lr_max=lr, **kw) for i, lr in enumerate(lrs)]


def init_params(spark: SparkSession, vocab_size: int, run_ids: list[int]) -> DataFrame:
    """Zero weights and state: a row of W for every run and id of the vocabulary."""
    zeros = F.array_repeat(F.lit(0.0), vocab_size)
    # the runs are the caller's config list
    ids = spark.range(vocab_size).select(F.explode(F.array(*[F.lit(int(r)) for r in run_ids])).alias("run_id"), F.col("id").cast("int").alias("prev_id"))
    return ids.select("run_id", "prev_id", zeros.alias("w"), zeros.alias("m"), zeros.alias("v"), F.lit(0).alias("t"))


def count_parameters(params: DataFrame) -> DataFrame:
    return params.groupBy("run_id").agg(F.sum(F.size("w")).cast("long").alias("n_params"))


def by_context(counts: DataFrame) -> DataFrame:
    """(prev_id, next_id, n) -> (prev_id, ids, ns): a row per context, at most
    as long as the vocabulary."""
    one = counts.groupBy("prev_id", "next_id").agg(F.sum(F.col("n").cast("double")).alias("n"))
    c = one.groupBy("prev_id").agg(F.collect_list(F.struct("next_id", "n")).alias("c"))
    return c.select("prev_id", F.col("c.next_id").cast("array<int>").alias("ids"), F.col("c.n").alias("ns"))


def _dense(ids: pa.Array, ns: pa.Array, width: int) -> np.ndarray:
    """Counts of each row over the vocabulary; ids outside it are left out."""
    out = np.zeros((len(ids), width))
    sizes = np.diff(ids.offsets.to_numpy())
    row = np.repeat(np.arange(len(ids)), sizes)
    at, n = ids.flatten().to_numpy(), ns.flatten().to_numpy()
    ok = (at >= 0) & (at < width)
    np.add.at(out, (row[ok], at[ok]), n[ok])
    return out


def _log_softmax(w: np.ndarray) -> np.ndarray:
    s = w - w.max(axis=1, keepdims=True)
    return s - np.log(np.exp(s).sum(axis=1, keepdims=True))


def _with_counts(params: DataFrame, counts: DataFrame) -> DataFrame:
    """params with (ids, ns) of each row's context, empty where it has none."""
    # at most a row per context of each side: the planner sizes this join at run time
    joined = params.join(by_context(counts), "prev_id", "left")
    return joined.withColumns({"ids": F.coalesce("ids", F.array().cast("array<int>")), "ns": F.coalesce("ns", F.array().cast("array<double>"))})


def with_gradient(params: DataFrame, counts: DataFrame, n_total: float | None = None) -> DataFrame:
    """params with g, the gradient of the mean loss over bigram counts
    (prev_id, next_id, n), and the row's share of the loss (nll) and of the
    squared norm (sq).  `n_total` is the number of pairs counted; when not
    given it is one scalar aggregate."""
    if n_total is None:
        n_total = float(counts.agg(F.sum("n")).collect()[0][0] or 0.0)
    total = n_total or 1.0

    def grad(b):
        w = as_matrix(b.column("w"))
        n = _dense(b.column("ids"), b.column("ns"), w.shape[1])
        lp = _log_softmax(w)
        g = (n.sum(axis=1, keepdims=True) * np.exp(lp) - n) / total
        nll = -(n * lp).sum(axis=1) / total
        return [*(b.column(c) for c in PARAM_COLS), as_lists(g), pa.array(nll), pa.array((g * g).sum(axis=1))]

    joined = _with_counts(params.select(*PARAM_COLS), counts).select(*PARAM_COLS, "ids", "ns")
    return map_rows(joined, grad, f"{PARAM_SCHEMA}, g array<double>, nll double, sq double")


def loss_and_norm(grads: DataFrame) -> dict[int, tuple[float, float]]:
    """Per run: batch loss and global L2 norm of the gradient (one row per run)."""
    agg = grads.groupBy("run_id").agg(F.sum("nll").alias("loss"), F.sqrt(F.sum("sq")).alias("norm"))
    return {r["run_id"]: (float(r["loss"] or 0.0), float(r["norm"] or 0.0)) for r in agg.collect()}


def gradient_norm(grads: DataFrame) -> DataFrame:
    return grads.groupBy("run_id").agg(F.sqrt(F.sum("sq")).alias("norm"))


def clip_factor(norm: float, max_norm: float | None, eps: float = 1e-6) -> float:
    """If the norm reaches the limit, scale by max/(norm+eps)."""
    if max_norm is None or norm < max_norm:
        return 1.0
    return max_norm / (norm + eps)


def clip_gradients(grads: DataFrame, factors: dict[int, float]) -> DataFrame:
    f = F.lit(1.0)
    for run, k in factors.items():
        f = F.when(F.col("run_id") == run, F.lit(float(k))).otherwise(f)
    return grads.withColumn("_f", f).withColumn("g", F.transform("g", lambda x: x * F.col("_f"))).drop("_f")


def adamw_step(grads: DataFrame, cfg: dict[int, RunConfig], lrs: dict[int, float], factors: dict[int, float] | None = None) -> DataFrame:
    """One AdamW update of every weight: moments, bias-corrected step, then
    decoupled weight decay.  `factors` scale each run's gradient (clipping)."""
    factors = factors or {}

    def step(b):
        runs = b.column("run_id").to_pylist()
        each = lambda fn: np.array([fn(cfg[r]) for r in runs], dtype=np.float64)[:, None]
        b1, b2, eps, wd = each(lambda c: c.betas[0]), each(lambda c: c.betas[1]), each(lambda c: c.eps), each(lambda c: c.weight_decay)
        lr, f = each(lambda c: lrs[c.run_id]), each(lambda c: factors.get(c.run_id, 1.0))
        g = as_matrix(b.column("g")) * f
        t = b.column("t").to_numpy() + 1
        m = b1 * as_matrix(b.column("m")) + (1 - b1) * g
        v = b2 * as_matrix(b.column("v")) + (1 - b2) * g * g
        alpha = lr * np.sqrt(1 - b2 ** t[:, None]) / (1 - b1 ** t[:, None])
        w = as_matrix(b.column("w")) - alpha * m / (np.sqrt(v) + eps)
        w = np.where(wd > 0, w * (1 - lr * wd), w)
        return [b.column("run_id"), b.column("prev_id"), as_lists(w), as_lists(m), as_lists(v), pa.array(t.astype(np.int32))]

    return map_rows(grads.select(*PARAM_COLS, "g"), step, PARAM_SCHEMA)


def batch_counts(batches: DataFrame) -> DataFrame:
    """(step, prev_id, next_id, n) from sampled batches (step, ..., input_id, target_id)."""
    return batches.groupBy("step", F.col("input_id").alias("prev_id"), F.col("target_id").alias("next_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


@dataclass
class TrainResult:
    params: DataFrame
    metrics: list[dict] = field(default_factory=list)


def epoch_counts(windows: DataFrame, per_step: int) -> DataFrame:
    """(step, prev_id, next_id, n): one epoch over all windows (window_id, ids),
    `per_step` consecutive windows a step, so the steps follow from the data.
    A batch of windows counts its pairs before they meet those of others."""
    ship_package(windows.sparkSession)

    def run(batches):
        for b in batches:
            ids, sizes = b.column(1).flatten().to_numpy().astype(np.int64), pc.list_value_length(b.column(1)).fill_null(0).to_numpy()
            of = np.repeat(b.column(0).to_numpy() // per_step, sizes)
            window = np.repeat(np.arange(b.num_rows), sizes)
            inside = window[:-1] == window[1:]
            if not inside.any():
                continue
            step, prev, nxt = of[:-1][inside], ids[:-1][inside], ids[1:][inside]
            for st in np.unique(step):
                mine = step == st
                keys, n = np.unique(prev[mine] << 32 | nxt[mine], return_counts=True)
                columns = [np.full(len(keys), st, np.int64), (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["step", "prev_id", "next_id", "n"])

    part = windows.select(F.col("window_id").cast("long"), "ids").mapInArrow(run, "step long, prev_id int, next_id int, n long")
    return part.groupBy("step", "prev_id", "next_id").agg(F.sum("n").alias("n"))


#: Training steps that one job does, and tasks that share the contexts of the model.
STEPS_PER_JOB = 64
TRAIN_TASKS = 4
STATE_SCHEMA = f"iteration int, {PARAM_SCHEMA}, loss double, norm double, ts double"


def _by_job(counts_by_step: DataFrame, start: int, per_job: int) -> DataFrame:
    """(step, prev_id, ids, ns, job): a row per step and context, stored by the
    job that does the step, so that a job reads its own steps only."""
    one = counts_by_step.groupBy("step", "prev_id", "next_id").agg(F.sum(F.col("n").cast("double")).alias("n"))
    rows = one.groupBy("step", "prev_id").agg(F.collect_list(F.struct("next_id", "n")).alias("c"))
    rows = rows.select(
        F.col("step").cast("long"), F.col("prev_id").cast("int"), F.col("c.next_id").cast("array<int>").alias("ids"), F.col("c.n").alias("ns"),
        F.floor((F.col("step") - F.lit(start)) / F.lit(per_job)).cast("long").alias("job"),
    )
    path = scratch_path(rows.sparkSession, "step-counts")
    with small_batches(rows.sparkSession):
        rows.write.partitionBy("job").parquet(path)
    return rows.sparkSession.read.schema("step long, prev_id int, ids array<int>, ns array<double>, job long").parquet(path)


def _entries(c: pa.Array) -> tuple[np.ndarray, ...]:
    """(step, row, id, n) of every count, from a list of (step, ids, ns) a row; by step."""
    row = np.repeat(np.arange(len(c)), np.diff(c.offsets.to_numpy()))
    step, ids, ns = c.flatten().flatten()
    sizes = pc.list_value_length(ids).to_numpy()
    at, step = np.repeat(row, sizes), np.repeat(step.to_numpy(), sizes)
    order = np.argsort(step, kind="stable")
    return step[order], at[order], ids.flatten().to_numpy()[order], ns.flatten().to_numpy()[order]


def _train_steps(state: DataFrame, cfg: dict[int, RunConfig], steps: range, totals: dict[int, int], emit: set[int]) -> DataFrame:
    """STATE_SCHEMA rows after `steps`: the parameters after the iterations of
    `emit`, and a row per step and run with loss, norm and time.

    One barrier stage: a task keeps its contexts' rows from step to step, and
    the tasks tell each other their share of loss and norm, two numbers a run.
    Telling takes a second whatever is told, so many steps are done as if no
    gradient were clipped, and told at once.  The first that is clipped, and
    those before it, are then done again with the factors now known, so every
    step is the one that the loop of single steps takes."""
    ship_package(state.sparkSession)
    runs = sorted(cfg)

    def run(batches):
        ctx = BarrierTaskContext.get()
        table = pa.Table.from_batches(got) if (got := [b for b in batches if b.num_rows]) else None
        rows = table.num_rows if table else 0
        col = {c: pa.concat_arrays(table.column(c).chunks) for c in table.column_names} if rows else {}
        w, m, v = (as_matrix(col[c]) if rows else np.zeros((0, 1)) for c in "wmv")
        t = col["t"].to_numpy() if rows else np.zeros(0, np.int32)
        of = np.array([runs.index(r) for r in col["run_id"].to_pylist()] if rows else [], dtype=np.int64)
        entries = _entries(col["c"]) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))
        each = lambda fn: np.array([fn(cfg[r]) for r in runs], dtype=np.float64)[of][:, None]
        b1, b2, eps, wd = each(lambda c: c.betas[0]), each(lambda c: c.betas[1]), each(lambda c: c.eps), each(lambda c: c.weight_decay)

        def gradient(step, w):
            """The rows' gradient, and by run their share of the loss and of the squared norm."""
            total = float(totals.get(step, 0)) or 1.0
            lo, hi = np.searchsorted(entries[0], [step, step + 1])
            at, ids, ns = (e[lo:hi] for e in entries[1:])
            ok = (ids >= 0) & (ids < w.shape[1])
            n = np.zeros_like(w)
            np.add.at(n, (at[ok], ids[ok]), ns[ok])
            lp = _log_softmax(w)
            g = (n.sum(axis=1, keepdims=True) * np.exp(lp) - n) / total
            return g, [np.bincount(of, x, len(runs)).tolist() for x in (-(n * lp).sum(axis=1) / total, (g * g).sum(axis=1))]

        def moved(step, now, g, factors):
            """The state after the step, each run's gradient scaled by its factor."""
            w, m, v, t = now
            g, t, lr = g * np.array(factors)[of][:, None], t + 1, each(lambda c: c.lr(step))
            m, v = b1 * m + (1 - b1) * g, b2 * v + (1 - b2) * g * g
            alpha = lr * np.sqrt(1 - b2 ** t[:, None]) / (1 - b1 ** t[:, None])
            w = w - alpha * m / (np.sqrt(v) + eps)
            return np.where(wd > 0, w * (1 - lr * wd), w), m, v, t

        def saved(step, now):
            it, none = pa.array(np.full(rows, step + 1, np.int32)), pa.nulls(rows, pa.float64())
            lists = [as_lists(x) for x in now[:3]]
            return pa.RecordBatch.from_arrays([it, col["run_id"], col["prev_id"], *lists, pa.array(now[3].astype(np.int32)), none, none, none], STATE_COLS)

        now, at, most = (w, m, v, t), steps.start, len(steps)
        while at < steps.stop:
            some, ahead, shares, times = range(at, min(at + most, steps.stop)), now, [], []
            for step in some:
                g, share = gradient(step, ahead[0])
                shares.append(share)
                times.append(time.time())
                ahead = moved(step, ahead, g, [1.0] * len(runs))
            told, factors, logged = [json.loads(x) for x in ctx.allGather(json.dumps(shares))], [], []
            for i in range(len(some)):
                loss, sq = ([math.fsum(x[i][k][r] for x in told) for r in range(len(runs))] for k in (0, 1))
                norm = [math.sqrt(x) for x in sq]
                factors.append([clip_factor(x, cfg[r].max_grad_norm) for x, r in zip(norm, runs)])
                logged.append((loss, norm))
                if any(f != 1.0 for f in factors[-1]):
                    break
            clipped = any(f != 1.0 for f in factors[-1])
            done = some[: len(factors)]
            if clipped or any(step + 1 in emit for step in done[:-1]):
                for step, f in zip(done, factors):
                    now = moved(step, now, gradient(step, now[0])[0], f)
                    if rows and step + 1 in emit:
                        yield saved(step, now)
            else:
                now = ahead
                if rows and done[-1] + 1 in emit:
                    yield saved(done[-1], now)
            for step, (loss, norm), ts in zip(done, logged, times) if ctx.partitionId() == 0 else ():
                k = len(runs)
                empty = [pa.nulls(k, pa.int32()), *(pa.nulls(k, pa.list_(pa.float64())) for _ in "wmv"), pa.nulls(k, pa.int32())]
                it = pa.array(np.full(k, step + 1, np.int32))
                yield pa.RecordBatch.from_arrays([it, pa.array(runs, pa.int32()), *empty, pa.array(loss), pa.array(norm), pa.array([ts] * k)], STATE_COLS)
            at, most = done[-1] + 1, 2 * len(done)

    return state.mapInArrow(run, STATE_SCHEMA, barrier=True)


STATE_COLS = [f.strip().split(" ")[0] for f in STATE_SCHEMA.split(",")]


def train_model(
    params: DataFrame,
    counts_by_step: DataFrame,
    configs: list[RunConfig],
    steps: int | None = None,
    start_step: int = 0,
    checkpoint_every: int = 4,
    on_checkpoint=None,
    on_checkpoints=None,
    per_job: int = STEPS_PER_JOB,
) -> TrainResult:
    """lr -> step counts -> loss and gradient -> clip -> AdamW -> log, per step;
    `steps` defaults to all steps that have counts.

    The counts (step, prev_id, next_id, n) are computed once and stored by job.
    A job does `per_job` steps in one barrier stage and writes the parameters,
    which the next job reads.  `on_checkpoint` sees the parameters after every
    `checkpoint_every` steps and after the last, one frame and iteration at a
    time; `on_checkpoints` sees those of a job in one frame, with their
    `iteration`, as soon as the job has ended."""
    spark = params.sparkSession
    cfg = {c.run_id: c for c in configs}
    counts = _by_job(counts_by_step, start_step, per_job)
    # pairs counted per step: one row per step
    per_step = counts.groupBy("step").agg(F.sum(F.aggregate("ns", F.lit(0.0), lambda a, x: a + x)).alias("t"))
    totals = {int(r["step"]): int(r["t"]) for r in per_step.collect()}
    steps = max(totals, default=-1) + 1 - start_step if steps is None else steps
    current, stale = params.select(*PARAM_COLS), []
    metrics: list[dict] = []
    last_t = time.time()
    end = start_step + steps
    for job, first in enumerate(range(start_step, end, per_job)):
        todo = range(first, min(first + per_job, end))
        saved = [s + 1 for s in todo if (s + 1 - start_step) % checkpoint_every == 0 or s + 1 == end]
        saved = saved if on_checkpoint or on_checkpoints else []
        mine = counts.where(F.col("job") == job).groupBy("prev_id").agg(F.collect_list(F.struct("step", "ids", "ns")).alias("c"))
        none = F.array().cast("array<struct<step:bigint,ids:array<int>,ns:array<double>>>")
        state = current.join(mine, "prev_id", "left").select(*PARAM_COLS, F.coalesce("c", none).alias("c"))
        tasks = min(TRAIN_TASKS, spark.sparkContext.defaultParallelism)
        state = state.repartition(tasks, "run_id", "prev_id")
        path = scratch_path(spark, "train-state")
        # written once and read from there: no task ever repeats a step of the barrier on its own
        with small_batches(spark):
            _train_steps(state, cfg, todo, totals, {*saved, todo[-1] + 1}).write.parquet(path)
        out = spark.read.schema(STATE_SCHEMA).parquet(path)
        kept = out.where("loss IS NULL")
        current = kept.where(F.col("iteration") == todo[-1] + 1).select(*PARAM_COLS)
        if on_checkpoints is not None:
            on_checkpoints(kept.where(F.col("iteration").isin(saved)).select("iteration", *PARAM_COLS))
        for it in saved if on_checkpoint is not None else []:
            on_checkpoint(kept.where(F.col("iteration") == it).select(*PARAM_COLS), it)
        logged = out.where("loss IS NOT NULL").select("iteration", "run_id", "loss", "norm", "ts").collect()
        by_step = {(r["iteration"] - 1, r["run_id"]): r for r in logged}
        for step in todo:
            for r, c in cfg.items():
                x = by_step[step, r]
                metrics.append(
                    {"run_id": r, "step": step, "loss": x["loss"], "lr": c.lr(step), "grad_norm": x["norm"],
                     "tokens": totals.get(step, 0), "seconds": x["ts"] - last_t, "ts": x["ts"]}
                )
            last_t = by_step[step, next(iter(cfg))]["ts"]
        delete_paths(spark, stale)
        stale = [path]
    return TrainResult(current, metrics)


METRICS_SCHEMA = "run_id int, step long, loss double, lr double, grad_norm double, tokens long, seconds double, ts double"


def metrics_frame(spark: SparkSession, metrics: list[dict]) -> DataFrame:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    fields = [f.split() for f in METRICS_SCHEMA.split(", ")]
    columns = [pa.array([(float if kind == "double" else int)(m[name]) for m in metrics], kinds[kind]) for name, kind in fields]
    return spark.createDataFrame(pa.table(columns, [name for name, _ in fields]), METRICS_SCHEMA)


def log_metrics(metrics: DataFrame, path: str) -> None:
    """Append training records to the metrics table."""
    metrics.write.mode("append").parquet(path)


def run_throughput(metrics: DataFrame) -> DataFrame:
    """Tokens per second between consecutive records of each run (the first
    record counts its own step, not a whole logging interval); null where no
    time has passed."""
    w = Window.partitionBy("run_id").orderBy("step")
    prev_ts = F.lag("ts").over(w)
    steps_between = F.col("step") - F.coalesce(F.lag("step").over(w), F.col("step") - 1)
    secs = F.when(prev_ts.isNull(), F.col("seconds")).otherwise(F.col("ts") - prev_ts)
    return metrics.withColumn("tokens_per_sec", F.try_divide(steps_between * F.col("tokens"), secs))


def evaluate(params: DataFrame, counts: DataFrame) -> DataFrame:
    """(run_id, eval_loss, n_pairs): mean loss over all counted pairs (prev_id,
    next_id, n), which may be a whole corpus': the pairs are aggregated to one
    row per context and meet the parameters in one join.  A pair whose context
    or next id has no parameters counts as drawn uniformly: loss ln V."""
    total = int(counts.agg(F.sum("n")).collect()[0][0] or 0)

    def score(b):
        w = as_matrix(b.column("w"))
        n = _dense(b.column("ids"), b.column("ns"), w.shape[1])
        nll = -(n * _log_softmax(w)).sum(axis=1)
        width = np.full(len(nll), float(w.shape[1]))
        return [b.column("run_id"), pa.array(nll), pa.array(n.sum(axis=1)), pa.array(width)]

    joined = _with_counts(params.select("run_id", "prev_id", "w"), counts).select("run_id", "w", "ids", "ns")
    rows = map_rows(joined, score, "run_id int, nll double, n double, width double")
    per = rows.groupBy("run_id").agg(F.sum("nll").alias("nll"), F.sum("n").alias("n"), F.max("width").alias("width"))
    missing = F.lit(float(total)) - F.col("n")
    loss = F.try_divide(F.col("nll") + missing * F.log("width"), F.lit(float(total)))
    return per.select("run_id", loss.alias("eval_loss"), F.lit(total).cast("long").alias("n_pairs"))


# ------------------------------------------------------------- checkpoints
def save_checkpoint(params: DataFrame, iteration: int, path: str) -> None:
    """Parameters and optimizer state of one iteration under `path`; saving an
    iteration again replaces it and leaves the others."""
    if not isinstance(iteration, int):
        raise TypeError("iteration must be an int")
    params.select(*PARAM_COLS).write.mode("overwrite").parquet(f"{path}/iteration={iteration}")


def save_checkpoints(params: DataFrame, path: str) -> None:
    """`save_checkpoint` of every iteration in `params` (with `iteration`), in one job."""
    rows = params.select(*PARAM_COLS, "iteration").repartition("iteration")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("iteration").parquet(path)


def load_checkpoint(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Latest iteration's parameters (partition pruning on `iteration`)."""
    df = spark.read.parquet(path)
    latest = df.agg(F.max("iteration").alias("i")).collect()[0]["i"]
    if latest is None:
        raise ValueError("no checkpoint found")
    return df.where(F.col("iteration") == latest).select(*PARAM_COLS), int(latest)


def logits_for(params: DataFrame, run_id: int = 0) -> DataFrame:
    """(prev_id, next_ids, logits): the candidates after each context."""
    ids = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: i.cast("int"))
    return params.where(F.col("run_id") == run_id).select("prev_id", ids.alias("next_ids"), F.col("w").alias("logits"))


def smoothed_params(counts: DataFrame, vocab_size: int) -> DataFrame:
    """Count model as parameters: w = ln(n(prev,next) + 1) for every next."""
    base = init_params(counts.sparkSession, vocab_size, [0])

    def logs(b):
        zeros = as_matrix(b.column("w"))
        w = np.log(_dense(b.column("ids"), b.column("ns"), zeros.shape[1]) + 1)
        return [b.column("run_id"), b.column("prev_id"), as_lists(w), as_lists(zeros), as_lists(zeros), b.column("t")]

    return map_rows(_with_counts(base, counts).select(*PARAM_COLS, "ids", "ns"), logs, PARAM_SCHEMA)
