"""Token streams: global positions, training windows, next-token pairs and
random batches.

The stream is every document's ids in `doc_id` order with one end-of-text id
between documents.  Its table is a reliable checkpoint, read in runs of
ascending `doc_id`, as files hold them: a document's global offset is the total
of the runs before its own (one number a run, on the driver) plus a running sum
inside the run, added in the map that reads it.  No join by document and no
window function; the ids are moved once if runs overlap or ids are repeated out
of order, and never after.

Windows are cut with stride T and hold T+1 tokens (inputs and shifted
targets).  A window wholly inside one document is cut map-side; only windows
across a document edge are assembled by a shuffle, from one slice per
document it overlaps.  So packing shuffles about 2 x #docs slices of at most
T+1 ids, not the corpus, and every window group is bounded by T+1 tokens.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import bounded_broadcast, cut_lineage, ship_package, small_batches

#: Windows of one block of the window table: some 16 million tokens at T = 256.
WINDOWS_PER_BLOCK = 1 << 16


#: Runs of ascending ids that a partition may hold to stay as it is.
MAX_RUNS = 256


def _run_numbers(keys: pa.Array, last: pa.Array | None, number: int) -> np.ndarray:
    """The run of ascending ids that each id belongs to; `number` is that of the id `last` before."""
    whole = keys if last is None else pa.concat_arrays([last.cast(keys.type), keys])
    starts = ~pc.less_equal(whole[:-1], whole[1:]).to_numpy(zero_copy_only=False).astype(bool)
    return number + np.cumsum(np.r_[True, starts] if last is None else starts)


def run_totals(ids: DataFrame) -> list[tuple]:
    """(partition, run, tokens with separators, first doc_id, last doc_id, whether
    its ids differ) of every run of ascending ids, in the order of the rows.  A
    file in order is one run, also where a partition holds several.  A partition
    with null ids or more than `MAX_RUNS` runs counts as one, number -1."""
    ship_package(ids.sparkSession)
    kind = ids.schema["doc_id"].dataType.simpleString()

    def run(batches):
        firsts, lasts, totals, differ, no, known, total = [], [], [], [], -1, True, None
        for b in batches:
            if not b.num_rows:
                continue
            keys, n = b.column(0), b.column(1).to_numpy()
            none = pa.nulls(1, keys.type)
            total = (total or 0) + int(n.sum())
            known = known and keys.null_count == 0 and no < MAX_RUNS
            if not known:
                continue
            last = lasts[-1] if lasts else None
            of = _run_numbers(keys, last, no)
            equal = pc.equal(keys[:-1], keys[1:]).to_numpy(zero_copy_only=False).astype(bool)
            equal = np.r_[last is not None and last[0].as_py() == keys[0].as_py(), equal]
            no = int(of[-1])
            known = no < MAX_RUNS
            if known:
                begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                for s, e in zip(begins, [*begins[1:], len(of)]):
                    if of[s] == len(firsts):
                        firsts, lasts, totals, differ = [*firsts, keys[s : s + 1]], [*lasts, None], [*totals, 0], [*differ, True]
                    lasts[-1] = keys[e - 1 : e]
                    totals[-1] += int(n[s:e].sum())
                    differ[-1] = differ[-1] and not equal[s:e].any()
        if total is not None:
            if not known:
                firsts, lasts, totals, differ = [none], [none], [total], [False]
            at = np.full(len(totals), TaskContext.get().partitionId(), np.int32)
            numbers = np.arange(len(totals), dtype=np.int32) if known else np.array([-1], np.int32)
            columns = [pa.array(at), pa.array(numbers), pa.array(totals, pa.int64()), pa.concat_arrays(firsts), pa.concat_arrays(lasts), pa.array(differ)]
            yield pa.RecordBatch.from_arrays(columns, ["p", "run", "n", "first", "last", "differ"])

    narrow = ids.select("doc_id", (F.size("ids") + 1).cast("long").alias("n"))
    rows = narrow.mapInArrow(run, f"p int, run int, n long, first {kind}, last {kind}, differ boolean").collect()
    return sorted(map(tuple, rows), key=lambda r: r[:2])


def in_order(runs: list[tuple]) -> bool:
    """Whether reading the partitions one after the other gives the documents in order."""
    return all(r[1] == 0 for r in runs) and all(a[4] <= b[3] for a, b in itertools.pairwise(runs))


def in_places(runs: list[tuple]) -> list[tuple] | None:
    """The runs in the order of their documents, if the documents can stay where
    they are: ids differ, and no run lies partly within another."""
    if any(r[1] < 0 or not r[5] for r in runs):
        return None
    ordered = sorted(runs, key=lambda r: r[3])
    return ordered if all(a[4] < b[3] for a, b in itertools.pairwise(ordered)) else None


def segments(ids: DataFrame, stable: bool = False) -> tuple[DataFrame, int]:
    """(doc_id, ids, off) and the stream's length: each document's segment, its
    ids plus a separator, starts at global position `off`.

    Documents come in the order of their ids, of any type that sorts; documents
    of equal ids come in the order of their tokens.  `stable` says that `ids` is
    a checkpoint, whose partitions stay what they are; else it becomes one."""
    kept = ids.select("doc_id", "ids") if stable else cut_lineage(ids.select("doc_id", "ids"))
    runs = run_totals(kept)
    ordered = runs if in_order(runs) else in_places(runs)
    if ordered is None:
        kept = cut_lineage(kept.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids"))
        ordered = run_totals(kept)
    n_total = max(0, sum(r[2] for r in ordered) - 1)
    offsets = zip(ordered, itertools.accumulate((r[2] for r in ordered), initial=0))
    before: dict[int, dict[int, int]] = {}
    for (p, no, *_), off in offsets:
        before.setdefault(p, {})[no] = off

    def run(batches):
        mine = before.get(TaskContext.get().partitionId(), {})
        whole = -1 in mine
        base = np.array([mine[no] for no in sorted(mine)], dtype=np.int64)  # where a run's next document goes
        last, no = None, -1
        for b in batches:
            if not b.num_rows:
                continue
            n = pc.list_value_length(b.column(1)).to_numpy().astype(np.int64) + 1
            of = np.zeros(len(n), np.int64) if whole else _run_numbers(b.column(0), last, no)
            ends = np.cumsum(n)
            starts = np.r_[True, of[1:] != of[:-1]]
            off = base[of] + ends - n - (ends - n)[starts][np.cumsum(starts) - 1]
            base[of[-1]] = off[-1] + n[-1]
            last, no = b.column(0)[-1:], int(of[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(off)], [*b.schema.names, "off"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, ids array<int>, off long"), n_total


def doc_offsets(ids: DataFrame, stable: bool = False) -> DataFrame:
    """(doc_id, ids) -> (doc_id, off, len): where each document's segment starts."""
    seg, _ = segments(ids, stable)
    return seg.select("doc_id", "off", (F.size("ids") + 1).cast("long").alias("len"))


def stream_length(ids: DataFrame) -> int:
    """Tokens in the stream: all ids plus one separator between documents."""
    row = ids.agg(F.sum(F.size("ids") + 1).alias("s")).collect()[0]
    return max(0, int(row["s"] or 0) - 1)


def token_stream(ids: DataFrame, eot_id: int, n_total: int | None = None, stable: bool = False) -> DataFrame:
    """Long form of the stream: (gpos long, token_id int)."""
    seg, length = segments(ids, stable)
    n_total = length if n_total is None else n_total
    whole = F.concat("ids", F.array(F.lit(eot_id).cast("int")))
    out = seg.select(F.col("off"), F.posexplode(whole).alias("k", "token_id"))
    return out.select((F.col("off") + F.col("k")).alias("gpos"), "token_id").where(F.col("gpos") < n_total)


def pack_windows(ids: DataFrame, eot_id: int, T: int, n_total: int | None = None, stable: bool = False) -> DataFrame:
    """(window_id, ids): window w holds stream positions [wT, wT+T]; only
    windows with at least an input and a target are kept (the last may be
    shorter than T+1)."""
    seg, length = segments(ids, stable)
    n_total = length if n_total is None else n_total
    seg = seg.select("off", F.concat("ids", F.array(F.lit(eot_id).cast("int"))).alias("seg"), (F.size("ids") + 1).alias("len"))
    last = F.least(F.col("off") + F.col("len") - 1, F.lit(n_total - 1))
    w_lo = F.greatest(F.lit(0), F.ceil(F.col("off") / F.lit(T)) - 1)
    w_hi = F.least(F.floor((last) / F.lit(T)), F.lit((n_total - 2) // T if n_total >= 2 else -1))
    # sequence() counts down when its end is smaller: no window there
    slices = seg.where((F.col("off") <= F.lit(n_total - 1)) & (w_lo <= w_hi)).select(
        "off",
        "seg",
        last.alias("last"),
        F.explode(F.sequence(w_lo.cast("long"), w_hi.cast("long"))).alias("window_id"),
    )
    start = F.greatest(F.col("window_id") * T, F.col("off"))
    end = F.least(F.col("window_id") * T + T, F.col("last"))
    # a window lying wholly inside one document's segment is cut map-side;
    # only windows across a document edge are assembled by a shuffle
    inside = (F.col("window_id") * T >= F.col("off")) & (
        F.least(F.col("window_id") * T + T, F.lit(n_total - 1)) <= F.col("last")
    )
    cut = slices.where(start <= end).select(
        "window_id",
        inside.alias("inside"),
        start.alias("start"),
        F.slice("seg", (start - F.col("off") + 1).cast("int"), (end - start + 1).cast("int")).alias("part"),
    )
    whole = cut.where(F.col("inside")).select("window_id", F.col("part").alias("ids"))
    edge = (
        cut.where(~F.col("inside"))
        # by range, so that neighbours are written side by side; the grouping needs no other exchange
        .repartitionByRange("window_id")
        .groupBy("window_id")
        .agg(F.sort_array(F.collect_list(F.struct("start", "part"))).alias("ss"))
        .select("window_id", F.flatten(F.transform("ss", lambda x: x["part"])).alias("ids"))
    )
    return whole.unionByName(edge)


def next_token_pairs(windows: DataFrame, T: int) -> DataFrame:
    """(gpos, input_id, target_id) for every adjacent pair of the stream; each
    pair lies in exactly one window.  Map-only."""
    pairs = windows.select(
        "window_id",
        F.posexplode(
            F.arrays_zip(
                F.slice("ids", 1, F.size("ids") - 1).alias("input_id"),
                F.slice("ids", 2, F.size("ids") - 1).alias("target_id"),
            )
        ).alias("i", "p"),
    )
    return pairs.select(
        (F.col("window_id") * T + F.col("i")).alias("gpos"), F.col("p.input_id"), F.col("p.target_id")
    )


def bigram_counts(pairs: DataFrame) -> DataFrame:
    """n(prev, next): partial aggregation map-side, so a hot pair is one row
    per task before the shuffle."""
    return pairs.groupBy(F.col("input_id").alias("prev_id"), F.col("target_id").alias("next_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


def hashed_uniform_long(*parts):
    """A deterministic 60-bit hash of the parts (md5 of `a:b:c`): re-runs and
    task retries draw the same value, unlike rand()."""
    key = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def sample_starts(spark, steps: int, batch: int, n_total: int, T: int, seed: int) -> DataFrame:
    """(step, sample, start): start uniform in [0, N-T-1] (targets need one
    more token).  One row per draw: steps x batch, a parameter-sized table."""
    if n_total - T < 1:
        raise ValueError("stream shorter than one window")
    draws = spark.range(steps * batch).select(
        (F.col("id") / F.lit(batch)).cast("long").alias("step"), (F.col("id") % F.lit(batch)).alias("sample")
    )
    h = hashed_uniform_long(F.lit(seed), F.col("step"), F.col("sample"))
    return draws.select("step", "sample", F.pmod(h, F.lit(n_total - T)).alias("start"))


def write_windows(windows: DataFrame, path: str, per_block: int = WINDOWS_PER_BLOCK) -> DataFrame:
    """The window table, stored by blocks of `per_block` consecutive windows, so
    that a reader of few windows opens few files: (window_id, ids, block)."""
    block = F.floor(F.col("window_id") / F.lit(per_block)).cast("long")
    with small_batches(windows.sparkSession):
        windows.withColumn("block", block).write.partitionBy("block").parquet(path)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in windows.schema)
    return windows.sparkSession.read.schema(f"{fields}, block long").parquet(path)


def sample_batches(windows: DataFrame, starts: DataFrame, T: int, per_block: int | None = None) -> DataFrame:
    """(step, sample, offset, input_id, target_id): inputs = stream[s..s+T-1],
    targets = stream[s+1..s+T].  Tokens [s, s+T] lie in windows s div T and
    the next one.  The draws are broadcast after a size check; over a table of
    `write_windows` with `per_block`, they prune the blocks that are read."""
    need = starts.select(
        "step", "sample", "start",
        F.explode(F.array(F.floor(F.col("start") / T), F.floor(F.col("start") / T) + 1)).alias("window_id"),
    )
    keys = ["window_id"]
    if per_block:
        # the filter marks the draws as the selective side, whose blocks prune the scan
        need = need.withColumn("block", F.floor(F.col("window_id") / F.lit(per_block)).cast("long")).where(F.col("start") >= 0)
        keys = ["block", "window_id"]
    joined = windows.join(bounded_broadcast(need), keys)
    grouped = joined.groupBy("step", "sample", "start").agg(
        F.sort_array(F.collect_list(F.struct("window_id", "ids"))).alias("ws")
    )
    seg = F.concat(
        F.col("ws")[0]["ids"],
        F.when(F.size("ws") > 1, F.slice(F.col("ws")[1]["ids"], 2, T)).otherwise(F.array().cast("array<int>")),
    )
    rel = (F.col("start") - F.floor(F.col("start") / T) * T + 1).cast("int")
    arrays = grouped.select(
        "step", "sample",
        F.slice(seg, rel, T).alias("inputs"),
        F.slice(seg, rel + 1, T).alias("targets"),
    )
    return arrays.select(
        "step", "sample", F.posexplode(F.arrays_zip("inputs", "targets")).alias("offset", "p")
    ).select("step", "sample", "offset", F.col("p.inputs").alias("input_id"), F.col("p.targets").alias("target_id"))
