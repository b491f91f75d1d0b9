"""Operator 8, mixing sources to target weights by entropy balancing.

Targets: the sources, by code point and null last, weigh 5, 2, 1, repeating;
they share 150 % of all words, and a target above twice its source's size is
cut to that, the excess shared again by weight until none is above.

Rates: every document gets a rate in 0..2 (expected copies).  Among all rates
that meet a source's token constraint, sum(rate * size) = target, those of
greatest entropy are exponentially tilted in the constrained quantity,

    rate / (2 - rate) = exp(lambda * size),   rate = 2 / (1 + exp(-lambda * size)),

with one multiplier per source.  The multipliers minimise the convex dual, which
falls apart by source.  The documents enter only through the table of (source,
size, documents), counted before any shuffle: it has the same sums, and for a
source as many rows as there are different sizes, so a hot source is no larger
than another.  The Newton iterations are distributed: a round joins all
multipliers to that table, sums gradient and curvature by source with map-side
partial sums, and moves every multiplier at once; the multipliers themselves are
a table.  Sums are decimals, so they do not depend on the order of rows.  A
step that leaves the bracket of its multiplier is replaced by bisection.

Copies: documents of one source and size share a rate, so a group of them gets
whole copies and a number of extra ones: from the largest size down, the words
that rounding gives too much or too little are carried to the next size, so a
source ends within about half its smallest document of its target.  That pass
holds one source's different sizes, at most as many as the longest document has
words.  The extra
copies go to the first of the group by the hash of their id, so they do not
depend on the files or partitions.  That rank is taken in two levels, spans of
the hash and then inside one span, so a group of any size stays spread.  Rows
that repeat an id are taken alike.

Defined results: null texts have size 0 and take 0 words; one row per input
row, ties and repeated rows included; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm.common import fits, kept, written
from tokenloom.session import ship_package

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Rows in a span of the hash, about.
BLOCK = 4096
NEWTON_STEPS = 60
TOLERANCE = 1e-6


def word_counts(texts: Column) -> Column:
    """Words of each whole text, null: 0."""

    @F.pandas_udf("long")
    def count(t: pd.Series) -> pd.Series:
        kept(("mixing",))
        # bytes.split() parts at space and 9 to 13, like the contract's pattern
        return pd.Series([len(x.encode("utf-8", "replace").split()) if x else 0 for x in t], dtype="int64")

    return count(texts)


def _spot(doc_id: Column, text: Column) -> Column:
    """A document's place by hash: of its id, or of its text if it has no id."""
    return F.when(doc_id.isNotNull(), F.xxhash64(doc_id)).otherwise(F.xxhash64(F.coalesce(text, F.lit(""))))


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, spot) of every row."""
    ship_package(docs.sparkSession)
    return docs.select(
        docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), word_counts(docs["text"]).alias("size"),
        _spot(docs["doc_id"], docs["text"]).alias("spot"),
    )


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target), one row per source.

    The rank of a source needs its place among the sources only; each round of
    the resharing is one aggregate of three numbers."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    totals = written(totals.withColumn("weight", weight), "sources")
    level, cap = 0.0, F.col("source_size") * most
    while True:
        capped = cap <= F.col("weight") * level
        r = totals.agg(
            F.sum(F.col("source_size")).alias("all"),
            F.sum(F.when(capped, cap).otherwise(0.0)).alias("given"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if r["all"] is None or not r["free"]:
            break
        new = (share * r["all"] - r["given"]) / r["free"]
        if new <= level:
            break
        level = new
    return totals.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


#: Most sources whose multipliers are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 1 << 16


def multipliers(hist: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(ms, lam): the minimisers of the convex dual, one multiplier per source, with
    sum(n * size * most / (1 + exp(-lam * size))) = target, by Newton rounds over all
    sources.  A target of `most` times the size has none: infinity.

    `hist` has (source, size, n) with sizes above 0, `targets` (source, target)."""
    def exact(x: Column) -> Column:
        return F.sum(x.cast("decimal(28,6)")).cast("double")

    base = hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs"))
    t = targets.select(F.col("source").alias("ts"), "target")
    base = base.join(t, base["source"].eqNullSafe(F.col("ts")))
    none = F.lit(None).cast("double")
    state = base.select(
        F.col("source").alias("ms"), "target", (F.col("docs") / F.col("words")).alias("unit"),  # sizes around 1
        F.when(F.col("target") >= most * F.col("words") * (1 - 1e-12), float("inf"))
        .when(F.col("target") <= 0, float("-inf")).otherwise(0.0).alias("lam"),
        none.alias("low"), none.alias("high"),
    ).withColumn("done", F.abs("lam") == float("inf"))
    state = written(state, "multipliers")
    broad = fits(state, BROADCAST_SOURCES)
    for _ in range(NEWTON_STEPS):
        if state.where("NOT done").isEmpty():
            break
        open_ = state.where("NOT done").select(F.col("ms").alias("os"), F.col("lam").alias("at"), F.col("unit").alias("u"))
        rows = hist.join(F.broadcast(open_) if broad else open_, hist["source"].eqNullSafe(F.col("os")))
        x, words = F.col("size") * F.col("u"), F.col("n") * F.col("size")
        p = 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -F.col("at") * x))))
        sums = rows.groupBy("os").agg(exact(most * p * words).alias("taken"), exact(most * p * (1 - p) * x * words).alias("curve"))
        gap, lam = F.col("taken") - F.col("target"), F.col("lam")
        moved = state.join(sums, F.col("ms").eqNullSafe(F.col("os")), "left").select(
            "ms", "target", "unit", "lam", gap.alias("gap"), "curve",
            F.when(gap < 0, lam).otherwise(F.col("low")).alias("low"), F.when(gap >= 0, lam).otherwise(F.col("high")).alias("high"),
            (F.col("done") | (F.abs(gap) <= TOLERANCE * F.col("target"))).alias("done"),
        )
        gap = F.col("gap")
        step = lam - gap / F.greatest(F.col("curve"), F.lit(1e-300))
        # a step that leaves the bracket, or flies off where the curve is flat, is replaced
        reach = 2 * F.greatest(F.abs(lam), F.lit(1.0))
        inside = F.coalesce(step > F.col("low"), F.lit(True)) & F.coalesce(step < F.col("high"), F.lit(True))
        halved = F.coalesce((F.col("low") + F.col("high")) / 2, lam + F.when(gap < 0, reach).otherwise(-reach))
        new = F.when(F.col("done"), lam).when(inside & (F.abs(step - lam) <= reach), step).otherwise(halved)
        state = written(moved.select("ms", "target", "unit", new.alias("lam"), "low", "high", "done"), "multipliers")
    return state.select("ms", (F.col("lam") * F.col("unit")).alias("lam"))


def _copies(groups: pd.DataFrame) -> pd.DataFrame:
    """Whole and extra copies of one source's sizes (as many rows as there are
    different sizes, however many documents) from their rates: from the largest
    size down, the words that rounding gives too much or too little are carried
    to the next, so the source ends about half its smallest size from its target."""
    groups = groups.sort_values("sz", ascending=False, ignore_index=True)
    size, n, rate = (groups[c].to_numpy() for c in ("sz", "n", "rate"))
    whole = np.floor(rate)
    part = (rate - whole) * n
    extra, carry = np.zeros(len(groups), dtype=np.int64), 0.0
    for i in range(len(groups)):
        want = part[i] * size[i] + carry
        extra[i] = min(max(round(want / size[i]), 0), n[i] if whole[i] < MOST else 0)
        carry = want - extra[i] * size[i]
    return pd.DataFrame({"src": groups["src"], "sz": size, "whole": whole.astype(np.int64), "extra": extra})


def mix_plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """(src, sz, source_size, target, whole, last): documents of source `src`
    and size `sz` get `whole` copies, and one more if their spot is at most `last`."""
    targets = written(source_targets(sized, weights, share), "targets")
    hist = written(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    t = targets.withColumnRenamed("source", "ts")
    sized_hist = hist.where("size > 0")
    lam = multipliers(sized_hist, targets)
    power = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -F.col("lam") * F.col("size")))
    rate = F.when(F.col("lam") == float("inf"), MOST).when(F.col("lam") == float("-inf"), 0.0).otherwise(MOST / (1 + F.exp(power)))
    g = sized_hist.join(lam, F.col("source").eqNullSafe(F.col("ms")))
    g = g.select(F.col("source").alias("src"), F.col("size").alias("sz"), "n", rate.alias("rate"))
    g = written(g.groupBy("src").applyInPandas(_copies, "src string, sz long, whole long, extra long"), "groups")

    # the spot of the last document with an extra copy: ranks in two levels, by
    # spans of the hash and then inside a span, so no group is one window
    n_spans = max(1, sized.count() // BLOCK)
    span = F.floor((F.col("spot").cast("double") / 2.0**64 + 0.5) * n_spans)
    d = sized.where("size > 0").select("source", "size", "spot", span.alias("span"))
    spans = d.groupBy("source", "size", "span").agg(F.count("*").alias("c"))
    first = F.sum("c").over(Window.partitionBy("source", "size").orderBy("span")) - F.col("c")
    open_ = spans.withColumn("first", first).join(
        g.where("extra > 0"), F.col("source").eqNullSafe(F.col("src")) & (F.col("size") == F.col("sz"))
    )
    # only the span in which a group's last extra copy falls needs ranks
    open_ = open_.where("first < extra AND extra <= first + c").select(
        "src", "sz", F.col("span").alias("in_span"), (F.col("extra") - F.col("first")).alias("rank")
    )
    near = d.join(open_, d["source"].eqNullSafe(F.col("src")) & (F.col("size") == F.col("sz")) & (F.col("span") == F.col("in_span")))
    near = near.withColumn("k", F.row_number().over(Window.partitionBy("src", "sz").orderBy("spot")))
    last = near.where("k = rank").select(F.col("src").alias("s"), F.col("sz").alias("z"), F.col("spot").alias("last"))
    known = g.join(last, g["src"].eqNullSafe(F.col("s")) & (g["sz"] == F.col("z")), "left").select("src", "sz", "whole", "last")
    k = known.withColumnRenamed("src", "ks").withColumnRenamed("sz", "kz")
    sizes_of = hist.join(t, hist["source"].eqNullSafe(F.col("ts")))
    return sizes_of.join(k, F.col("source").eqNullSafe(F.col("ks")) & (F.col("size") == F.col("kz")), "left").select(
        F.col("source").alias("src"), F.col("size").alias("sz"), "source_size", "target", F.coalesce("whole", F.lit(0)).alias("whole"), "last"
    )


#: Largest plan, in rows of under 100 bytes, that is broadcast; a larger one is joined by a shuffle.
PLAN_ROWS = 1 << 17


def _with_copies(rows: DataFrame, plan: DataFrame, source: str, size: str, spot: str) -> DataFrame:
    plan = written(plan, "plan")
    plan = F.broadcast(plan) if fits(plan, PLAN_ROWS) else plan
    joined = rows.join(plan, rows[source].eqNullSafe(F.col("src")) & (rows[size] == F.col("sz")))
    extra = F.coalesce(F.col(spot) <= F.col("last"), F.lit(False)).cast("long")
    return joined.withColumn("copies", F.col("whole") + extra)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for every row of `docs`."""
    sized = written(sizes(docs), "sized")
    out = _with_copies(sized, mix_plan(sized, weights, share), "source", "size", "spot")
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it (0, 1 or 2 times), columns unchanged."""
    sized = written(sizes(docs), "sized")
    plan = mix_plan(sized, weights, share)
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"))
    rows = whole.select(
        "doc", F.col("doc.source").alias("source"), word_counts(F.col("doc.text")).alias("size"),
        _spot(F.col("doc.doc_id"), F.col("doc.text")).alias("spot"),
    )
    out = _with_copies(rows, plan, "source", "size", "spot").where("copies > 0")
    return out.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
