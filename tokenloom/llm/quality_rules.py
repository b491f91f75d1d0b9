"""Operator 2, quality rules: base rules, and a hashed n-gram log-likelihood ratio.

Native: DataFrame functions only.

Base rules per text: counts of words, of characters in words, of symbols, of
repeated lines, and of words covered by 8-word windows that occur twice or more.

Verdict: words and word pairs are hashed into BUCKETS buckets.  Two multinomials
over the buckets are counted over whole texts, one of trusted target documents
and one of the raw corpus, both smoothed.  A document's score is the mean over
its n-grams of log(target / raw); it is kept if the score reaches a threshold.
The trusted documents are parted in two by a checksum of their ids: one half is
the target; the threshold is one number found from the other half, whose words
the target has not seen, and the distrusted documents: scores are rounded down
to STEP, counted per class, and of the thresholds that separate the classes
best the middle one is taken (0 without two classes).
Nothing is drawn at random: every document gets its verdict by its own text.

Defined results: null texts count as empty; an empty text has no words, fails
the base rules and is not kept; without trusted documents the base rules decide
alone; one row per input row, repeated rows and null ids included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import SPACES, fits, rows_of, written
from tokenloom.session import spread

WINDOW = 8
BUCKETS = 1 << 18
#: Pseudo-count of every bucket, in n-grams of the target, for both multinomials.
SMOOTHING = 1.0
STEP = 0.02
SYMBOLS = "#*$%&|<>"


def _words(text: Column) -> Column:
    """Words of a text; no empty strings."""
    return F.array_remove(F.split(text, SPACES), "")


def _chained(hashes: Column | str, distance: int) -> Column:
    """Hashes of runs twice as long: element i with element i + distance."""
    h = F.col(hashes) if isinstance(hashes, str) else hashes
    left = F.slice(h, 1, F.greatest(F.size(h) - distance, F.lit(0)))
    return F.transform(left, lambda x, i: F.xxhash64(x, F.get(h, i + distance)))


def hashed(rows: DataFrame) -> DataFrame:
    """`rows` with `ones` and `twos`: 64-bit hashes of the words of `text` and of neighbouring pairs."""
    rows = rows.withColumn("words", _words(F.col("text")))
    rows = rows.withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))
    return rows.withColumn("twos", _chained("ones", 1))


def _line_repeats(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """(row, doc_id, ones, twos, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every row."""
    rows = rows_of(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    t = F.col("text")
    counted = hashed(rows).select(
        "row", "doc_id", "ones", "twos",
        F.length(F.regexp_replace(t, SPACES, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.when(F.instr(t, "\n") > 0, _line_repeats(t)).otherwise(F.lit(0).cast("long")).alias("n_dup_lines"),
    )
    # hashes of the windows, from pairs of pairs; a text whose window hashes are all different has no repeats
    hashes = counted.withColumn("fours", _chained("twos", 2)).withColumn("windows", _chained("fours", 4)).drop("fours")
    found = F.size(F.array_distinct("windows")) < F.size("windows")
    # else: windows sorted by hash and place; those with an equal neighbour, by place; then the words they cover
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hashes = hashes.withColumn("placed", F.when(found, placed))
    size = F.size("placed")
    twice = F.filter(
        F.transform(
            "placed",
            lambda p, k: F.when(
                (p["h"] == F.get("placed", k - 1)["h"]) | (p["h"] == F.get("placed", k + 1)["h"]), p["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    hashes = hashes.withColumn("twice", F.when(size.isNotNull(), F.array_sort(twice)))
    covered = F.aggregate(
        F.transform("twice", lambda i, k: F.least(F.coalesce(F.get("twice", k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return hashes.select(
        "row", "doc_id", "ones", "twos", F.size("ones").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def _bucket(gram: str, buckets: int) -> Column:
    return F.pmod(F.col(gram), F.lit(buckets)).cast("int")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, llr): log(target / raw) per bucket that occurs; at most `buckets` rows.

    `trusted`: doc_id of the target documents, distinct."""
    rows = rows_of(docs, "doc_id", "text")
    marked = rows.join(trusted.select(trusted["doc_id"].alias("t")), F.col("doc_id") == F.col("t"), "left")
    grams = hashed(marked).select(F.col("t").isNotNull().alias("target"), F.explode(F.concat("ones", "twos")).alias("gram"))
    grams = grams.select("target", _bucket("gram", buckets).alias("bucket"))
    counts = written(
        grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("target").alias("target")), "buckets"
    )
    totals = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    if not totals["target"]:
        return counts.select("bucket", F.lit(0.0).alias("llr"))
    # both shares get the same extra mass, SMOOTHING target n-grams a bucket, so rare buckets say little
    expected = F.col("raw") * (totals["target"] / totals["raw"])
    return counts.select("bucket", F.log((F.col("target") + SMOOTHING) / (expected + SMOOTHING)).alias("llr"))


def scores(counted: DataFrame, ratios: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`counted` without its hashes, with score: the mean log ratio of a text's n-grams, 0 without any."""
    kept = [c for c in counted.columns if c not in ("row", "ones", "twos")]
    grams = counted.select("row", *kept, F.explode_outer(F.concat("ones", "twos")).alias("gram"))
    # at most `buckets` rows of 12 bytes
    joined = grams.join(F.broadcast(ratios), _bucket("gram", buckets) == F.col("bucket"), "left")
    # a text's n-grams stand together in one task, so nearly all of the sum is made before the shuffle
    summed = joined.groupBy("row").agg(*(F.first(c).alias(c) for c in kept), F.avg("llr").alias("score"))
    return summed.withColumn("score", F.round(F.coalesce("score", F.lit(0.0)), 9))


def in_target(doc_id: Column) -> Column:
    """The half of the trusted documents that the target is counted from."""
    return F.crc32(doc_id.cast("string")) % 2 == 0


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """The score that separates label 1 (at or above) from label 0 (below) best,
    as the sum of both classes' shares on their side; the middle of the best."""
    known = labels.select(labels["doc_id"].alias("id"), labels["quality"].alias("y")).where("y in (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y")).where((F.col("y") == 0) | ~in_target(F.col("id")))
    step = F.floor(F.col("score") / STEP).cast("long")
    found = scored.join(known, F.col("doc_id") == F.col("id")).groupBy(step.alias("s")).agg(
        F.sum(F.col("y")).alias("good"), F.sum(1 - F.col("y")).alias("bad")
    )
    # log ratios lie between the logs of the smoothed shares, so there are some thousand steps at most
    rows = {r["s"]: (r["good"], r["bad"]) for r in found.collect()}
    good, bad = sum(g for g, _ in rows.values()), sum(b for _, b in rows.values())
    if not good or not bad:
        return 0.0
    values, below_good, below_bad = {}, 0, 0
    for s in range(min(rows), max(rows) + 2):
        values[s] = round((good - below_good) / good + below_bad / bad, 12)
        below_good += rows.get(s, (0, 0))[0]
        below_bad += rows.get(s, (0, 0))[1]
    best = [s for s, v in values.items() if v == max(values.values())]
    return (best[0] + best[-1]) / 2 * STEP


#: Most trusted ids that are broadcast (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 1 << 20


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(row, doc_id, base counts, base_failed, score, kept) for every row of `docs`;
    `labels` (doc_id, quality 0/1) says which documents are trusted."""
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    trusted = trusted.where(in_target(F.col("doc_id")))
    trusted = F.broadcast(trusted) if fits(trusted, BROADCAST_IDS) else trusted
    docs = spread(docs)
    ratios = log_ratios(docs, trusted, buckets)
    scored = written(scores(base_counts(docs), ratios, buckets), "scored")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    least = threshold(scored.where(~failed), labels)
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= least))
