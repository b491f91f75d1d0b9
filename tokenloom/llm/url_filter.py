"""Operator 12, URL filters: rules first, then a character language-model ratio.

A url's host and path are held against a list of rules; the longest rule that
fits gives the verdict.  Urls without a rule are judged by two smoothed
variable-order Markov models over the characters of host and path, one learned
from the urls that rules allow and one from those that rules block:

* The counts of all substrings of up to ORDER + 1 characters, over all urls
  with a rule, are one map-side count and one aggregation.  A context is
  extended only while its strings hold at least one in SHARE of all characters
  (and two), so a model has at most (ORDER + 1) x SHARE strings whatever the
  corpus: the order varies with the evidence, and the model is safe to send.
* A character's chance after a context is Witten and Bell's: its count there,
  and for the escape the chance after the next shorter context.  What is not
  stored below a context belongs to the escape, so chances add up to one.
* A url's score is the sum of log chances, allowed less blocked, divided by the
  number of characters.  Verdict: allow from a threshold on.  It is calibrated
  on the urls that have a rule, each scored by models of the other half of the
  urls (halves by hash of host and path, so copies stay together): the boundary
  with the largest difference between the shares of allowed and blocked urls
  that reach it, ties to the one nearest zero, then the smaller (boundaries are
  multiples of 1 / STEPS).

Defined results: a null url, or one without `://`, has an empty host and path
and is scored like any other; every row gives one row, repeated rows and null
ids included; if no url, or urls of one verdict only, have a rule, the
threshold is 0, and a class without urls holds all characters equally likely;
other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import kept, slices, written
from tokenloom.session import ship_package

#: Most characters of a context.
ORDER = 5
#: A string of the model holds at least one in so many of all characters.
SHARE = 1 << 17
#: Steps of the calibration in a unit of score, and its largest score.
STEPS, LARGEST = 1024, 32
#: Strings that a task counts before it passes them on.
FLUSH = 1 << 19
START, END = "\x02", "\x03"

#: Names each run's models in the workers.
_RUNS = itertools.count()


def parsed(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id, host, path) of every row.  Host: what follows the first `://`, up to
    `/`, `?` or `#`, A-Z lower-cased; path: the rest up to `?` or `#`."""
    rows = pages.select(pages[id_col].alias("id"), F.coalesce(pages["url"], F.lit("")).alias("u"))
    rest = F.when(F.instr("u", "://") > 0, F.expr("substring(u, instr(u, '://') + 3)")).otherwise(F.lit(""))
    rows = rows.select("id", rest.alias("rest"))
    host = F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rows.select("id", host.alias("host"), F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def ruled(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """`urls` with the longest rule that fits (null: none) and its verdict.
    A rule is (`host/path`, verdict): it fits its host and all subdomains of it
    if the url's path starts with the rule's; of equal lengths the first wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the last `when` is tried first, so the shortest rules go in first and of equal ones the later
    for text, says in sorted(reversed(rules), key=lambda r: len(r[0])):
        host, path = text.split("/", 1)
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return urls.withColumns({"rule": rule, "by_rule": verdict})


# ------------------------------------------------------------------ models
def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, class) -> (string, n0 .. n3): occurrences of every string of up to
    ORDER + 1 characters by class."""
    total: Counter = Counter()

    def out():
        by_string: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
        for (c, s), n in total.items():
            by_string[s][c] += n
        counts = zip(*by_string.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(by_string), pa.string()), *(pa.array(c, pa.int64()) for c in counts)], ["string", "n0", "n1", "n2", "n3"]
        )

    for batch in slices(batches, 1024):
        for text, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = START + text + END
            # a very long url is counted in parts of its starting places
            for begin in range(0, len(s), FLUSH):
                part = range(begin, min(begin + FLUSH, len(s)))
                for k in range(1, ORDER + 2):
                    total.update((c, s[i : i + k]) for i in part if i + k <= len(s))
                    if len(total) > FLUSH:
                        yield out()
                        total.clear()
    if total:
        yield out()


def string_counts(urls: DataFrame) -> DataFrame:
    """(string, n0, n1, n2, n3): occurrences by class over urls (text, class)."""
    counts = urls.select("text", "class").mapInArrow(_strings, "string string, n0 long, n1 long, n2 long, n3 long")
    return counts.groupBy("string").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "n2", "n3")))


class Markov:
    """A variable-order Markov model: counts by string, escapes by context."""

    def __init__(self, counts: dict[str, int], symbols: int):
        self.n, self.symbols = counts, symbols
        self.kinds: Counter = Counter()
        self.below: Counter = Counter()
        for s, n in counts.items():
            if s != START:  # the start is a context, never a character to come
                self.kinds[s[:-1]] += 1
                self.below[s[:-1]] += n
        self.total = self.below[""]

    def chance(self, context: str, c: str) -> float:
        """P(c | context), from the empty context to longer ones."""
        p = 1.0 / (self.symbols + 1)
        for k in range(len(context), -1, -1):
            ctx = context[k:]
            n = self.n.get(ctx, 0) if ctx else self.total
            if not n:
                break  # no longer context was seen either
            kinds = self.kinds[ctx]
            p = (self.n.get(ctx + c, 0) + (kinds + n - self.below[ctx]) * p) / (n + kinds)
        return p


class Ratio:
    """Log chance of a text's characters, allowed less blocked, a character."""

    MEMO = 1 << 19

    def __init__(self, allowed: dict[str, int], blocked: dict[str, int]):
        symbols = len({s for n in (allowed, blocked) for s in n if len(s) == 1 and s != START})
        self.models = Markov(allowed, symbols), Markov(blocked, symbols)
        self.known: dict[str, float] = {}

    def _of(self, s: str) -> float:
        a, b = (m.chance(s[:-1], s[-1]) for m in self.models)
        return math.log(a) - math.log(b)

    def score(self, text: str) -> float:
        s, known, total = START + text + END, self.known, 0.0
        if len(known) > self.MEMO:
            known.clear()
        for i in range(1, len(s)):
            key = s[max(0, i - ORDER) : i + 1]
            x = known.get(key)
            if x is None:
                x = known[key] = self._of(key)
            total += x
        return total / (len(s) - 1)


def ratios(rows: list[tuple]) -> list[Ratio]:
    """Three ratios from (string, allowed and blocked of half 0, of half 1):
    for half 0 from half 1, for half 1 from half 0, and for other urls from both."""
    pick = lambda of: {r[0]: n for r in rows if (n := of(r))}
    return [
        Ratio(pick(lambda r: r[3]), pick(lambda r: r[4])),
        Ratio(pick(lambda r: r[1]), pick(lambda r: r[2])),
        Ratio(pick(lambda r: r[1] + r[3]), pick(lambda r: r[2] + r[4])),
    ]


def boundary(bins: list[tuple[int, int, int]]) -> int:
    """The calibrated step from (step, allowed, blocked): see the module's text."""
    allowed, blocked = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not allowed or not blocked:
        return 0
    ordered = sorted(bins, reverse=True)
    below = [b[0] for b in ordered[1:]] + [-LARGEST * STEPS - 1]
    best, above_a, above_b = None, 0, 0
    for (step, a, b), under in zip(ordered, below):
        above_a, above_b = above_a + a, above_b + b
        # every step after `under` up to this one parts the urls alike
        at = min(max(0, under + 1), step)
        found = (above_a * blocked - above_b * allowed, -abs(at), -at)
        best = max(best, found) if best else found
    return -best[2]


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", share: int = SHARE) -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row of `pages`."""
    spark = pages.sparkSession
    ship_package(spark)
    urls = ruled(parsed(pages, id_col), rules)
    half = F.pmod(F.xxhash64("host", "path"), F.lit(2)).cast("int")
    group = F.when(F.col("rule").isNull(), 2).otherwise(half)
    urls = urls.withColumns({"text": F.concat("host", "path"), "group": group})
    known = urls.where("rule IS NOT NULL").select("text", (F.col("group") * 2 + F.when(F.col("by_rule") == "allow", 0).otherwise(1)).cast("int").alias("class"))
    counts = written(string_counts(known), "url_strings")
    n = F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3")
    size = counts.where((F.length("string") == 1) & (F.col("string") != START)).agg(F.sum(n)).first()[0] or 0
    # at most (ORDER + 1) x share strings reach this count
    enough = counts.where(n >= max(2, -(-size // share)))
    model = spark.sparkContext.broadcast([tuple(r) for r in enough.collect()])
    owner = ("url filter", next(_RUNS))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = kept(owner, lambda: ratios(model.value))
        for b in slices(batches, 1024):
            groups, texts = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            scores = pa.array([of[g].score(t) for g, t in zip(groups, texts)], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], scores], [*b.schema.names[:-2], "score"])

    asked = urls.select("id", "host", "path", "rule", "by_rule", "group", "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields[:-2])
    out = written(asked.mapInArrow(scored, f"{fields}, score double"), "url_scores")
    step = F.floor(F.least(F.greatest(F.col("score"), F.lit(-LARGEST)), F.lit(LARGEST)) * STEPS)
    bins = out.where("rule IS NOT NULL").groupBy(step.alias("step")).agg(
        F.sum((F.col("by_rule") == "allow").cast("long")), F.sum((F.col("by_rule") != "allow").cast("long"))
    )
    least = boundary([tuple(r) for r in bins.collect()]) / STEPS
    by_model = F.when(F.col("score") >= least, "allow").otherwise("block")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score")
