"""Operator 13, source divergence audit: hash-consed segment trees over term ids.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased.  A
language keeps the terms in at least `min_docs` of its documents; a (lang,
source) group then has a count, zero or more, for each kept term, smoothed to
the exact integer share p = 1 + floor(10^9 (count + 5) / (N + 5 V)).

The divergence of two groups is the sum of |p - q| over all kept terms.  It is
priced on segment trees over term ids, a leaf being a count:

* Term ids are dealt by size: terms of one octave of total count share blocks,
  so rare terms, for which most groups count the same few occurrences, lie side
  by side.  A block of at most WIDTH ids is one tree; the trees of a block are
  built for all groups together, and equal subtrees, of whatever group and
  position, are one node (hash-consing: a node is its pair of children).
* Two groups' trees are walked together from the roots.  The frontier holds
  each node pair once with the number of places where it occurs, so a pair is
  priced once however often it comes again, down to pairs of counts.

Blocks are separate tasks; groups of a language are split into parts of about
GROUPS, and every pair of parts meets in its own task, so a task's size does
not grow with the vocabulary or with the number of sources.  The block sums
are added by an aggregation.  Counting is a map-side count per task and one
shuffle by (lang, term), which also decides which terms are kept.

Defined results: null text, lang and source count as ''; every row is a
document, repeated rows included; a group without terms has N = 0 and takes
part; a language without kept terms gives its pairs the value 0; an empty table
gives no rows; columns other than text, lang and source are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm.common import fits, slices, written
from tokenloom.session import ship_package

#: Ids of one block, a power of two: the leaves of a tree.
WIDTH = 4096
#: Sources of one part of a language, about.
GROUPS = 64
#: Counted (lang, source, term) rows that a task gathers before it passes them on.
FLUSH = 1 << 20
#: Most groups sent to every task; beyond, they are joined by a shuffle.
MOST_GROUPS = 1 << 17
SCALE, PRIOR = 1_000_000_000, 5

#: A byte as it is in a term: A-Z lower-cased, separators as spaces.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[:0x41] = _BYTES[0x5B:0x61] = _BYTES[0x7B:0x80] = 0x20
_BYTES[0x41:0x5B] += 0x20


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(text number, term) of every term of the texts."""
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    if not n or data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.int64), pa.array([], pa.string()).dictionary_encode()
    data = _BYTES[np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]]
    clean = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(data)])
    parts = pc.ascii_split_whitespace(clean)
    owner = np.repeat(np.arange(n), np.diff(parts.offsets.to_numpy()))
    flat = parts.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    return owner[real.to_numpy(zero_copy_only=False)], flat.filter(real).dictionary_encode()


def _counts(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, df) of the rows (lang, source, text)."""
    lang, source = (batch.column(i).dictionary_encode() for i in (0, 1))
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    owner, terms = _words(batch.column(2))
    m = max(1, len(terms.dictionary))
    in_doc, n = np.unique(owner * m + terms.indices.to_numpy(), return_counts=True)
    key, at = np.unique(group[in_doc // m] * m + in_doc % m, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, n)
    g = key // m
    columns = [
        lang.dictionary.take(pa.array(g // len(source.dictionary))) if len(key) else pa.array([], pa.string()),
        source.dictionary.take(pa.array(g % len(source.dictionary))) if len(key) else pa.array([], pa.string()),
        terms.dictionary.take(pa.array(key % m)) if len(key) else pa.array([], pa.string()),
        pa.array(total), pa.array(np.bincount(at, minlength=len(key)).astype(np.int64)),
    ]
    return pa.table(columns, ["lang", "source", "term", "n", "df"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a partition, summed over as much of it as FLUSH allows."""
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        whole = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("df", "sum")])
        return whole.select(["lang", "source", "term", "n_sum", "df_sum"]).rename_columns(["lang", "source", "term", "n", "df"])

    for b in slices(batches, 512):
        held.append(_counts(b))
        if sum(len(t) for t in held) > FLUSH:
            held = [summed()]
            if len(held[0]) > FLUSH // 2:
                yield from held.pop().to_batches(max_chunksize=1 << 16)
    if held:
        yield from summed().to_batches(max_chunksize=1 << 16)


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, total): occurrences of the kept terms in each
    group that has them, and in the language."""
    ship_package(docs.sparkSession)
    none = F.lit("")
    rows = docs.select(*(F.coalesce(docs[c], none).alias(c) for c in ("lang", "source", "text")))
    parts = rows.mapInArrow(_counted, "lang string, source string, term string, n long, df long")
    # one exchange by (lang, term): the sums per group and per language need no other
    dealt = parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_term = Window.partitionBy("lang", "term")
    whole = dealt.withColumns({"total": F.sum("n").over(of_term), "docs": F.sum("df").over(of_term)})
    return whole.where(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "total")


def term_ids(kept: DataFrame, width: int) -> DataFrame:
    """(lang, term, total, block, at): terms dealt into blocks of about half of
    `width` ids, terms of one octave of total count together, most frequent first."""
    terms = kept.groupBy("lang", "term").agg(F.max("total").alias("total"))
    terms = terms.withColumn("octave", F.floor(F.log2(F.col("total").cast("double"))))
    sizes = terms.groupBy("lang", "octave").agg(F.ceil(F.count("*") / (width // 2)).alias("parts"))
    dealt = terms.join(sizes, ["lang", "octave"]).withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")))
    # by part, too: the join alone would leave an octave of a language in one task
    dealt = dealt.repartition("lang", "octave", "part")
    at = F.row_number().over(Window.partitionBy("lang", "octave", "part").orderBy(F.desc("total"), "term")) - 1
    # a part that chance made longer than a block goes on in another block
    block = F.concat_ws(":", "octave", "part", F.floor(F.col("n") / width))
    return dealt.withColumn("n", at).select("lang", "term", "total", block.alias("block"), (F.col("n") % width).cast("int").alias("at"))


def share(n: str, size: str, terms: str):
    """The smoothed share of a count, exact: 1 + floor(10^9 (n + 5) / (size + 5 terms))."""
    return F.expr(f"1 + ({SCALE}BD * (CAST({n} AS DECIMAL(20,0)) + {PRIOR})) DIV (CAST({size} AS DECIMAL(20,0)) + {PRIOR} * CAST({terms} AS DECIMAL(20,0)))")


def _shares(counts: np.ndarray, size: int, terms: int) -> np.ndarray:
    """`share` of an array of different counts, as int64; exact at any size."""
    if len(counts) and int(counts.max()) < (1 << 62) // SCALE:
        return 1 + (SCALE * (counts + PRIOR)) // (size + PRIOR * terms)
    return np.array([1 + SCALE * (int(c) + PRIOR) // (size + PRIOR * terms) for c in counts], dtype=np.int64)


class Forest:
    """The hash-consed segment trees of several groups over one block: row i of
    `counts` is group i's count per id.  Nodes of a height are numbered; a node
    above the leaves is a pair of nodes of the height below."""

    def __init__(self, counts: np.ndarray):
        self.leaves, ids = np.unique(counts, return_inverse=True)
        ids = ids.reshape(counts.shape).astype(np.int64)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []  # by height, from 1
        size = len(self.leaves)
        while ids.shape[1] > 1:
            node, below = np.unique(ids[:, 0::2] * size + ids[:, 1::2], return_inverse=True)
            self.children.append((node // size, node % size))
            ids, size = below.reshape(ids.shape[0], -1), len(node)
        self.roots = ids[:, 0]

    def nodes(self) -> int:
        return len(self.leaves) + sum(len(left) for left, _ in self.children)

    def meet(self, a: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Group a's tree walked together with each of `others`: (which other,
        a's leaf, the other's leaf, places), each pair of leaves once an other;
        and the number of node pairs priced."""
        who = np.arange(len(others))
        x, y = np.full(len(others), self.roots[a]), self.roots[others]
        times = np.ones(len(others), np.int64)
        priced = len(others)
        for height in range(len(self.children) - 1, -1, -1):
            left, right = self.children[height]
            size = len(self.children[height - 1][0]) if height else len(self.leaves)
            who = np.concatenate([who, who])
            key = (who * size + np.concatenate([left[x], right[x]])) * size + np.concatenate([left[y], right[y]])
            key, at = np.unique(key, return_inverse=True)
            # times adds up to the block's width, which a double holds exactly
            times = np.bincount(at, weights=np.concatenate([times, times])).astype(np.int64)
            who, x, y = key // (size * size), key // size % size, key % size
            priced += len(key)
        return who, x, y, times, priced


def _priced(table: pa.Table) -> pa.Table:
    """One task's groups (part lo against part hi) over one block -> summed |p - q| of each pair."""
    # by name: a pair comes the same way round from every block
    rows = table.sort_by("source").combine_chunks()
    side, part_lo, part_hi = (rows[c].to_numpy() for c in ("part", "lo", "hi"))
    sizes, terms, wide = (rows[c].to_numpy() for c in ("size", "terms", "width"))
    names = rows["source"].to_pylist()
    leaves = 1
    while leaves < wide[0]:
        leaves *= 2
    counts = np.zeros((len(names), leaves), np.int64)
    for i, (at, n) in enumerate(zip(rows["ats"], rows["ns"])):
        if at.is_valid:
            counts[i, at.values.to_numpy()] = n.values.to_numpy()
    # places beyond the block's ids count for nobody: a leaf of their own, priced 0
    counts[:, wide[0] :] = -1
    forest = Forest(counts)
    real = forest.leaves >= 0
    shares = np.zeros((len(names), len(forest.leaves)), np.int64)
    for i in range(len(names)):
        if terms[i]:
            shares[i, real] = _shares(forest.leaves[real], int(sizes[i]), int(terms[i]))
    left, right, values = [], [], []
    for i in np.flatnonzero(side == part_lo):
        others = np.flatnonzero((side == part_hi) & ((side != side[i]) | (np.arange(len(names)) > i)))
        # few others at a time: the frontier stays within memory
        for start in range(0, len(others), 16):
            some = others[start : start + 16]
            who, x, y, times, _ = forest.meet(i, some)
            f = np.abs(shares[i, x] - shares[some[who], y]) * times
            total = np.zeros(len(some), np.int64)
            np.add.at(total, who, f)
            left += [names[i]] * len(some)
            right += [names[j] for j in some]
            values += total.tolist()
    lang = [rows["lang"][0].as_py()] * len(left)
    return pa.table([pa.array(lang, pa.string()), pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(values, pa.int64())], ["lang", "source", "item", "value"])


def pair_values(kept: DataFrame, ids: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways."""
    blocks = ids.groupBy("lang", "block").agg((F.max("at") + 1).alias("width"))
    # a language without terms has one block without ids, so that its pairs come out
    blocks = groups.select("lang").distinct().join(blocks, "lang", "left").fillna({"block": "", "width": 0})
    parts = groups.groupBy("lang").agg(F.ceil(F.count("*") / most).alias("parts"))
    part = F.pmod(F.xxhash64("source"), F.col("parts"))
    everyone = groups.join(parts, "lang").withColumn("part", part).join(blocks, "lang")
    entries = kept.join(ids, ["lang", "term"]).groupBy("lang", "block", "source").agg(F.collect_list(F.struct("at", "n")).alias("e"))
    entries = entries.select("lang", "block", "source", F.col("e.at").alias("ats"), F.col("e.n").alias("ns"))
    rows = everyone.join(entries, ["lang", "block", "source"], "left")
    # each part meets every part, itself included, in a task of its own
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.select("lang", "block", "source", "size", "terms", "width", "part", F.least("part", "o").alias("lo"), F.greatest("part", "o").alias("hi"), "ats", "ns")
    met = rows.groupBy("lang", "block", "lo", "hi").applyInArrow(_priced, "lang string, source string, item string, value long")
    one_way = met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    return one_way.select("lang", both.alias("p"), "value").select("lang", "p.source", "p.item", "value")


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, width: int = WIDTH, most: int = GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): every group's divergence from
    each other source of its language (part `pair`), and its `top` terms with a
    share above the language's (part `term`)."""
    kept = written(kept_counts(docs, min_docs), "kept_terms")
    ids = written(term_ids(kept, width), "term_ids")
    langs = ids.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    none = F.lit("")
    groups = docs.select(*(F.coalesce(docs[c], none).alias(c) for c in ("lang", "source"))).distinct()
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["size", "terms", "lang_size"])
    groups = written(groups, "groups")
    pairs = pair_values(kept, ids, groups, most).withColumn("part", F.lit("pair"))
    known = F.broadcast(groups) if fits(groups, MOST_GROUPS) else groups
    terms = kept.join(known, ["lang", "source"]).withColumns({"p": share("n", "size", "terms"), "q": share("total", "lang_size", "terms")})
    terms = terms.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), F.lit("term").alias("part"))
    of_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(of_group))
    best = terms.withColumn("rank", F.row_number().over(of_group)).where(F.col("rank") <= top)
    return ranked.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
