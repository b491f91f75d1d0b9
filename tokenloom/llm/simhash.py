"""Operator 3, SimHash near-duplicates with pigeonring filtering.

A fingerprint's 64 bits are cut into four consecutive 16-bit segments on a
ring.  If two fingerprints differ in at most 3 bits, then from some segment on
every chain of 1, 2, 3, 4 consecutive segments differs in at most 3/4, 6/4,
9/4, 12/4 bits, that is 0, 1, 2, 3.  A chain of two segments with budgets 0
and 1 means: one segment equal, and one half of the next equal.  So candidates
share (segment, half of the next segment), 24 bits; inside such a bucket the
third segment's budget prunes pairs before the full Hamming distance is taken.

Only distinct fingerprints are bucketed, so exact copies cost one row.  A
bucket of more than GROUP fingerprints is not compared as a whole: its free
bits are cut into four parts, of which 3 differing bits leave one equal, and
its members are bucketed again by one part more, until every bucket is small.
That loses no pair, and ends: a bucket with 11 free bits holds 2,048 at most.
Buckets pass on a spanning forest of their links, not the links.

Defined results: a null or empty text has fingerprint 0 and is linked like any
other; one row per input row; rows with a null doc_id get the smallest doc_id
of their component, null if it has none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import fits, kept, numbered, rows_of, slices, written
from tokenloom.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
#: Most fingerprints of a bucket that are compared with each other.
GROUP = 2048
FULL = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A-Z lowered, words between space and controls 9 to 13 (as bytes.split
    takes them), XXH64 with seed 42 of each run of words; a bit is 1 if more
    than half the hashes have it."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [h(b" ".join(words), 42)]
    else:
        hashes = [h(b" ".join(run), 42) for run in zip(*(words[i:] for i in range(shingle)))]
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.array(hashes[at : at + 4096], dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    ones = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(row, doc_id, fp long) of every row of `rows` (row, doc_id, text)."""
    rows = rows_of(rows, "row", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(("simhash",))
        for b in slices(batches):
            fps = [_signed(fingerprint(t, shingle)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], ["row", "doc_id", "fp"])

    return rows.mapInArrow(run, "row long, doc_id long, fp long")


def root_masks() -> list[tuple[int, int]]:
    """(first segment, mask of the fixed bits): a segment and a half of the next."""
    out = []
    for i in range(4):
        for half in range(2):
            out.append((i, (0xFFFF << 16 * i) | (0xFF << (16 * ((i + 1) % 4) + 8 * half))))
    return out


@lru_cache(maxsize=1 << 16)
def child_masks(mask: int) -> list[int]:
    """`mask` with one of four parts of its free bits fixed as well."""
    free = [b for b in range(64) if not mask >> b & 1]
    cut = [round(len(free) * k / 4) for k in range(5)]
    return [mask | sum(1 << b for b in free[cut[k] : cut[k + 1]]) for k in range(4)]


def _close(x: np.ndarray, start: np.ndarray, max_bits: int) -> np.ndarray:
    """Which differences (XOR) pass the chain budgets from segment `start` on, and then the full distance."""
    seg = [np.bitwise_count((x >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int16) for k in range(4)]
    seg = np.stack(seg)
    at = np.arange(len(x))
    total = np.zeros(len(x), dtype=np.int16)
    ok = np.ones(len(x), dtype=bool)
    for length in (1, 2, 3):
        total += seg[(start + length - 1) % 4, at]
        ok &= 4 * total <= length * max_bits
    full = np.zeros(len(x), dtype=bool)
    full[ok] = np.bitwise_count(x[ok]) <= max_bits
    return full


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(max_bits: int):
    """Rows (start, mask, value, fp) sorted by bucket -> forest links (u, v)."""

    def group(start, mask, value, fp):
        n = len(fp)
        at = np.arange(n - 1)
        a, b = [], []
        lag = 1
        while len(at):
            at = at[at + lag < n]
            at = at[(mask[at] == mask[at + lag]) & (value[at] == value[at + lag])]
            ok = _close(fp[at] ^ fp[at + lag], start[at], max_bits)
            a.append(at[ok])
            b.append(at[ok] + lag)
            lag += 1
        a, b = np.concatenate(a), np.concatenate(b)
        label = _forest(n, a, b)
        keep = np.flatnonzero(label != np.arange(n))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[keep].view(np.int64)), pa.array(fp[label[keep]].view(np.int64))], ["u", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols[3] = cols[3].view(np.uint64)
            if rest is not None:
                cols = [np.concatenate(p) for p in zip(rest, cols)]
            start, mask, value, fp = cols
            change = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
            cut = int(change[-1]) + 1 if len(change) else 0
            rest = [c[cut:] for c in cols]
            if cut > 1:
                yield group(*(c[:cut] for c in cols))
        if rest is not None and len(rest[3]) > 1:
            yield group(*rest)

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """Links (u, v) that join all distinct fingerprints `fp` within `max_bits`
    (3 at most, the budget of the four-segment ring) into their components."""
    if not 0 <= max_bits <= 3:
        raise ValueError("four segments serve distances up to 3")
    distinct = fps.select("fp").distinct()
    keys = F.array(*(F.struct(F.lit(i).alias("start"), F.lit(_signed(m)).alias("mask")) for i, m in root_masks()))
    keyed = distinct.select("fp", F.explode(keys).alias("k")).select(
        "k.start", "k.mask", F.expr("fp & k.mask").alias("value"), "fp"
    )
    out = None
    while True:
        sizes = keyed.groupBy("mask", "value").agg(F.count("*").alias("size")).where("size > 1")
        sized = keyed.join(sizes, ["mask", "value"])
        sized = written(sized.select("start", "mask", "value", "fp", "size"), "buckets")
        # 8 free bits hold 256 fingerprints at most
        fit = (F.col("size") <= group) | (F.bit_count("mask") >= 56)
        small = sized.where(fit).select("start", "mask", "value", "fp")
        found = small.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(_links(max_bits), "u long, v long")
        out = found if out is None else out.unionByName(found)
        large = sized.where(~fit)
        if large.isEmpty():
            return out

        def refine(batches):
            for b in batches:
                start, mask, fp = (b.column(k).to_numpy() for k in (0, 1, 3))
                child = np.array([[_signed(c) for c in child_masks(int(m) & FULL)] for m in mask], dtype=np.int64).reshape(-1)
                many = np.repeat(fp, 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(start, 4)), pa.array(child), pa.array(many & child), pa.array(many)],
                    ["start", "mask", "value", "fp"],
                )

        keyed = large.mapInArrow(refine, "start int, mask long, value long, fp long").distinct()


def _classified(rows: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(row, doc_id, fp, first) of `rows` (row, doc_id, text): `first` has the smallest doc_id `id` of the
    component, nulls last, and its first row."""
    fps = written(fingerprints(rows, shingle), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "row")
    groups = fps.groupBy("fp").agg(F.min(place).alias("first"))
    labels = connected_components(links(fps, max_bits))
    classes = groups.join(labels, groups.fp == labels.node, "left")
    classes = written(classes.select("fp", "first", F.coalesce("label", "fp").alias("label")), "classes")
    of = classes.join(classes.groupBy("label").agg(F.min("first").alias("lowest")), "label")
    of = of.select(F.col("fp").alias("f"), F.col("lowest").alias("first"))
    return fps.join(of, fps.fp == of.f).drop("f")


def simhash_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(row, doc_id, fingerprint hex, component_id) for every row of `docs`."""
    fingerprint_hex = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return _classified(rows, shingle, max_bits).select("row", "doc_id", fingerprint_hex, F.col("first.id").alias("component_id"))


#: Most rows to drop whose numbers are broadcast (8 MB); more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs`, columns unchanged, that come first in their component:
    smallest doc_id, then first row.

    `docs` is scanned once: its rows are written with their numbers, and both
    the search and the removal read that table."""
    whole = numbered(docs)
    found = _classified(whole.select("row", "doc.doc_id", "doc.text"), shingle, max_bits)
    drop = written(found.where(F.col("row") != F.col("first.row")).select(F.col("row").alias("drop")), "drop")
    drop = F.broadcast(drop) if fits(drop, BROADCAST_ROWS) else drop
    return whole.join(drop, F.col("row") == F.col("drop"), "left_anti").select("doc.*")
