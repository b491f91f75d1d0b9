"""Operator 9, packing: documents into sequences by cutting-stock column generation.

Every document is tokenized once, whole, and one id is appended.  Full
sequences are cut off its front; the remainders are the stock problem's items.
Their length histogram (CLASSES classes of UNIT tokens, whatever the corpus'
size) goes to the driver, where `cutting_stock.plan` solves the linear program
over patterns and cuts by column generation and rounds it.  The patterns are
then assigned to ranked documents: the k-th remainder of a class (rank in two
levels, hash blocks and then inside a block) takes the k-th place that the
patterns have for its class, which is arithmetic on a table of at most a few
thousand intervals.  A sequence's offsets are sums inside that sequence.

Ids are never stored.  The checksum of a part of a remainder follows from
those up to its ends, because CRC-32 is linear.

Defined results: a null text counts as empty, and an empty text is one piece
that holds the appended id; each input row is a document of its own, repeated
rows included; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm import cutting_stock
from tokenloom.llm.common import kept, rows_of, slices, written

LENGTH = 2048
END_ID = 1
UNIT = 8
#: Remainders may be cut at multiples of so many tokens; checksums are kept there.
CUT = 128
#: Units of text that a worker remembers the ids of.
MEMO = 1 << 18
#: Documents in a hash block of the two-level ranks, about.
BLOCK = 4096

#: White space in any library's sense, for finding places where a space surely starts a token.
_SPACES = (0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)
_ODD = r"\s\x1c-\x1f\x85\xa0" + "".join(f"\\u{c:04x}" for c in _SPACES)
_NEAR = re.compile(f" [{_ODD}]|[{_ODD}] ")
_START = re.compile(f"(?<=[^{_ODD}])(?= [^{_ODD}])")
#: Units that both libraries are known to part alike: no "<" (special strings), no rare characters.
_PLAIN = re.compile(r"[\t\n\r -;=-~\xa1-\u02ff\u0370-\u0373\u0386-\u03ff\u0400-\u0482\u048a-\u052f\u2010-\u2027\u2030-\u2038]*\Z")
#: The pattern of byte-level pre-tokenization; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of whole texts by the tokenizers library, remembered per unit: a
    space and what follows up to the next.  Byte-level pre-tokenization parts
    at every space between two other characters, so units encode alone as they
    do in the text; next to further white space a text is not parted.

    `ranks`: the same vocabulary as a file of ranks.  Units of plain characters
    are then encoded by tiktoken, which gives the same ids three times faster;
    a test holds the two libraries against each other."""

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.plain = None
        if ranks:
            import tiktoken

            pairs = map(bytes.split, open(ranks, "rb").read().splitlines())
            table = {base64.b64decode(a): int(b) for a, b in pairs}
            self.plain = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.memo: dict[str, bytes] = {}
        self.found: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """The ids as unsigned little-endian 32-bit numbers."""
        if not text:
            return b""
        if _NEAR.search(text):
            units = _START.split(text)
        else:
            first, *rest = text.split(" ")
            units = [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]
        memo, found = self.memo, self.found
        new = [u for u in set(units) if u not in memo and u not in found]
        if new:
            keep = memo if len(memo) < MEMO else found
            if self.plain:
                encode = self.plain.encode_ordinary
                keep.update((u, array("I", encode(u)).tobytes()) for u in new if _PLAIN.match(u))
                new = [u for u in new if not _PLAIN.match(u)]
            got = self.library.encode_batch_fast(new, add_special_tokens=False)
            keep.update((u, array("I", e.ids).tobytes()) for u, e in zip(new, got))
        if found:
            return b"".join([memo[u] if u in memo else found[u] for u in units])
        return b"".join(map(memo.__getitem__, units))

    def forget(self) -> None:
        """Drops the units met since the memory is full; called between batches."""
        self.found.clear()


def encoder(path: str, ranks: str | None = None) -> Encoder:
    """One per worker process and file."""
    return kept(("packing", path), lambda: Encoder(path, ranks))


TOKENIZED = (
    "row long, doc_id long, doc_tokens long, full_crc array<long>, rest long, rest_crc long, cut_crc array<long>"
)


def tokenized(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int | None = END_ID, ranks: str | None = None
) -> DataFrame:
    """Per document: its number of ids, the checksums of its full sequences, and
    length, checksum and checksums up to each multiple of CUT of its remainder."""
    rows = rows_of(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    end = b"" if end_id is None else array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, ranks)
        ids_of = coder.ids
        for b in slices(batches, 2048):
            coder.forget()
            total, full, rest, rest_crc, cuts = [], [], [], [], []
            for text in b.column(2).to_pylist():
                ids = ids_of(text) + end
                n = len(ids) // 4
                at = n // length * length * 4
                total.append(n)
                full.append([zlib.crc32(ids[i : i + 4 * length]) for i in range(0, at, 4 * length)])
                crc, upto = 0, []
                for i in range(at, len(ids), 4 * CUT):
                    crc = zlib.crc32(ids[i : i + 4 * CUT], crc)
                    upto.append(crc)
                rest.append(n - at // 4)
                rest_crc.append(crc)
                cuts.append(upto[:-1])
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(total, pa.int64()), pa.array(full, longs), pa.array(rest, pa.int64()),
                 pa.array(rest_crc, pa.int64()), pa.array(cuts, longs)],
                ["row", "doc_id", "doc_tokens", "full_crc", "rest", "rest_crc", "cut_crc"],
            )

    return rows.mapInArrow(run, TOKENIZED)


def crc_of_second(whole: int, first: int, n_bytes: int) -> int:
    """Checksum of the last `n_bytes` of data with checksum `whole`, `first` being that of what precedes them."""
    zeros = bytes(n_bytes)
    return whole ^ zlib.crc32(zeros, first) ^ zlib.crc32(zeros)


class Places:
    """Where the k-th remainder of each class goes; all tables are bounded by the classes."""

    def __init__(self, patterns, cuts, counts: np.ndarray):
        m = len(counts)
        # items of a class, in order: its own remainders, then what cuts of larger classes add;
        # the first `used` of them are cut themselves
        size = np.concatenate([[0], counts])
        self.used = np.zeros(m + 1, dtype=np.int64)
        self.cuts: dict[int, list[tuple[int, int, int, int]]] = {}
        for (c, a), n in cuts.items():
            self.used[c] += n
            self.cuts.setdefault(c, []).append((int(self.used[c]), a, int(size[a]) + n, 0))
            size[a] += n
            self.cuts[c][-1] = (*self.cuts[c][-1][:3], int(size[c - a]) + n)
            size[c - a] += n
        self.lo: dict[int, list[int]] = {}
        self.to: dict[int, list[tuple[int, int, int]]] = {}
        filled, sequence = np.zeros(m + 1, dtype=np.int64), 0
        for pattern, times in patterns:
            place = 0
            for c in range(m, 0, -1):
                k = int(pattern[c - 1])
                if k:
                    self.lo.setdefault(c, []).append(int(filled[c]))
                    self.to.setdefault(c, []).append((sequence, k, place))
                    filled[c] += k * times
                    place += k
            sequence += times
        self.sequences = sequence
        if (filled != size - self.used).any():
            raise AssertionError("the patterns do not hold every item once")

    def pieces(self, c: int, index: int, start: int, end: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, end, sequence, place) of the pieces of item `index` of class c, which spans start..end."""
        if index >= self.used[c]:
            index -= int(self.used[c])
            i = bisect_right(self.lo[c], index) - 1
            sequence, k, place = self.to[c][i]
            n, at = divmod(index - self.lo[c][i], k)
            yield start, end, sequence + n, place + at
            return
        upto, a, end_a, end_b = next(x for x in self.cuts[c] if index < x[0])
        middle = start + a * UNIT
        yield from self.pieces(a, end_a - (upto - index), start, middle)
        yield from self.pieces(c - a, end_b - (upto - index), middle, end)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, place long"


def _pieces(places: Places, length: int):
    """Ranked documents -> pieces with their sequence and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[] for _ in range(7)]

            def piece(*values):
                for column, v in zip(out, values):
                    column.append(v)

            for r in b.to_pylist():
                doc, total, rest = r["doc_id"], r["doc_tokens"], r["rest"]
                for i, crc in enumerate(r["full_crc"]):
                    piece(doc, i * length, length, crc, total, places.sequences + r["first_full"] + i, 0)
                if not rest:
                    continue
                # a piece starts and ends at a multiple of CUT or at the remainder's ends
                upto = [0, *r["cut_crc"]]
                for start, end, *at in places.pieces(-(-rest // UNIT), r["rank"], 0, rest):
                    whole = r["rest_crc"] if end == rest else upto[end // CUT]
                    crc = crc_of_second(whole, upto[start // CUT], 4 * (end - start)) if start else whole
                    piece(doc, total - rest + start, end - start, crc, total, *at)
            names = [f.split()[0] for f in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names)

    return run


def pack(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int | None = END_ID, ranks: str | None = None
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for every piece."""
    if length % CUT or length % UNIT:
        raise ValueError(f"length must be a multiple of {CUT}")
    docs_ids = written(tokenized(docs, path, length, end_id, ranks), "tokenized")
    classes = length // UNIT
    cls = F.ceil(F.col("rest") / UNIT).cast("int")
    histogram = docs_ids.groupBy(cls.alias("c")).agg(F.count("*").alias("n")).collect()
    counts = np.zeros(classes, dtype=np.int64)
    n_docs = sum(r.n for r in histogram)
    for r in histogram:
        if r.c:
            counts[r.c - 1] = r.n
    places = Places(*cutting_stock.plan(counts, list(range(CUT // UNIT, classes, CUT // UNIT))), counts)

    # ranks in two levels: sums over hash blocks, then inside a block
    n_blocks = max(1, n_docs // BLOCK)
    d = docs_ids.withColumn("c", cls).withColumn("n_full", F.size("full_crc").cast("long"))
    d = d.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
    blocks = d.groupBy("block", "c").agg(F.count("*").alias("k"), F.sum("n_full").alias("f"))
    before = F.sum("k").over(Window.partitionBy("c").orderBy("block")) - F.col("k")
    by_class = blocks.select(F.col("block").alias("b"), F.col("c").alias("d"), before.alias("before"))
    full = blocks.groupBy("block").agg(F.sum("f").alias("f"))
    full = full.select(
        F.col("block").alias("bb"), (F.sum("f").over(Window.orderBy("block")) - F.col("f")).alias("full_before")
    )
    d = d.repartition("block")
    inside = F.row_number().over(Window.partitionBy("block", "c").orderBy("row")) - 1
    running = F.sum("n_full").over(Window.partitionBy("block").orderBy("row")) - F.col("n_full")
    d = d.withColumn("inside", inside).withColumn("running", running)
    d = d.join(by_class, (F.col("block") == F.col("b")) & F.col("c").eqNullSafe(F.col("d")))
    d = d.join(full, F.col("block") == F.col("bb"))
    ranked = d.select(
        "doc_id", "doc_tokens", "full_crc", "rest", "rest_crc", "cut_crc",
        (F.col("before") + F.col("inside")).alias("rank"), (F.col("full_before") + F.col("running")).alias("first_full"),
    )
    pieces = ranked.mapInArrow(_pieces(places, length), PIECES)
    # a sequence has at most `length` pieces
    upto = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("place")) - F.col("length")
    return pieces.withColumn("offset", upto).drop("place")
