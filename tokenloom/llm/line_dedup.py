"""Operator 5, line dedup: an exact set-similarity join of lines.

A line is a \\n-separated part of a document, its tokens the set of its words.
A line goes if an earlier line (smaller doc_id, then smaller line number) has a
Jaccard similarity of SIMILARITY or more with it.  Every line with a word takes
part (ANY_WORDS); with `min_words`, only lines of so many words or more.

1. One pass over the texts writes the lines' token sets (64-bit hashes), one row
   for the lines of a few MB of text: these share a dictionary of hashes.  From
   them the lines of each token are counted, in hash buckets.
2. Lines order their tokens by rarity: bucket count, then hash, one order for
   the whole corpus (the counts are a table of fixed size that every worker
   gets).  Two sets as similar as asked share a token of their prefixes, the
   first n - ceil(SIMILARITY * n) + 1 tokens.  Each line is listed under its
   prefix tokens, with its length, the token's position, and a 128-bit parity
   signature of the set.  Of equal sets only the earliest is listed, and sets so
   small that a similar one must be equal (under 4 words) are not: step 5 has
   the others.  Postings travel to the lists in rows of PACKED: those of one task
   and one bucket of keys as one compressed value.
3. The lists meet by token, in order of length, so that only lines near in length
   are compared; lists of many lines meet in order of place.  Pairs must pass the length filter, the positional
   filter (tokens left after the shared one) and the signature filter (every
   differing bit is a differing token).  A list of a hot token is cut into
   blocks by hash and its block pairs are dealt out; only tokens above BLOCK
   lines cost copies of rows.  In a list, a line passes on its KEPT earliest
   candidates; a line with more is looked at again.
4. Pairs are verified on the full token sets.  A line that one verified pair
   removes is done, so groups of near-copies never give all their pairs.  Lines
   that had more candidates and were not removed go through step 3 again with
   all their candidates: only they look there, all others are only met.
5. Lines whose set equals an earlier line's go without any pair: before the
   lists are made, one aggregation finds the first line of each set.

Tokens are 64-bit hashes, and sets are equal if the 64-bit sums of their mixed
hashes, their signatures and lengths are: a false match needs a collision there.
Every table but the rows and the removed lines is deleted once it is used up,
and the shuffles of a step are freed when its table is written.

Defined results: null and empty texts stay as they are; a document all of whose
lines go keeps its row with an empty text; ties (equal doc_ids) are broken by
the order of the rows; a null doc_id counts as later than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import discard, fits, ship_package, written
from tokenloom.llm.common import kept as kept_in_worker

SIMILARITY = 0.8
ANY_WORDS = 1
#: Buckets of the rarity table: the leading bits of a token's hash.
BUCKET_BITS = 17
REST_BITS = 64 - BUCKET_BITS
BLOCK = 1 << 15
#: Numbers of lines and places are counted up inside a partition, below its number.
PART_BITS = 33
#: Earliest candidates that a line passes on from one list in round one: few lines have more, so few lists are made again.
KEPT = 4

LINES = "id long, row long, doc_id long, line int, n int, same long, sign long, sign2 long, tokens array<long>"
#: LINES without the tokens.
HEADS = LINES.rsplit(", ", 1)[0]

#: The written token sets, one row for the lines of a few MB of text: the number of the first line, of the lines,
#: of their tokens and of the different ones; HEADS but the id; the different tokens' hashes and the lines' places in them.
BLOCKS = "first long, lines int, words int, kinds int, heads binary, hashes binary, tokens binary"
HEAD_TYPES = [np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, np.int64]

#: The columns of BLOCKS are compressed already.
PLAIN = {"compression": "none", "parquet.enable.dictionary": "false"}


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _chain(*steps):
    """One function of batches that runs `steps` one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    return run


def _packed(*columns: np.ndarray) -> bytes:
    """Number columns as one compressed value, byte by byte place: the leading
    bytes of small numbers are all alike and take next to no room."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.itemsize).T).tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(packed: pa.Scalar, n: int, types: list) -> list[np.ndarray]:
    """The columns of `n` numbers each that `_packed` was given."""
    widths = [np.dtype(t).itemsize for t in types]
    raw = np.frombuffer(pa.decompress(packed.as_buffer(), decompressed_size=n * sum(widths), codec="zstd"), np.uint8)
    parts = np.split(raw, np.cumsum(widths)[:-1] * n)
    return [np.ascontiguousarray(x.reshape(w, n).T).reshape(-1).view(t) for x, w, t in zip(parts, widths, types)]


def _words(texts: pa.Array, min_words: int):
    """(text, line number, number of tokens) of the lines with `min_words` words
    or more, and all their tokens, coded: the words are split, told apart and made
    sets for all texts at once, and each different word is hashed once."""
    from xxhash import xxh64_intdigest

    lines = pc.split_pattern(texts, "\n")
    per_text = np.diff(lines.offsets.to_numpy())
    words = pc.ascii_split_whitespace(lines.flatten())
    per_line = np.diff(words.offsets.to_numpy())
    flat = words.flatten()
    line = np.repeat(np.arange(len(per_line)), per_line)
    real = pc.binary_length(flat).to_numpy() > 0  # white space at either end leaves an empty part
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy()[real].astype(np.int64)
    line = line[real]
    different = coded.dictionary  # joined and split, which is much faster than one Arrow scalar a word
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(different)], pa.int32()), different.cast(pa.binary())), b"\n")
    hashes = np.fromiter(map(xxh64_intdigest, joined[0].as_py().split(b"\n") if len(different) else []), np.uint64, len(different))
    kept = np.bincount(line, minlength=len(per_line)) >= max(min_words, 1)
    if not kept.all():
        some = kept[line]
        line, codes = line[some], codes[some]
    both = np.sort(line << 32 | codes)
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    size = np.bincount(both >> 32, minlength=len(per_line))[kept]
    text = np.repeat(np.arange(len(per_text)), per_text)
    number = np.arange(len(per_line)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    codes = pa.array((both & 0xFFFFFFFF).astype(np.int32))
    return text[kept], number[kept], size, pa.DictionaryArray.from_arrays(codes, pa.array(hashes))


def _by_size(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most `size` bytes of text, or of one row."""
    for b in batches:
        ends, at = np.cumsum(pc.binary_length(b.column(2)).to_numpy().astype(np.int64)), 0
        while at < b.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield b.slice(at, stop - at)
            at = stop


def _token_sets(min_words: int):
    """Documents (row, doc_id, text) -> lines with their token sets, as BLOCKS.
    A line's id grows with row and line inside a partition, like row numbers do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << PART_BITS
        kept_in_worker(("lines",))
        for b in _by_size(batches):
            text, line, n, tokens = _words(b.column(2), min_words)
            if not len(n):
                continue
            codes, hashes = tokens.indices.to_numpy(), tokens.dictionary.to_numpy()
            starts = np.cumsum(n) - n
            mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            same = np.add.reduceat(mixed[codes], starts)  # equal sets have equal sums
            # a token flips one of 128 bits, in two words
            bit, low = np.uint64(1) << (mixed & np.uint64(63)), mixed & np.uint64(64) == 0
            sign, sign2 = (np.bitwise_xor.reduceat(np.where(x, bit, np.uint64(0))[codes], starts) for x in (low, ~low))
            row, doc = (b.column(i).to_numpy()[text] for i in (0, 1))
            heads = [x.astype(t, copy=False) for x, t in zip((row, doc, line, n), HEAD_TYPES)]
            values = (first, len(n), len(codes), len(hashes), _packed(*heads, same, sign, sign2), hashes.tobytes(), _packed(codes))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, _BLOCK_TYPES)], _names(BLOCKS))
            first += len(n)

    return run


_BLOCK_TYPES = [pa.int64(), *[pa.int32()] * 3, *[pa.binary()] * 3]


def token_blocks(rows: DataFrame, min_words: int = ANY_WORDS) -> DataFrame:
    return rows.mapInArrow(_token_sets(min_words), BLOCKS)


def _ids_of(b: pa.RecordBatch, i: int) -> np.ndarray:
    first = b["first"][i].as_py()
    return np.arange(first, first + b["lines"][i].as_py())


def _heads_of(b: pa.RecordBatch, i: int) -> list[np.ndarray]:
    """HEADS of row `i` of a batch of BLOCKS."""
    return [_ids_of(b, i), *_unpacked(b["heads"][i], b["lines"][i].as_py(), HEAD_TYPES)]


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _heads_of(b, i)], _names(HEADS))


def _lines_in(wanted=None, has=None):
    """BLOCKS -> LINES: those that `wanted` says of their ids, and that have a
    token that `has` says of the tokens' hashes, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                some = wanted(_ids_of(b, i)) if wanted else np.ones(b["lines"][i].as_py(), dtype=bool)
                hashes = np.frombuffer(b["hashes"][i].as_buffer(), np.int64)
                found = has(hashes.view(np.uint64)) if has else None
                if not some.any() or found is not None and not found.any():
                    continue
                heads = _heads_of(b, i)
                codes = _unpacked(b["tokens"][i], b["words"][i].as_py(), [np.int32])[0]
                if found is not None:
                    some &= np.logical_or.reduceat(found[codes], np.cumsum(heads[4]) - heads[4])
                if not some.all():
                    codes = codes[np.repeat(some, heads[4])]
                    heads = [x[some] for x in heads]
                ends = np.concatenate([[0], np.cumsum(heads[4])])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes[codes]))
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in heads), lists], _names(LINES))

    return run


def rarity(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each token bucket by its number of lines, lines by rank): two
    tables of 2 ** BUCKET_BITS numbers, whatever the corpus' size."""
    size = 1 << BUCKET_BITS

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            for words, kinds, hashes, tokens in zip(*b.columns):
                lines_of = np.bincount(_unpacked(tokens, words.as_py(), [np.int32])[0], minlength=kinds.as_py())
                bucket = np.frombuffer(hashes.as_buffer(), np.uint64) >> np.uint64(REST_BITS)
                total += np.bincount(bucket.astype(np.int64), lines_of, size).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["k", "n"])

    got = blocks.select("words", "kinds", "hashes", "tokens").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, dtype=np.int64)
    counts[got["k"].to_numpy()] = got["n"].to_numpy()
    order = np.argsort(counts, kind="stable")
    rank = np.empty(size, dtype=np.uint64)
    rank[order] = np.arange(size, dtype=np.uint64)
    return rank, counts[order]


#: Most lines that are marked by one bit each, in a table that every worker gets (16 MB); more are joined by a shuffle.
MARKED_LINES = 1 << 27


def _marks(ids: DataFrame):
    """A broadcast table of one bit per line number (or place) that has exactly
    the values of a one-column frame: (first word of each partition, words)."""
    name = ids.columns[0]
    bit = F.expr(f"shiftleft(1L, CAST(`{name}` & 63 AS INT))")
    paths: list[str] = []  # as a table, so that the shuffle is freed
    got = written(ids.groupBy(F.shiftright(name, 6).alias("k")).agg(F.bit_or(bit).alias("w")), "marks", paths).toPandas()
    discard(ids.sparkSession, paths)
    k, low = got["k"].to_numpy(np.int64), PART_BITS - 6
    part, word = k >> low, k & ((1 << low) - 1)
    size = np.zeros(int(part.max(initial=-1)) + 1, dtype=np.int64)
    np.maximum.at(size, part, word + 1)
    starts = np.concatenate([[0], np.cumsum(size)])
    words = np.zeros(int(starts[-1]) + 1, dtype=np.uint64)
    words[starts[part] + word] = got["w"].to_numpy(np.int64).view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast((starts, words))


def _marked(marks: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> np.ndarray:
    starts, words = marks
    part = np.minimum(ids >> PART_BITS, len(starts) - 1)
    spot = starts[part] + ((ids & ((1 << PART_BITS) - 1)) >> 6)
    inside = spot < starts[np.minimum(part + 1, len(starts) - 1)]
    bits = words[np.where(inside, spot, len(words) - 1)] >> (ids & 63).view(np.uint64)
    return inside & (bits & np.uint64(1)).astype(bool)


# `shape` packs 24 bits of n, 21 of pos and 2 of MET and LOOKING
POSTINGS = "key long, doc_id long, id long, sign long, sign2 long, shape long"


#: Lines of up to this many words are listed with a parity signature of 64 bits in place of 128, as they may differ in few words.
SHORT = 64

#: What a line does in its lists: it is met by later lines, it looks for earlier ones, or both.
MET, LOOKING, BOTH = 1, 2, 3


def _needed(n: np.ndarray, similarity: float) -> np.ndarray:
    """Smallest overlap or length, ceil(similarity * n), safe against rounding."""
    return np.ceil(similarity * n - 1e-9).astype(np.int64)


def _by_rarity(rank: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Sort values of tokens: the rank of the bucket in front, the other bits
    behind, so each is the token itself under another name, and sorting by it is
    sorting by rarity."""
    return rank[(tokens >> np.uint64(REST_BITS)).astype(np.int64)] << np.uint64(REST_BITS) | tokens & np.uint64((1 << REST_BITS) - 1)


def _postings(table, similarity: float, block: int, only=None, does: int = BOTH):
    """Lines -> one row per prefix token (and per block pair of a hot token).
    `only`: a bit table of the keys that are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, lines_of = table.value
        for b in batches:
            ids, doc, n, sign, sign2 = (b.column(k).to_numpy() for k in (0, 2, 4, 6, 7))
            n = n.astype(np.int64)
            sign, sign2 = np.where(n <= SHORT, sign ^ sign2, sign), np.where(n <= SHORT, 0, sign2)
            flat = _by_rarity(rank, b.column(8).flatten().to_numpy().view(np.uint64))
            ends = np.cumsum(n)
            for s, e in zip((ends - n).tolist(), ends.tolist()):
                flat[s:e].sort()
            owner = np.repeat(np.arange(len(n)), n)
            pos = np.arange(len(flat)) - np.repeat(ends - n, n)
            # a set one token larger is the nearest that is not equal
            near = n >= similarity * (n + 1) - 1e-9
            keep = (pos < (n - _needed(n, similarity) + 1)[owner]) & near[owner]
            flat, pos, owner = flat[keep], pos[keep], owner[keep]
            count = lines_of[(flat >> np.uint64(REST_BITS)).astype(np.int64)]
            keep = count > 1  # the token of a bucket of one line meets no other
            if only is not None:
                keep &= _has(only.value, flat)
            flat, pos, owner, count = flat[keep], pos[keep], owner[keep], count[keep]
            shape = (n[owner] << 40 | pos << 19 | does).astype(np.int64)
            if (count > block).any():
                parts = 1 + count // block
                spot = (ids[owner].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
                home = (spot % parts.astype(np.uint64)).astype(np.int64)
                copies = np.repeat(np.arange(len(flat)), parts)
                other = np.arange(len(copies)) - np.repeat(np.cumsum(parts) - parts, parts)
                part = np.minimum(home[copies], other) * (1 << 31) + np.maximum(home[copies], other)
                # a block pair of a hot token is a key of its own; pair 0, 0 keeps the token
                flat = flat[copies] + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                owner, shape = owner[copies], shape[copies]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (flat.view(np.int64), doc[owner], ids[owner], sign[owner], sign2[owner], shape)],
                _names(POSTINGS),
            )

    return run


#: Postings on their way to their lists: those that a task has for one bucket of keys.
PACKED = "bucket int, n int, postings binary"
PACKED_TYPES = [np.uint32, np.int64, np.int64, np.uint64, np.uint64, np.int32, np.int32, np.uint8]
#: Least number of buckets, lines a bucket beyond it (some ten postings each), and postings that a task packs at a time.
BUCKETS, LINES_A_BUCKET, PACK = 1024, 100_000, 1 << 18


def _by_bucket(buckets: int):
    """Postings -> rows of PACKED.  Of a key, the bucket and 32 other bits
    travel: where two keys fall together, their lists are one, with all pairs of
    both; what it adds fails the filters or the verification."""

    def packed(c: list[np.ndarray]) -> pa.RecordBatch:
        mixed = c[0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (mixed >> np.uint64(40)) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
        bucket = bucket[order].astype(np.int32)
        key, doc, ids, sign, sign2, shape = (x[order] for x in ((mixed & np.uint64(0xFFFFFFFF)).astype(np.uint32), *c[1:]))
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        # differences from the posting before, from zero at the start of a bucket
        steps = [np.diff(x, prepend=0) for x in (doc, ids)]
        for x, step in zip((doc, ids), steps):
            step[starts] = x[starts]
        columns = [key, *steps, sign, sign2, *((shape >> 40), shape >> 19 & 0x1FFFFF, shape & 3)]
        columns = [x.view(t) if x.itemsize == np.dtype(t).itemsize else x.astype(t) for x, t in zip(columns, PACKED_TYPES)]
        ends = np.append(starts[1:], len(bucket))
        rows = [_packed(*(x[lo:hi] for x in columns)) for lo, hi in zip(starts.tolist(), ends.tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[starts]), pa.array(ends - starts, pa.int32()), pa.array(rows, pa.binary())], _names(PACKED)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= PACK:
                yield packed([np.concatenate([x.column(i).to_numpy() for x in held]) for i in range(6)])
                held, n = [], 0
        if n:
            yield packed([np.concatenate([x.column(i).to_numpy() for x in held]) for i in range(6)])

    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED, sorted by bucket -> postings, a bucket's at a time, sorted by key and length."""

    def whole(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        key, doc, ids, sign, sign2, n, pos, does = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(key.astype(np.int64) << 24 | n)
        shape = n.astype(np.int64) << 40 | pos.astype(np.int64) << 19 | does
        columns = (key.astype(np.int64), doc, ids, sign.view(np.int64), sign2.view(np.int64), shape)
        return pa.RecordBatch.from_arrays([pa.array(x[order]) for x in columns], _names(POSTINGS))

    now, parts = None, []
    for b in batches:
        for bucket, n, postings in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if bucket != now and parts:
                yield whole(parts)
                parts = []
            key, doc, ids, *rest = _unpacked(postings, n, PACKED_TYPES)
            now = bucket
            parts.append([key, np.cumsum(doc), np.cumsum(ids), *rest])
    if parts:
        yield whole(parts)


PAIRS = "id long, n int, to long, to_n int, more boolean"


def _meet(similarity: float, kept: int | None, small: int = 512, chunk: int = 256, wide: int = 4096, step: int = 1 << 17):
    """Postings sorted by key -> candidate pairs, later line first.  Lists of up
    to `small` lines are put in order of length, so that a line meets those near
    in length only, about `step` pairs at a time; longer ones in order of place.

    `kept`: most candidates of a line from one list, None for all; `more` says
    that a list had, or may have had, further ones."""
    share = similarity / (1 + similarity)

    def near(ni, nj):
        return np.minimum(ni, nj) >= similarity * np.maximum(ni, nj) - 1e-9

    def passes(c, i, j):
        """Which of the lines at i and j, near in length, may be as similar as asked."""
        ni, nj = c["n"][i], c["n"][j]
        needed = np.ceil(share * (ni + nj) - 1e-9)
        # the shared token and what follows it on either side
        ok = np.minimum(ni - c["pos"][i], nj - c["pos"][j]) >= needed
        ok &= c["id"][i] != c["id"][j]
        some = np.flatnonzero(ok)
        i, j = i[some], j[some]
        x, y = c["sign"][i] ^ c["sign"][j], c["sign2"][i] ^ c["sign2"][j]
        apart = np.bitwise_count(x).astype(np.int64) + np.bitwise_count(y)
        # a short line has its two words in one: there, the longer one's are put together too
        apart = np.where(np.minimum(ni, nj)[some] <= SHORT, np.bitwise_count(x ^ y), apart)
        ok[some] = apart <= (ni + nj - 2 * needed)[some]
        return ok

    def in_large(c, lo, hi):
        """One large list: chunks of the earliest lines against all lines still
        looking; yields the pairs of a chunk at a time, (late, early, more)."""
        looking = lo + np.flatnonzero(c["shape"][lo:hi] & LOOKING)
        met = lo + np.flatnonzero(c["shape"][lo:hi] & MET)
        found = np.zeros(hi - lo, dtype=np.int64)
        for start in range(0, len(met), chunk):
            early = met[start : start + chunk]
            looking = looking[looking > early[0]]
            if not len(looking):
                break
            for at in range(0, len(looking), wide):
                late = looking[at : at + wide]
                ok = near(c["n"][early][:, None], c["n"][late][None, :])
                ok &= early[:, None] < late[None, :]
                e, x = np.nonzero(ok)
                ok[e, x] = passes(c, early[e], late[x])
                if kept is not None:
                    ok &= np.cumsum(ok, axis=0) + found[late - lo] <= kept
                found[late - lo] += ok.sum(axis=0)
                e, x = np.nonzero(ok)
                if len(e):
                    # a line that found `kept` may have had more
                    yield late[x], early[e], found[late[x] - lo] >= (kept or 1 << 60)
            if kept is not None:
                looking = looking[found[looking - lo] < kept]

    def in_small(c, group):
        """All lists of a few lines: (late, early, more) of some whole lists at a time."""
        order = np.argsort(group << 24 | c["n"], kind="stable")  # in order already if the lists came so
        c, group = {k: v[order] for k, v in c.items()}, group[order]
        longest = ((c["n"] + 1e-9) / similarity).astype(np.int64)
        to = np.searchsorted(group << 24 | c["n"], group << 24 | np.minimum(longest, (1 << 24) - 1), "right")
        met = to - np.arange(len(to)) - 1
        ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
        total = np.concatenate([[0], np.cumsum(met)])
        lo = 0
        while lo < len(group):
            k = np.searchsorted(total[ends], total[lo] + step, "right") - 1
            hi = int(ends[max(k, np.searchsorted(ends, lo, "right"))])
            i = np.repeat(np.arange(lo, hi), met[lo:hi])
            j = i + 1 + np.arange(len(i)) - np.repeat(total[lo:hi] - total[lo], met[lo:hi])
            ok = passes(c, i, j)
            i, j = i[ok], j[ok]
            di, dj = c["doc_id"][i], c["doc_id"][j]
            after = (di > dj) | (di == dj) & (c["id"][i] > c["id"][j])
            late, early = np.where(after, i, j), np.where(after, j, i)
            ok = (c["shape"][early] & MET > 0) & (c["shape"][late] & LOOKING > 0)
            late, early = late[ok], early[ok]
            more = np.zeros(len(late), dtype=bool)
            if kept is not None and len(late):
                order = np.lexsort((c["id"][early], c["doc_id"][early], late))
                late, early = late[order], early[order]
                at = np.arange(len(late))
                rank = at - np.maximum.accumulate(np.where(np.concatenate([[True], late[1:] != late[:-1]]), at, 0))
                many = np.unique(late[rank >= kept])
                late, early = late[rank < kept], early[rank < kept]
                more = np.isin(late, many)
            if len(late):
                yield out(c, late, early, more)
            lo = hi

    def batch(c):
        n = len(c["key"])
        c["n"], c["pos"] = c["shape"] >> 40, c["shape"] >> 19 & 0x1FFFFF
        first = np.concatenate([[True], c["key"][1:] != c["key"][:-1]])
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        size = np.repeat(ends - starts, ends - starts)
        some = np.flatnonzero((size <= small) & (size > 1))
        if len(some):
            yield from in_small({k: v[some] for k, v in c.items()}, np.cumsum(first)[some])
        for lo, hi in zip(starts[ends - starts > small].tolist(), ends[ends - starts > small].tolist()):
            order = lo + np.lexsort((c["id"][lo:hi], c["doc_id"][lo:hi]))
            part = {k: v[order] for k, v in c.items()}
            for found in in_large(part, 0, hi - lo):
                yield out(part, *found)

    def out(c, late, early, more):
        columns = [c["id"][late], c["n"][late].astype(np.int32), c["id"][early], c["n"][early].astype(np.int32), more]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _names(PAIRS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            c = {k: b.column(i).to_numpy() for i, k in enumerate(_names(POSTINGS))}
            c |= {k: c[k].view(np.uint64) for k in ("sign", "sign2")}  # bits of negative numbers are not counted
            if rest is not None:
                c = {k: np.concatenate([rest[k], c[k]]) for k in c}
            change = np.flatnonzero(c["key"][1:] != c["key"][:-1])
            cut = int(change[-1]) + 1 if len(change) else 0
            rest = {k: v[cut:] for k, v in c.items()}
            if cut > 1:
                yield from batch({k: v[:cut] for k, v in c.items()})
        if rest is not None and len(rest["key"]) > 1:
            yield from batch(rest)

    return run


#: Words of 64 bits in the tables that say which lines or keys are wanted.
BIT_WORDS = 1 << 17


def _spots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return (x >> np.uint64(6)).astype(np.int64) % BIT_WORDS, x & np.uint64(63)


def _has(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    word, bit = _spots(values)
    return (words[word] >> bit & np.uint64(1)).astype(bool)


def _bit_table(values: DataFrame):
    """A broadcast table of BIT_WORDS words that has every value of a one-column
    frame of longs, and few others while it is sparse: it spares shuffles, a
    join still decides."""

    def bits(batches):
        words = np.zeros(BIT_WORDS, dtype=np.uint64)
        for b in batches:
            word, bit = _spots(b.column(0).to_numpy())
            np.bitwise_or.at(words, word, np.uint64(1) << bit)
        k = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(words[k].view(np.int64))], ["k", "w"])

    got = values.mapInArrow(bits, "k long, w long").groupBy("k").agg(F.bit_or("w").alias("w")).toPandas()
    words = np.zeros(BIT_WORDS, dtype=np.uint64)
    words[got["k"].to_numpy()] = got["w"].to_numpy().view(np.uint64)
    return values.sparkSession.sparkContext.broadcast(words)


def _lines_of(blocks: DataFrame, ids: DataFrame, marked: bool) -> DataFrame:
    """The lines in the one-column frame `ids`, and of few others where there
    are too many lines to mark them by a bit each."""
    ids = ids.toDF("id")
    wanted, is_in = (_marks(ids), _marked) if marked else (_bit_table(ids), _has)
    return blocks.mapInArrow(_lines_in(lambda x: is_in(wanted.value, x)), LINES)


def _verified(pairs: DataFrame, blocks: DataFrame, marked: bool, similarity: float, paths: list[str]) -> DataFrame:
    """(id, more, gone) for every later line of `pairs`.  Token sets travel
    twice: the earlier lines' to the pairs, both to the later lines."""
    pairs = written(pairs.groupBy("id", "n", "to", "to_n").agg(F.max("more").alias("more")), "line_pairs", paths)
    early, late = (_lines_of(blocks, pairs.select(k), marked).select("id", "tokens") for k in ("to", "id"))
    both = pairs.join(early.toDF("to", "to_tokens"), "to").join(late, "id")
    overlap = F.size(F.array_intersect("tokens", "to_tokens"))
    near = overlap >= F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("to_n")) - 1e-9
    return both.groupBy("id").agg(F.max("more").alias("more"), F.max(near).alias("gone"))


def _pairs(listed: DataFrame, similarity: float, kept: int | None) -> DataFrame:
    """Candidate pairs of postings (PACKED)."""
    met = listed.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(_chain(_lists, _meet(similarity, kept)), PAIRS)


def duplicate_lines(
    rows: DataFrame, similarity: float = SIMILARITY, min_words: int = ANY_WORDS, kept: int = KEPT, block: int = BLOCK
) -> DataFrame:
    """(row, line): the lines to remove from `rows` (row, doc_id, text)."""
    spark = rows.sparkSession
    paths: list[str] = []
    blocks = written(token_blocks(rows, min_words), "lines", paths, **PLAIN)
    table = spark.sparkContext.broadcast(rarity(blocks))
    heads = blocks.select("first", "lines", "heads").mapInArrow(_heads, HEADS)
    total = blocks.agg(F.sum("lines")).first()[0] or 0
    marked, pack = total <= MARKED_LINES, _by_bucket(max(BUCKETS, total // LINES_A_BUCKET))
    # of equal sets, the lists hold the first
    first = heads.groupBy("same", "sign", "n").agg(F.min(F.struct("doc_id", "id")).alias("first")).select("first.id")
    if marked:
        firsts = _marks(first)
    else:
        first = written(first, "first_lines", paths)

    def listed(only=None, does: int = BOTH) -> DataFrame:
        has = only and (lambda tokens: _has(only.value, _by_rarity(table.value[0], tokens)))
        post = _chain(_postings(table, similarity, block, only, does), pack)
        if marked:
            return blocks.mapInArrow(_chain(_lines_in(lambda ids: _marked(firsts.value, ids), has), post), PACKED)
        sets = blocks.mapInArrow(_lines_in(has=has), LINES).join(first, "id", "left_semi").select(*_names(LINES))
        return sets.mapInArrow(post, PACKED)

    done = written(_verified(_pairs(listed(), similarity, kept), blocks, marked, similarity, paths), "line_results", paths)
    gone = done.where("gone").select("id")
    again = done.where("more AND NOT gone").select("id")
    if not again.isEmpty():
        # only the lists that such a line stands in
        some = written(_lines_of(blocks, again, marked).join(again, "id", "left_semi").select(*_names(LINES)), "again", paths)
        # whole lists: a block's key is not its token's
        keys = some.mapInArrow(_postings(table, similarity, 1 << 62), POSTINGS).select("key").distinct()
        looking = some.mapInArrow(_chain(_postings(table, similarity, block, None, LOOKING), pack), PACKED)
        pairs = _pairs(listed(_bit_table(keys), MET).unionByName(looking), similarity, None)
        gone = gone.unionByName(_verified(pairs, blocks, marked, similarity, paths).where("gone").select("id"))
    if marked:
        similar = _marks(gone)

        def removed(batches):
            for b in batches:
                for i in range(b.num_rows):
                    ids, row, _, line, *_ = _heads_of(b, i)
                    goes = ~_marked(firsts.value, ids) | _marked(similar.value, ids)
                    yield pa.RecordBatch.from_arrays([pa.array(row[goes]), pa.array(line[goes])], ["row", "line"])

        out = blocks.select("first", "lines", "heads").mapInArrow(removed, "row long, line int")
    else:
        stay = first.join(written(gone, "gone_ids", paths), "id", "left_anti")
        out = heads.join(stay, "id", "left_anti").select("row", "line")
    out = written(out, "gone")
    discard(spark, paths)
    return out


def _placed(docs: DataFrame) -> DataFrame:
    """(row, doc) of every row of `docs`, as a table; `row` is the place of the
    row's first line, places being counted up over all lines of a partition."""

    @F.arrow_udf("long")
    def first_place(counts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << PART_BITS
        for n in counts:
            ends = at + np.cumsum(n.to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.array(np.concatenate([[at], ends[:-1]]) if len(ends) else ends, pa.int64())
            at = int(ends[-1]) if len(ends) else at

    ship_package(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + F.lit(1)
    whole = docs.select(
        first_place.asNondeterministic()(lines.cast("long")).alias("row"), F.struct(*(docs[c] for c in docs.columns)).alias("doc")
    )
    return written(whole, "rows", compression="zstd")


def _shortened(gone) -> Column:
    """(text, lines removed) of (place of the first line, text), by the marks of the places that go."""

    @F.arrow_udf("text string, removed int")
    def cut(row: pa.Array, text: pa.Array) -> pa.Array:
        count = pc.fill_null(pc.count_substring(text, "\n"), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.cumsum(count)
        goes = np.zeros(0, dtype=bool)
        if len(ends) and ends[-1]:
            at = np.arange(ends[-1]) - np.repeat(ends - count, count)
            goes = _marked(gone.value, np.repeat(row.to_numpy(), count) + at)
        total = np.concatenate([[0], np.cumsum(goes)])
        removed = (total[ends] - total[ends - count]).astype(np.int32)
        change = np.flatnonzero(removed)
        if len(change):
            new = []
            for i, old in zip(change.tolist(), text.take(pa.array(change)).cast(pa.binary()).to_pylist()):
                stay = ~goes[ends[i] - count[i] : ends[i]]
                new.append(b"\n".join(compress(old.split(b"\n"), stay.tolist())))
            text = pc.replace_with_mask(text, pa.array(removed > 0), pa.array(new, pa.binary()).view(pa.string()).cast(text.type))
        return pa.StructArray.from_arrays([text, pa.array(removed)], ["text", "removed"])

    return cut("row", "doc.text")


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, min_words: int = ANY_WORDS) -> DataFrame:
    """`docs` without its later similar lines: the same rows and columns, `text`
    shortened and `n_chars`, if there, counted anew; one more column, __removed,
    has the number of lines taken out.

    `docs` is scanned once: its rows are written with their places, and both
    the search and the removal read that table.  The lines that go are marked by
    one bit each, so texts are not shuffled; beyond MARKED_LINES they are."""
    whole = _placed(docs)
    text = F.coalesce("doc.text", F.lit(""))
    last = F.lit((1 << 63) - 1)
    rows = whole.select("row", F.coalesce("doc.doc_id", last).alias("doc_id"), text.alias("text"))
    gone = duplicate_lines(rows, similarity, min_words)
    if fits(gone, MARKED_LINES):
        out = whole.withColumn("new", _shortened(_marks(gone.select((F.col("row") + F.col("line")).alias("place")))))
        out = out.select("doc", "new.text", "new.removed")
    else:
        lists = gone.groupBy("row").agg(F.collect_list("line").alias("lines")).withColumnRenamed("row", "of")
        joined = whole.join(lists, F.col("row") == F.col("of"), "left")
        parts = F.split(F.col("doc.text"), "\n", -1)
        left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("lines"), i)), "\n")
        new = F.when(F.col("lines").isNull(), F.col("doc.text")).otherwise(left)
        out = joined.select("doc", new.alias("text"), F.coalesce(F.size("lines"), F.lit(0)).alias("removed"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text").alias(c))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            columns.append(F.when(F.col("removed") > 0, F.length("text").cast(kind)).otherwise(F.col(f"doc.`{c}`")).alias(c))
        else:
            columns.append(F.col(f"doc.`{c}`").alias(c))
    return out.select(*columns, F.when(F.col("removed") > 0, F.col("removed")).otherwise(0).alias("__removed"))
