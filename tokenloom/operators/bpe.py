"""Byte-level BPE vocabulary learning as an iterative DataFrame job.

State of the loop is the word table `words(sym string, n long)`: one row per
distinct piece, `sym` its current symbols as bracketed upper-case hex,
`<74><6865>`.  Because every symbol is bracketed, `replace(sym, '<l><r>',
'<lr>')` merges exactly the adjacent pair, left to right and without overlap,
and compares symbols by their bytes (two merge paths giving the same bytes give
the same symbol).  Hex text orders like unsigned bytes, so the greatest
`(count, left, right)` is the next merge.

A round guesses a run of merges from the most frequent words, has every word
say what each of them would change, and takes the guesses as far as each is the
best pair at its turn, so the merges are exactly the sequential ones.  Only the
bounded list of most frequent words and pairs ever reaches the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.merge_walk import Forecast, Words
from tokenloom.operators.pretoken import piece_bytes, word_frequencies
from tokenloom.session import cut_lineage, persist, ship_package


# ---------------------------------------------------------------- data types
@dataclass
class Tokenizer:
    """Vocabulary (id -> bytes), ordered merges and special tokens.

    The whole object is bounded by the vocabulary size (at most 65,536 ids for
    16-bit streams), so it may live on the driver and be broadcast."""

    vocab: dict[int, bytes]
    merges: list[tuple[bytes, bytes]]
    specials: list[str] = field(default_factory=list)
    merge_counts: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        """Specials missing from the vocabulary are registered after the
        largest id, in the given order; repeated ones count once."""
        self.specials = list(dict.fromkeys(self.specials))
        self.vocab = dict(self.vocab)
        known = set(self.vocab.values())
        for s in self.specials:
            if s.encode("utf-8") not in known:
                self.vocab[max(self.vocab, default=-1) + 1] = s.encode("utf-8")

    def digest(self) -> str:
        """A checksum of the content: equal tokenizers have equal digests."""
        h = hashlib.sha256()
        for part in (sorted(self.vocab.items()), self.merges, self.specials):
            h.update(repr(part).encode("utf-8", "surrogatepass"))
        return h.hexdigest()

    @staticmethod
    def from_merges(merges: list[tuple[bytes, bytes]], specials: list[str], counts=None) -> "Tokenizer":
        specials = list(dict.fromkeys(specials))
        vocab = init_vocab_dict(specials)
        k = len(specials)
        for i, (a, b) in enumerate(merges):
            vocab[256 + k + i] = a + b
        return Tokenizer(vocab, list(merges), list(specials), list(counts or []))

    def inverse(self) -> dict[bytes, int]:
        """bytes -> id; on equal bytes the greatest id wins."""
        inv: dict[bytes, int] = {}
        for i in sorted(self.vocab):
            inv[self.vocab[i]] = i
        return inv


def init_vocab_dict(specials: list[str]) -> dict[int, bytes]:
    """Specials get ids 0..k-1, the 256 single bytes k..k+255."""
    vocab = {i: s.encode("utf-8") for i, s in enumerate(specials)}
    k = len(specials)
    for b in range(256):
        vocab[k + b] = bytes([b])
    return vocab


# ------------------------------------------------------------ word table ops
def words_table(freqs: DataFrame) -> DataFrame:
    """(piece, n) -> (sym, n); words of one symbol can never pair, drop them."""
    return piece_bytes(freqs).where(F.length("piece") > 0).select("sym", "n").where(
        F.instr("sym", "><") > 0
    )


# every adjacent pair, found with a zero-width look-ahead at each symbol start
PAIR_RE = "(?=(<[0-9A-F]+><[0-9A-F]+>))"


_SPLIT_L = "split(substr(p, 2, length(p) - 2), '><')[0]"
_SPLIT_R = "split(substr(p, 2, length(p) - 2), '><')[1]"


def pair_counts(words: DataFrame) -> DataFrame:
    """Weighted count of adjacent symbol pairs: (l, r, c), hex symbols.

    Counting is per position, so `aaa` counts (a, a) twice.  Each pair is
    aggregated as one string key `<l><r>` (one hash per row) and split only
    on the distinct pairs.  Written as SQL expressions: the loop builds this
    plan every round, and few driver calls keep that cheap."""
    ex = words.selectExpr(f"explode(regexp_extract_all(sym, '{PAIR_RE}', 1)) AS p", "n")
    agg = ex.groupBy("p").agg(F.sum("n").alias("c"))
    return agg.selectExpr(f"{_SPLIT_L} AS l", f"{_SPLIT_R} AS r", "c")


def top_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The k best pairs in merge order: count, then left, then right, descending."""
    return pairs.orderBy(F.desc("c"), F.desc("l"), F.desc("r")).limit(k)


def best_pair(pairs: DataFrame) -> DataFrame:
    """One row: greatest count, ties to the greatest (left, right) bytes."""
    m = pairs.agg(F.max(F.struct("c", "l", "r")).alias("m"))
    return m.select("m.c", "m.l", "m.r").where(F.col("c").isNotNull())


def merge_sql(sym: str, merges: list[tuple[str, str]]) -> str:
    """SQL for applying hex merges in order: nested non-overlapping
    left-to-right replace (hex symbols need no quoting).  Few driver calls:
    the loop builds this plan every round."""
    for l, r in merges:
        sym = f"replace({sym}, '<{l}><{r}>', '<{l}{r}>')"
    return sym


def apply_merge(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """Replace accepted pairs in all words; words left with one symbol drop out."""
    return words.selectExpr(f"{merge_sql('sym', merges)} AS sym", "n").where("instr(sym, '><') > 0")


# ------------------------------------------------------------- training loop
#: Most frequent words that the driver forecasts merges from; a bounded list
#: that guides the rounds and never decides a merge.
HEAD_WORDS = 1 << 16
#: Words of more hex characters take no part in the forecast (they do in every count).
HEAD_WIDTH = 512
#: Most frequent pairs whose exact counts a forecast starts from.
RANKED = 1024
#: Word-table rows per partition of the loop, where there are fewer partitions
#: than cores, and the most of one partition.
WORDS_PER_PARTITION, MOST_WORDS = 20_000, 1 << 20
#: Hex characters of words that a task merges at a time, and rows it adds at a time.
CHUNK, SLICE = 1 << 22, 1 << 12


def _chunks(batches):
    """Arrow batches in groups of about CHUNK hex characters, as one each."""
    kept, size = [], 0
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            kept.append(part)
            size += pc.sum(pc.binary_length(part.column(0))).as_py() or 0
            if size >= CHUNK:
                yield pa.Table.from_batches(kept).combine_chunks()
                kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _column(t: pa.Table, i: int) -> pa.Array:
    return pa.concat_arrays(t.column(i).chunks)


def walked(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """The word table after the merges, in order."""
    ship_package(words.sparkSession)

    def run(batches):
        for t in _chunks(batches):
            w = Words(_column(t, 0))
            for pair in merges:
                w.merge(pair)
            yield pa.RecordBatch.from_arrays([w.bracketed(), _column(t, 1)], ["sym", "n"])

    return words.select("sym", F.col("n").cast("long")).mapInArrow(run, "sym string, n long")


def merge_changes(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """(step, l, r, n): by how much merge number `step` changes the count of
    each pair, were the merges applied one after the other."""
    ship_package(words.sparkSession)

    def run(batches):
        for t in _chunks(batches):
            w, n, out = Words(_column(t, 0)), t.column(1).to_numpy(), []
            for step, pair in enumerate(merges):
                found = w.merge(pair)
                if found is not None:
                    of, pairs, sign = found
                    keys, spot = np.unique(pairs, return_inverse=True)
                    total = np.zeros(len(keys), dtype=np.int64)
                    np.add.at(total, spot, sign * n[of])
                    out.append((np.full(len(keys), step, dtype=np.int32), keys, total))
            if out:
                at, keys, total = (np.concatenate(x) for x in zip(*out))
                names = pa.array(w.names, pa.string())
                l, r = names.take(pa.array(keys >> 32)), names.take(pa.array(keys & 0xFFFFFFFF))
                yield pa.RecordBatch.from_arrays([pa.array(at), l, r, pa.array(total)], ["step", "l", "r", "n"])

    parts = words.select("sym", F.col("n").cast("long")).mapInArrow(run, "step int, l string, r string, n long")
    return parts.groupBy("step", "l", "r").agg(F.sum("n").alias("n")).where("n != 0")


def best_by_step(pairs: DataFrame, changes: DataFrame, steps: int, least: float) -> list[tuple | None]:
    """For each number of merges done, 0 to `steps` - 1, the best pair (c, l, r)
    then, or None if no pair reaches `least`.

    A pair that no merge changes keeps its count, so the best of those is one
    row; a changed pair counts at each step what it had and gained so far.
    Pairs that never reach `least` are left out before they are spread over the
    steps, and at most `steps` + 1 rows reach the driver."""
    of_pair = changes.groupBy("l", "r").agg(F.collect_list(F.struct("step", "n")).alias("ch"))
    both = pairs.join(of_pair, ["l", "r"], "full_outer")
    counts = F.expr(
        f"transform(sequence(0, {steps - 1}), i -> coalesce(c, 0L) + aggregate(filter(ch, x -> x.step < i), 0L, (s, x) -> s + x.n))"
    )
    kept = F.when(F.col("ch").isNull(), F.array("c")).otherwise(counts)
    at = both.select("l", "r", F.col("ch").isNull().alias("still"), kept.alias("cs")).where(F.array_max("cs") >= F.lit(least))
    rows = at.select("l", "r", "still", F.posexplode("cs").alias("i", "c"))
    found = rows.groupBy("still", "i").agg(F.max(F.struct("c", "l", "r")).alias("m")).select("still", "i", "m.*").collect()
    still = max([(r.c, r.l, r.r) for r in found if r.still], default=None)
    best: list[tuple | None] = [still] * steps
    for r in found:
        if not r.still:
            best[r.i] = max((r.c, r.l, r.r), best[r.i] or (-1, "", ""))
    return [b if b and b[0] >= max(least, 1) else None for b in best]


def _head(words: DataFrame, most: int) -> list[tuple[str, int]]:
    """Up to `most` words, none less frequent than a word left out.  The words
    per frequency (64 steps an octave: few rows) tell where to stop, so no
    task sends more words than the driver keeps."""
    short = words.where(F.length("sym") <= HEAD_WIDTH)
    octave = F.floor(F.log2(F.greatest("n", F.lit(1))) * 64)
    by_octave = dict(short.groupBy(octave.alias("o")).agg(F.count(F.lit(1)).alias("k")).collect())
    size, least = 0, None
    for o in sorted(by_octave, reverse=True):
        if size + by_octave[o] > most:
            break
        size, least = size + by_octave[o], o
    if least is None:  # the most frequent words are too many, and alike
        return [(r.sym, r.n) for r in short.where(octave >= max(by_octave, default=0)).limit(most).collect()]
    return sorted(((r.sym, r.n) for r in short.where(octave >= least).collect()), key=lambda w: (-w[1], w[0]))


def train_bpe_words(
    words: DataFrame, num_merges: int, batch: int = 64, checkpoint_every: int = 4, head_words: int = HEAD_WORDS
) -> tuple[list[tuple[str, str]], list[int]]:
    """Learn up to `num_merges` merges from a word table; hex pairs + counts.

    A round guesses a run of merges (`Forecast`) and has all words say what
    each would change, one pass over the word table.  With the pair table, that
    gives the best pair after every number of merges; the guesses are taken as
    far as each is the best pair at its turn.  So the merges, ties and counts
    are those of the loop that merges one pair at a time, whatever was guessed,
    and pairs that overlap or build on each other pass in one round.  The first
    guess is the best pair of the table, so every round advances.  The pair
    table is kept and changed by the accepted merges' rows only; both tables
    are cut with reliable checkpoints every `checkpoint_every` rounds."""
    merges: list[tuple[str, str]] = []
    counts: list[int] = []
    words = cut_lineage(words)
    n_words = words.count()
    # AQE would coalesce this aggregate into one task, while a tiny table over
    # every core only adds per-task cost to every round
    cores = max(words.sparkSession.sparkContext.defaultParallelism, -(-n_words // MOST_WORDS))
    parts = max(1, min(cores, -(-n_words // WORDS_PER_PARTITION)))
    current = cut_lineage(words.repartition(parts))
    pairs = cut_lineage(pair_counts(current))
    forecast = Forecast(_head(current, head_words))
    most, rounds, stale, replaced = batch, 0, [], None
    while len(merges) < num_merges:
        known = {(r.l, r.r): r.c for r in top_pairs(pairs, RANKED).collect()}
        for df in stale:  # the tables that this round's job has just replaced
            df.unpersist()
        stale = []
        if not known or max(known.values()) < 1:
            break
        guesses = forecast.guess(known, min(most, num_merges - len(merges)))
        first = max(known, key=lambda p: (known[p], p))
        if not guesses or guesses[0][0] != first:
            guesses = [(first, float(known[first]))]
            forecast.accept(0)
            forecast.merge(first)
        step = [g for g, _ in guesses]
        changes = persist(merge_changes(current, step))
        # counts below half the last guess' are not looked at; a step whose best falls there is not taken
        best = best_by_step(pairs, changes, len(step), min(known[first], guesses[-1][1] / 2))
        if replaced is not None:
            replaced.unpersist()
        taken = 0
        while taken < len(step) and best[taken] and best[taken][1:] == step[taken]:
            counts.append(int(best[taken][0]))
            taken += 1
        merges += step[:taken]
        most = 2 * most if taken == len(step) else max(16, 2 * taken)
        rounds += 1
        if taken == 0 or len(merges) >= num_merges:
            changes.unpersist()
            break
        forecast.accept(taken)
        applied = changes.where(F.col("step") < taken).select("l", "r", F.col("n").alias("c"))
        nxt_pairs = pairs.unionByName(applied).groupBy("l", "r").agg(F.sum("c").alias("c")).where("c != 0")
        nxt_words = walked(current, step[:taken]).where("instr(sym, '><') > 0")  # one symbol never pairs
        if rounds % checkpoint_every == 0:
            nxt_pairs, nxt_words = cut_lineage(nxt_pairs), cut_lineage(nxt_words)
            for df in (changes, pairs, current):
                df.unpersist()
            replaced = None
        else:
            nxt_pairs, nxt_words = persist(nxt_pairs), persist(nxt_words)
            stale, replaced = [changes, pairs], current
        current, pairs = nxt_words, nxt_pairs
    train_bpe_words.last_rounds = rounds
    return merges, counts


def train_bpe(
    docs: DataFrame,
    vocab_size: int,
    specials: list[str] | None = None,
    text_col: str = "text",
    batch: int = 64,
    checkpoint_every: int = 4,
) -> Tokenizer:
    """Full training: pretokenize, count, merge until `vocab_size` ids."""
    specials = list(dict.fromkeys(specials or []))
    base = len(init_vocab_dict(specials))
    if vocab_size < base:
        raise ValueError(f"vocab_size must be at least {base}")
    words = words_table(word_frequencies(docs, specials, text_col))
    hex_merges, counts = train_bpe_words(words, vocab_size - base, batch, checkpoint_every)
    merges = [(bytes.fromhex(l), bytes.fromhex(r)) for l, r in hex_merges]
    return Tokenizer.from_merges(merges, specials, counts)


# ------------------------------------------------------------- table forms
VOCAB_SCHEMA = "token_id int, token binary, is_special boolean"
MERGES_SCHEMA = "rank int, left binary, right binary"


def vocab_frame(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    specials = {s.encode("utf-8") for s in tok.specials}
    first: dict[bytes, int] = {}
    for i in sorted(tok.vocab):
        first.setdefault(tok.vocab[i], i)
    special_ids = {first[s] for s in specials}
    ids = sorted(tok.vocab)
    columns = [pa.array(ids, pa.int32()), pa.array([tok.vocab[i] for i in ids], pa.binary()), pa.array([i in special_ids for i in ids], pa.bool_())]
    # from Arrow: rows of Python objects would be made by Python workers of their own, one a core, that then stay
    return spark.createDataFrame(pa.table(columns, ["token_id", "token", "is_special"]), VOCAB_SCHEMA)


def merges_frame(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    sides = [pa.array([m[k] for m in tok.merges], pa.binary()) for k in (0, 1)]
    columns = [pa.array(range(len(tok.merges)), pa.int32()), *sides]
    return spark.createDataFrame(pa.table(columns, ["rank", "left", "right"]), MERGES_SCHEMA)


def extend_vocab(vocab: DataFrame, merges: DataFrame, num_specials: int) -> DataFrame:
    """Merge i gets id 256 + k + i; appended to an initial vocabulary."""
    add = merges.select(
        (F.lit(256 + num_specials) + F.col("rank")).cast("int").alias("token_id"),
        F.concat("left", "right").alias("token"),
        F.lit(False).alias("is_special"),
    )
    return vocab.unionByName(add)


def longest_token(vocab: DataFrame) -> DataFrame:
    """Longest entry; on equal length the first (smallest id) wins."""
    m = vocab.agg(F.max(F.struct(F.length("token").alias("len"), (-F.col("token_id")).alias("neg"))).alias("m"))
    return m.select(F.col("m.len").alias("length"), (-F.col("m.neg")).alias("token_id")).join(
        vocab, "token_id"
    )
