"""Applying an ordered list of merges to words, for the training loop.

A word is its bracketed-hex form, `<74><68><65>`.  Merges happen one after the
other over the whole corpus.  `Words` applies them to many words at once; the
functions on single words serve the forecast, which touches few.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Pair = tuple[str, str]


def symbols(word: str) -> list[str]:
    return word[1:-1].split("><") if word else []


def merge_once(syms: list[str], pair: Pair) -> list[str]:
    """Non-overlapping occurrences of the pair merged, left to right."""
    l, r = pair
    out, i, n = [], 0, len(syms)
    while i < n:
        if syms[i] == l and i + 1 < n and syms[i + 1] == r:
            out.append(l + r)
            i += 2
        else:
            out.append(syms[i])
            i += 1
    return out


class Words:
    """Many words as one row of symbol numbers, merged all at once.

    `flat` holds the symbols of all words one after the other, `word` the place
    of each symbol's word; a symbol's number is its place in `names`.  A merge is
    a few array operations over the symbols, so a pass over the words costs no
    Python step per word."""

    def __init__(self, syms: pa.Array):
        inner = pc.utf8_slice_codeunits(syms, 1, -1)  # an empty word has one empty symbol
        parts = pc.split_pattern(inner, "><")
        names = parts.flatten().dictionary_encode()
        self.names: list[str] = names.dictionary.to_pylist()
        self.number = {s: i for i, s in enumerate(self.names)}
        self.flat = names.indices.to_numpy().astype(np.int32)
        self.rows = len(syms)
        self.word = np.repeat(np.arange(self.rows, dtype=np.int32), pc.list_value_length(parts).to_numpy())

    def merge(self, pair: Pair) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """One merge in all words, left to right and without overlap.  None if no
        word holds the pair, else (words, pairs, +1 or -1): the adjacent pairs
        that came and went, a pair as left << 32 | right."""
        l, r = (self.number.get(s) for s in pair)
        if l is None or r is None:
            return None
        flat, word = self.flat, self.word
        at = np.flatnonzero(flat[:-1] == l)
        at = at[(flat[at + 1] == r) & (word[at + 1] == word[at])]
        if l == r and len(at):  # of a run, every other place
            first = np.r_[True, np.diff(at) != 1]
            at = at[(np.arange(len(at)) - np.flatnonzero(first)[np.cumsum(first) - 1]) % 2 == 0]
        if not len(at):
            return None
        new = self.number.setdefault(pair[0] + pair[1], len(self.names))
        if new == len(self.names):
            self.names.append(pair[0] + pair[1])
        gone = self._pairs(np.concatenate([at - 1, at, at + 1]))
        flat[at] = new
        left = np.ones(len(flat), dtype=bool)
        left[at + 1] = False
        self.flat, self.word = flat[left], word[left]
        at = at - np.arange(len(at))  # each merge before moved it by one
        come = self._pairs(np.concatenate([at - 1, at]))
        sign = np.repeat(np.array([-1, 1]), [len(gone[0]), len(come[0])])
        return np.concatenate([gone[0], come[0]]), np.concatenate([gone[1], come[1]]), sign

    def _pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, pairs) of the adjacent pairs that start at the given places."""
        at = np.unique(at[(at >= 0) & (at < len(self.flat) - 1)])
        at = at[self.word[at] == self.word[at + 1]]
        return self.word[at], self.flat[at].astype(np.int64) << 32 | self.flat[at + 1]

    def bracketed(self) -> pa.Array:
        """The words as bracketed hex, in their order."""
        ends = np.searchsorted(self.word, np.arange(self.rows + 1))
        syms = pa.array(self.names, pa.string()).take(pa.array(self.flat))
        inner = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), syms), "><")
        return pc.if_else(pc.equal(inner, ""), "", pc.binary_join_element_wise("<", inner, ">", ""))


def pair_changes(before: list[str], after: list[str]) -> dict[Pair, int]:
    """How many more (or fewer) times each adjacent pair occurs."""
    diff: dict[Pair, int] = {}
    for p in zip(after, after[1:]):
        diff[p] = diff.get(p, 0) + 1
    for p in zip(before, before[1:]):
        diff[p] = diff.get(p, 0) - 1
    return {p: n for p, n in diff.items() if n}


class Forecast:
    """The most frequent words on the driver, to guess the merges to come.

    A guess costs nothing if wrong: every round checks it against all words.
    Counts of the head are scaled to the corpus by the exact counts that are
    known; a pair of a symbol made on the way is scaled as that symbol's pair."""

    def __init__(self, head: list[tuple[str, int]]):
        self.words = [symbols(w) for w, _ in head]
        self.weights = [n for _, n in head]
        self.counts: Counter = Counter()
        self.holders: dict[Pair, set[int]] = {}
        self.steps: list[list[tuple[int, list[str]]]] = []  # by guess: (word, what it was)
        for i, s in enumerate(self.words):
            for pair in zip(s, s[1:]):
                self.counts[pair] += self.weights[i]
                self.holders.setdefault(pair, set()).add(i)

    def _set(self, i: int, after: list[str], touched: set[Pair]) -> None:
        for p, n in pair_changes(self.words[i], after).items():
            self.counts[p] += n * self.weights[i]
            touched.add(p)
            if n > 0:
                self.holders.setdefault(p, set()).add(i)
        self.words[i] = after

    def merge(self, pair: Pair) -> set[Pair]:
        """One more guess, done to the head: the pairs whose counts it changes."""
        touched, journal = {pair}, []
        for i in list(self.holders.get(pair, ())):
            after = merge_once(self.words[i], pair)
            if len(after) < len(self.words[i]):
                journal.append((i, self.words[i]))
                self._set(i, after, touched)
        self.steps.append(journal)
        self.holders.pop(pair, None)  # no word holds it now; undoing puts them back
        return touched

    def accept(self, taken: int) -> None:
        """The first `taken` guesses were right; the others are undone."""
        while len(self.steps) > taken:
            for i, before in self.steps.pop():
                self._set(i, before, set())
        self.steps = []

    def guess(self, known: dict[Pair, int], most: int) -> list[tuple[Pair, float]]:
        """Up to `most` merges with their expected counts, starting from the
        exact counts `known` of the most frequent pairs."""
        counts = self.counts
        both = [p for p in known if counts[p]]
        overall = sum(known[p] for p in both) / sum(counts[p] for p in both) if both else 1.0
        scale = {p: known[p] / counts[p] for p in both}
        of_symbol: dict[str, float] = {}
        outside = {p for p in known if not counts[p]}  # in no word of the head: its count stands

        def expected(pair: Pair) -> float:
            n = counts[pair]
            if not n:
                return float(known[pair]) if pair in outside else 0.0
            k = scale.get(pair)
            if k is None:
                made = [of_symbol[s] for s in pair if s in of_symbol]
                k = scale[pair] = max(made) if made else overall
            return n * k

        est = {p: expected(p) for p in set(known) | {p for p, n in counts.items() if n}}
        out: list[tuple[Pair, float]] = []
        while len(out) < most and est:
            pair = max(est, key=lambda p: (est[p], p))
            if est[pair] <= 0:
                break
            out.append((pair, est[pair]))
            outside.discard(pair)
            of_symbol[pair[0] + pair[1]] = scale.get(pair, overall)
            for p in self.merge(pair):
                est[p] = expected(p)
        return out
