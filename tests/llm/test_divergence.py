import random
import re
from collections import Counter

import numpy as np
from helpers import documents, frame

from tokenloom.llm.divergence import Forest, _shares, divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    counts, df, groups = {}, {}, set()
    for _, text, lang, source, *_ in rows:
        lang, source, text = lang or "", source or "", text or ""
        groups.add((lang, source))
        terms = Counter(TERM.findall(text.translate(LOWER)))
        counts.setdefault((lang, source), Counter()).update(terms)
        df.setdefault(lang, Counter()).update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])

        def p(count):
            size = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // size for t in kept}

        q = p(whole)
        mine = {g[1]: p(counts[g]) for g in groups if g[0] == lang}
        for s, ps in mine.items():
            found = [(sum(abs(ps[t] - o[t]) for t in kept), i) for i, o in mine.items() if i != s]
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", i, v, r + 1) for r, (v, i) in enumerate(found)]
            found = [(ps[t] - q[t], t) for t in kept if counts[lang, s][t] and ps[t] > q[t]]
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", i, v, r + 1) for r, (v, i) in enumerate(found[:top])]
    return sorted(out)


def mixed_rows():
    """The shared awkward rows, and a language with many sources and hot terms."""
    rng = random.Random(5)
    rows = documents()
    for i in range(400):
        text = " ".join(rng.choice(["der", "die", "das", "Ünder", "naïve", f"w{chr(97 + rng.randint(0, 25))}x"]) for _ in range(rng.randint(1, 60)))
        rows.append((1000 + i, text, "de", f"s{i % 23 if i % 3 else 0}", 1, 1, 1, 1, ""))
    return rows + [(9, "only here", "xx", "a", 1, 1, 1, 1, ""), (9, None, "xx", "b", 1, 1, 1, 1, ""), (9, "alone", "yy", "a", 1, 1, 1, 1, "")]


def test_equals_brute_force(spark):
    rows = mixed_rows()
    for min_docs, width, most in ((3, 8, 4), (30, 4096, 64), (1, 64, 5)):
        got = divergence(frame(spark, rows), min_docs=min_docs, width=width, most=most)
        assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
            ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")
        ]
        assert sorted(map(tuple, got.collect())) == brute(rows, min_docs, 50)


def test_no_rows_and_no_terms(spark):
    assert divergence(frame(spark, [])).collect() == []
    rows = [(1, None, "en", "a", 0, 0, 0, 0, ""), (2, "", "en", None, 0, 0, 0, 0, ""), (3, "12 34", None, "c", 0, 0, 0, 0, "")]
    assert sorted(map(tuple, divergence(frame(spark, rows)).collect())) == [("en", "", "pair", "a", 0, 1), ("en", "a", "pair", "", 0, 1)]


def test_equal_subtrees_are_one_node_and_priced_once():
    rng = np.random.default_rng(1)
    rare = np.where(rng.random((6, 1024)) < 0.02, 1, 0)
    forest = Forest(rare)
    assert forest.nodes() < 6 * 1024 / 4  # plain trees have 6 * 2047 nodes
    others = np.arange(1, 6)
    who, x, y, times, priced = forest.meet(0, others)
    assert priced < 5 * 1024 / 2 and times.sum() == 5 * 1024
    for o in others:
        at = who == o - 1
        got = (np.abs(forest.leaves[x[at]] - forest.leaves[y[at]]) * times[at]).sum()
        assert got == np.abs(rare[0] - rare[o]).sum()
    # a group against its equal: one node pair at every height
    same = Forest(np.vstack([rare[0], rare[0]]))
    assert same.roots[0] == same.roots[1]


def test_shares_are_exact_beyond_a_double():
    counts = np.array([3, 10**12, 10**17 + 1])
    assert _shares(counts, 10**18, 7).tolist() == [1 + 10**9 * (int(c) + 5) // (10**18 + 35) for c in counts]
