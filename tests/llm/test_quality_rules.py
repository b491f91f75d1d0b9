import re
from collections import Counter

from helpers import documents, frame, words

from tokenloom.llm.quality_rules import base_counts, quality_rules


def base(text):
    text = text or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    covered = {k for i, x in enumerate(windows) if n[x] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


EXTRA = [
    (200, "one line here\none line here\n \n \none line here", "en", "s", 0, 0, 0, 0, ""),
    (201, " ".join(f"w{i % 10}" for i in range(60)), "en", "s", 0, 0, 0, 0, ""),
    (202, "a b c d e f g h x a b c d e f g h", "en", "s", 0, 0, 0, 0, ""),
    (203, "#*$%&|<> &&& ok", "en", "s", 0, 0, 0, 0, ""),
]


def test_base_counts(spark):
    rows = documents() + EXTRA
    got = base_counts(frame(spark, rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(map(tuple, got.collect())) == Counter((r[0], *base(r[1])) for r in rows)


def _labelled():
    import random

    rng = random.Random(1)
    clean = [f"clean{i}" for i in range(60)]
    junk = [f"junk{i}%%%" for i in range(60)]
    rows = [(i, words(rng, 60, junk if i % 4 == 0 else clean), "en", "s", 0, 0, 0, 0, "") for i in range(200)]
    labels = [(i, 0 if i % 4 == 0 else 1) for i in range(120)] + [(None, 1), (3, None)]
    return rows, labels


def test_verdict_separates_and_repeats(spark):
    rows, labels = _labelled()
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality_rules(frame(spark, rows + documents()), labels).collect()
    kept = {r.doc_id: r.kept for r in got if r.doc_id is not None and r.doc_id >= 120}
    assert len(got) == len(rows) + len(documents())
    assert all(kept[i] == (i % 4 != 0) for i in range(120, 200))
    assert all(not r.kept for r in got if r.base_failed)


def test_without_labels_the_base_rules_decide(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_rules(frame(spark), labels).collect()
    assert all(r.kept != r.base_failed for r in got) and len(got) == len(documents())
    assert quality_rules(frame(spark, []), labels).collect() == []
