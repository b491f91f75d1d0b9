import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
from helpers import documents, stored
from xxhash import xxh64_intdigest

from tokenloom.llm import line_dedup
from tokenloom.llm.line_dedup import dedup_lines, duplicate_lines
from tokenloom.llm.simhash import one_of_each


def brute(rows, similarity=0.8, min_words=1):
    """Texts by position, every line compared with every earlier one."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = [], {}
    for i in order:
        kept = []
        for line in (rows[i][1] or "").split("\n"):
            w = line.encode().split()
            s = frozenset(w)
            hit = len(w) >= min_words and any(len(s & t) >= similarity * len(s | t) - 1e-9 for t in seen)
            if len(w) >= min_words:
                seen.append(s)
            if not hit:
                kept.append(line)
        out[i] = None if rows[i][1] is None else "\n".join(kept)
    return out


def noisy(n=150, seed=4):
    """Groups of near-copies of lines, in all distances around the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(80)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 30))] for _ in range(8)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(1, 4)):
            line = list(rng.choice(bases)) if rng.random() < 0.7 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 12))]
            for _ in range(rng.randint(0, len(line) // 4)):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.append(" ".join(line))
        rows.append((1000 + i, "\n".join(lines), "en", "s", 0, 0, 0, 0, ""))
    return rows


def check(spark, path, rows, **options):
    got = dedup_lines(stored(spark, path, rows), **options)
    expected = brute(rows, **options)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((rows[i][0], t) for i, t in expected.items())
    return got


def test_documents(spark, tmp_path):
    got = check(spark, tmp_path / "d", documents())
    for r in got.collect():
        if r["__removed"]:
            assert r.n_chars == len(r.text)


def test_near_copies(spark, tmp_path):
    check(spark, tmp_path / "d", noisy())


def test_hot_lists_in_blocks_and_few_candidates(spark, tmp_path):
    """Blocks of 3 lines and one candidate a line: nothing is lost to either."""
    rows = noisy(60, seed=9)
    docs = stored(spark, tmp_path / "d", rows).selectExpr("monotonically_increasing_id() as row", "doc_id", "text")
    where = {r.row: r.doc_id for r in docs.collect()}
    full = Counter((where[r.row], r.line) for r in duplicate_lines(docs).collect())
    tight = Counter((where[r.row], r.line) for r in duplicate_lines(docs, kept=1, block=3).collect())
    assert full == tight and full


def test_empty(spark, tmp_path):
    assert dedup_lines(stored(spark, tmp_path / "d", [])).collect() == []


def test_many_variants_of_one_line(spark, tmp_path):
    """Lines that differ in one token are not taken for equal: all but the first go."""
    lines = ["the report of day %d was sent to all" % i for i in range(20_000)]
    lines = [line + " our members" for line in lines]  # 10 words, 9 of them shared
    rows = [(i, "\n".join(lines[i * 100 : i * 100 + 100]), "en", "s", 0, 0, 0, 0, "") for i in range(200)]
    got = dedup_lines(stored(spark, tmp_path / "d", rows))
    assert {r.doc_id: r.text for r in got.collect() if r.text} == {0: lines[0]}


def postings(n, does):
    """One list of n near-copies of ten words, all signatures alike."""
    at = np.arange(n)
    shape = np.full(n, 10 << 40 | does)
    return [np.full(n, 7), at, at, np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), shape]


def test_only_lines_that_look_give_pairs():
    """Round two: three looking lines in a list of 2,000 have pairs with all
    earlier lines, the others none, and no batch holds the whole list's pairs."""
    everyone = postings(2000, line_dedup.MET)
    looks = [c[[5, 900, 1999]] for c in postings(2000, line_dedup.LOOKING)]
    both = [np.concatenate(c) for c in zip(everyone, looks)]
    both = [c[np.lexsort((both[2], both[1]))] for c in both]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in both], line_dedup._names(line_dedup.POSTINGS))
    got = list(line_dedup._meet(0.8, None)(iter([batch])))
    pairs = Counter((i, j) for b in got for i, j in zip(b["id"].to_pylist(), b["to"].to_pylist()))
    assert pairs == Counter((i, j) for i in (5, 900, 1999) for j in range(i))
    assert max(b.num_rows for b in got) <= 3 * 256


def test_input_split_otherwise_after_the_search(spark, tmp_path):
    """Decisions hold for their rows when the files are packed anew before the result is read."""
    docs = stored(spark, tmp_path / "d", noisy(40))
    expected = Counter(t for t in brute(noisy(40)).values())
    whole, firsts = dedup_lines(docs), one_of_each(docs)
    before = Counter(r.doc_id for r in one_of_each(docs).collect())
    names = ["spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"]
    try:
        for name in names:
            spark.conf.set(name, "1")
        assert Counter(r.text for r in whole.collect()) == expected
        assert Counter(r.doc_id for r in firsts.collect()) == before
    finally:
        for name in names:
            spark.conf.unset(name)


def test_short_lines(spark, tmp_path):
    """The pipeline's stage takes lines of any length; four words of five are near."""
    extra = ["Last.", "a b c d", "a b c", "a b c", "e d c b a", "日本語", "Last.\n日本語", "a b", "c b a"]
    rows = noisy(60, seed=5) + [(2000 + i, t, "en", "s", 0, 0, 0, 0, "") for i, t in enumerate(extra)]
    got = corpus_pipeline.lines(spark, stored(spark, tmp_path / "d", rows), "")
    expected = brute(rows, min_words=1)
    assert [expected[60 + i] for i in range(9)] == ["Last.", "a b c d", "a b c", "", "", "日本語", "", "a b", ""]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((rows[i][0], t) for i, t in expected.items())


def test_a_line_with_a_few_candidates_is_settled_in_one_round(spark, monkeypatch):
    words = [f"w{i}" for i in range(100)]
    near = [" ".join(words[: 12 * k] + [f"x{k}_{j}" for j in range(12)] + words[12 * k + 12 :]) for k in range(4)]
    # the words that set them apart are the frequent ones, so that the others are looked up
    apart = [" ".join(f"x{k}_{j}" for k in range(4) for j in range(12)) + "".join(f" y{i}_{j}" for j in range(60)) for i in range(9)]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate([*apart, *near, " ".join(words)])], "doc_id long, text string")
    names, write = [], line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name, *a, **k: names.append(name) or write(df, name, *a, **k))
    assert line_dedup.dedup_lines(docs).agg({"__removed": "sum"}).first()[0] == 0  # 88 of 112 words shared
    assert "line_pairs" in names and "again" not in names


def test_no_texts_and_no_lines_are_shuffled_for_marks(spark, tmp_path, monkeypatch):
    """Removed lines and first lines are marked by bits: no join of the result's
    rows, and no join of all lines; beyond MARKED_LINES, joins give the same."""
    rows = [*noisy(60, seed=11), (None, None, "en", "s", 0, 0, 0, 0, ""), (5, "", "en", "s", 0, 0, 0, 0, "")]
    got = check(spark, tmp_path / "d", rows)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(line_dedup, "MARKED_LINES", 0)
    joined = check(spark, tmp_path / "e", rows)
    assert "Join" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert Counter((r.doc_id, r["__removed"]) for r in got.collect()) == Counter((r.doc_id, r["__removed"]) for r in joined.collect())


def test_marks_hold_exactly_their_values(spark):
    rng = random.Random(2)
    ids = {rng.randrange(5) << 33 | rng.randrange(300) for _ in range(200)} | {63, 7 << 33 | 64}
    marks = line_dedup._marks(spark.createDataFrame([(i,) for i in ids], "id long")).value
    every = np.array([p << 33 | i for p in range(9) for i in range(400)])
    assert set(every[line_dedup._marked(marks, every)].tolist()) == ids
    none = line_dedup._marks(spark.createDataFrame([], "id long")).value
    assert not line_dedup._marked(none, every).any()


def test_words_are_those_between_ascii_white_space():
    texts = ["a b\ta\n\n \n c\x0b\x0cd \r\n日 本 x b\x1cb", "", "\n", "z"]
    text, line, n, tokens = line_dedup._words(pa.array(texts), 1)
    expected = [(i, j, set(w)) for i, t in enumerate(texts) for j, part in enumerate(t.encode().split(b"\n")) if (w := part.split())]
    assert list(zip(text.tolist(), line.tolist(), n.tolist())) == [(i, j, len(w)) for i, j, w in expected]
    at = np.concatenate([[0], np.cumsum(n)])
    assert [set(tokens[a:b].tolist()) for a, b in zip(at, at[1:])] == [{xxh64_intdigest(w) for w in x} for _, _, x in expected]
    assert line_dedup._words(pa.array(texts), 4)[2].tolist() == []
    assert line_dedup._words(pa.array(texts), 3)[1].tolist() == [0, 4]


def lines_of(rng, n):
    """n postings of lines of some words, with ids and doc_ids from end to end of their range."""
    ids = rng.integers(0, 9, n) << 33 | rng.integers(0, 1000, n)
    doc = np.where(rng.random(n) < 0.1, rng.choice([(1 << 63) - 1, -(1 << 63), -7], n), rng.integers(0, 50, n))
    size = rng.integers(4, 400, n)
    sign, sign2 = rng.integers(-(1 << 63), 1 << 63, (2, n))
    key = rng.integers(-(1 << 63), 1 << 63, 40)[rng.integers(0, 40, n)]
    return [key, doc, ids, sign, np.where(size <= line_dedup.SHORT, 0, sign2), size << 40 | rng.integers(0, 30, n) << 19 | rng.integers(1, 4, n)]


def test_postings_travel_packed_by_bucket():
    """Few rows and few bytes a posting reach the shuffle, and each comes out as it went in, beside its key's others."""
    columns = lines_of(np.random.default_rng(3), 6000)
    batches = [pa.RecordBatch.from_arrays([pa.array(c[at : at + 1000]) for c in columns], line_dedup._names(line_dedup.POSTINGS)) for at in range(0, 6000, 1000)]
    rows = [b for part in (batches[:2], batches[2:]) for b in line_dedup._by_bucket(4)(iter(part))]
    table = pa.Table.from_batches(rows).sort_by("bucket")
    assert table.num_rows <= 8 and sum(table["n"].to_pylist()) == 6000
    assert table["postings"].nbytes < 34 * 6000  # what a row of six numbers took in the shuffle
    got = list(line_dedup._lists(iter(table.to_batches(max_chunksize=3))))
    sent = Counter(zip(*(c.tolist() for c in columns[1:])))
    assert sent == Counter(x for b in got for x in zip(*(c.to_pylist() for c in b.columns[1:])))
    keys = dict(zip(zip(*(c.tolist() for c in columns[1:])), columns[0].tolist()))
    lists = [[keys[x] for x in zip(*(c.to_pylist() for c in b.columns[1:]))] for b in got]
    assert sum(len(set(x)) for x in lists) == len(set(columns[0].tolist()))  # a key is in one bucket
    assert all(b["key"].to_pylist() == sorted(b["key"].to_pylist()) for b in got)


def test_lists_in_order_of_length_give_every_near_pair():
    """Pairs that pass the filters, found by comparing all, in small steps and in one."""
    rng = np.random.default_rng(5)
    columns = lines_of(rng, 900)
    base = rng.integers(-(1 << 63), 1 << 63, 40)[columns[0] % 40]  # near signatures within a list
    columns[3] = base ^ (1 << rng.integers(0, 63, 900))
    columns[4] = np.zeros(900, dtype=np.int64)
    columns = [c[np.argsort(columns[0], kind="stable")] for c in columns]
    c = dict(zip(line_dedup._names(line_dedup.POSTINGS), (x.tolist() for x in columns)))
    expected = Counter()
    for i in range(900):
        for j in range(900):
            if c["key"][i] != c["key"][j] or (c["doc_id"][j], c["id"][j]) >= (c["doc_id"][i], c["id"][i]) or c["id"][i] == c["id"][j]:
                continue
            (ni, pi, di), (nj, pj, dj) = ((x >> 40, x >> 19 & 0x1FFFFF, x & 3) for x in (c["shape"][i], c["shape"][j]))
            needed = int(np.ceil((ni + nj) * 4 / 9 - 1e-9))
            near = min(ni, nj) >= 0.8 * max(ni, nj) - 1e-9 and min(ni - pi, nj - pj) >= needed
            if near and (c["sign"][i] ^ c["sign"][j]).bit_count() <= ni + nj - 2 * needed and di & line_dedup.LOOKING and dj & line_dedup.MET:
                expected[c["id"][i], c["id"][j]] += 1
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in columns], list(c))
    for step in (1, 50, 1 << 19):
        got = list(line_dedup._meet(0.8, None, step=step)(iter([batch])))
        assert Counter((i, j) for b in got for i, j in zip(b["id"].to_pylist(), b["to"].to_pylist())) == expected
    assert len(expected) > 100


def test_token_sets_are_written_by_the_block(spark, tmp_path):
    """A few rows hold all lines' sets, and the lines asked for come out with their tokens."""
    rows = noisy(60, seed=13)
    docs = stored(spark, tmp_path / "d", rows).selectExpr("monotonically_increasing_id() as row", "doc_id", "text").coalesce(1)
    blocks = line_dedup.token_blocks(docs)
    assert blocks.count() == 1
    texts = {r.row: r.text for r in docs.collect()}
    every = blocks.mapInArrow(line_dedup._lines_in(), line_dedup.LINES).collect()
    assert len(every) == sum(1 for t in texts.values() for x in t.split("\n") if x.split())
    for r in every:
        words = set(texts[r.row].split("\n")[r.line].split())
        assert {t % (1 << 64) for t in r.tokens} == {xxh64_intdigest(w) for w in words} and r.n == len(words)
    wanted = {every[3].id, every[50].id}
    some = blocks.mapInArrow(line_dedup._lines_in(lambda ids: np.isin(ids, list(wanted))), line_dedup.LINES).collect()
    assert sorted(some) == sorted([every[3], every[50]])
    token = every[7].tokens[0]
    has = blocks.mapInArrow(line_dedup._lines_in(has=lambda x: x == np.uint64(token % (1 << 64))), line_dedup.LINES).collect()
    assert sorted(has) == sorted(r for r in every if token in r.tokens)
