import pytest

from tokenloom.operators import bpe

import bruteforce

SPECIAL = "<|endoftext|>"


def test_train_matches_bruteforce(spark, small_docs):
    texts = [r.text for r in small_docs.collect()]
    exp = bruteforce.train(texts, 30, [SPECIAL])
    tok = bpe.train_bpe(small_docs, 257 + 30, [SPECIAL], batch=32)
    assert tok.merges == exp


def test_batched_equals_one_at_a_time(spark, small_docs):
    a = bpe.train_bpe(small_docs, 257 + 20, [SPECIAL], batch=1)
    b = bpe.train_bpe(small_docs, 257 + 20, [SPECIAL], batch=64)
    assert a.merges == b.merges
    assert a.merge_counts == b.merge_counts


def test_vocab_ids_and_size_check(spark, small_docs):
    tok = bpe.train_bpe(small_docs, 257 + 3, [SPECIAL])
    assert tok.vocab[0] == SPECIAL.encode()
    assert tok.vocab[1] == b"\x00" and tok.vocab[256] == b"\xff"
    assert tok.vocab[257] == tok.merges[0][0] + tok.merges[0][1]
    with pytest.raises(ValueError):
        bpe.train_bpe(small_docs, 200, [SPECIAL])


def test_overlapping_pairs_count_twice_merge_once(spark):
    # 'aaa' has the pair (a, a) twice but one merge leaves <aa><a>
    words = spark.createDataFrame([("<61><61><61>", 1)], "sym string, n long")
    pc = {(r.l, r.r): r.c for r in bpe.pair_counts(words).collect()}
    assert pc == {("61", "61"): 2}
    merged = bpe.apply_merge(words, [("61", "61")]).first().sym
    assert merged == "<6161><61>"
    four = spark.createDataFrame([("<61><61><61><61>", 1)], "sym string, n long")
    assert bpe.apply_merge(four, [("61", "61")]).first().sym == "<6161><6161>"


def test_same_bytes_from_two_paths(spark):
    # (a, bc) and (ab, c) give one symbol abc
    words = spark.createDataFrame([("<61><62><63>", 3), ("<61><62><63><64>", 2)], "sym string, n long")
    w1 = bpe.apply_merge(words, [("62", "63"), ("61", "6263")])
    w2 = bpe.apply_merge(words, [("61", "62"), ("6162", "63")])
    assert sorted(r.sym for r in w1.collect()) == sorted(r.sym for r in w2.collect())


def test_special_never_merged(spark):
    docs = spark.createDataFrame(
        [(0, "ab<|endoftext|>ab<|endoftext|>ab <|endoftext|> |>ab<|")], "doc_id long, text string"
    )
    tok = bpe.train_bpe(docs, 257 + 10, [SPECIAL])
    for a, b in tok.merges:
        assert b"<|" not in a + b or (a + b) == b"<|"
    assert all(SPECIAL.encode() not in v for i, v in tok.vocab.items() if i != 0)


def test_longest_token(spark, small_docs):
    tok = bpe.train_bpe(small_docs, 257 + 15, [SPECIAL])
    v = bpe.vocab_frame(spark, tok)
    row = bpe.longest_token(v).first()
    best = max(tok.vocab.items(), key=lambda kv: (len(kv[1]), -kv[0]))
    assert row.token_id == best[0]


def golden_size_docs(spark, n_bytes=133_027):
    """sf0.01 documents up to a text of the published benchmark's size."""
    texts, size = [], 0
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").select("text").toLocalIterator():
        texts.append(r.text)
        size += len(r.text.encode())
        if size >= n_bytes:
            return texts
    return texts


def test_golden_size_in_few_rounds(spark):
    texts = golden_size_docs(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tok = bpe.train_bpe(docs, 500, [SPECIAL])
    assert tok.merges == bruteforce.train(texts, 243, [SPECIAL])
    assert len(tok.merges) == 243 and bpe.train_bpe_words.last_rounds <= 8


def test_wrong_guesses_cost_rounds_only(spark, small_docs):
    """A forecast from three words, or none, gives the same merges and counts."""
    from tokenloom.operators import pretoken

    words = bpe.words_table(pretoken.word_frequencies(small_docs, [SPECIAL]))
    full = bpe.train_bpe_words(words, 40)
    for head in (0, 3):
        assert bpe.train_bpe_words(words, 40, batch=8, head_words=head) == full


def test_merge_changes_match_recounts(spark, small_docs):
    from tokenloom.operators import pretoken

    words = bpe.words_table(pretoken.word_frequencies(small_docs, [SPECIAL])).cache()
    step = [("20", "74"), ("74", "68"), ("68", "65"), ("2074", "68"), ("65", "20"), ("65", "72")]
    changes = [tuple(r) for r in bpe.merge_changes(words, step).collect()]
    state = {(r.l, r.r): r.c for r in bpe.pair_counts(words).collect()}
    for i in range(len(step)):
        for s, l, r, n in changes:
            if s == i:
                state[l, r] = state.get((l, r), 0) + n
        after = words
        for m in step[: i + 1]:
            after = bpe.apply_merge(after, [m])
        assert {p: c for p, c in state.items() if c} == {(r.l, r.r): r.c for r in bpe.pair_counts(after).collect()}
    walked = bpe.walked(words, step).where("instr(sym, '><') > 0")
    assert sorted(map(tuple, walked.collect())) == sorted(map(tuple, after.collect()))


def test_alternating_pair_overlap(spark):
    # 'abab': (a,b) counted twice, both occurrences merged; (b,a) once
    words = spark.createDataFrame([("<61><62><61><62>", 2)], "sym string, n long")
    pc = {(r.l, r.r): r.c for r in bpe.pair_counts(words).collect()}
    assert pc == {("61", "62"): 4, ("62", "61"): 2}
    assert bpe.apply_merge(words, [("61", "62")]).first().sym == "<6162><6162>"
