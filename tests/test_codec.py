import pytest

from tokenloom.functions.bpe_kernel import BpeKernel
from tokenloom.operators import bpe, codec

import bruteforce

SPECIAL = "<|endoftext|>"
ROUND_TRIP = [
    "",
    "s",
    "🙃",
    "Hello, how are you?",
    "Héllò hôw are ü? 🙃",
    "Héllò hôw <|endoftext|><|endoftext|> are ü? 🙃<|endoftext|>",
    "line\r\nbreaks\n\n<|endoftext|>\n\ntesting!",
    "<|endoftext|>\n\n",
    "<|endoftext|>\n\ntesting!",
]


@pytest.fixture(scope="module")
def tok(spark, small_docs):
    return bpe.train_bpe(small_docs, 257 + 40, [SPECIAL])


def test_encode_matches_bruteforce(spark, tok, small_docs):
    inv = tok.inverse()
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    got = {r.doc_id: list(r.ids) for r in codec.encode_corpus(small_docs, tok).collect()}
    for d, t in texts.items():
        assert got[d] == bruteforce.encode(t, tok.merges, inv, tok.specials)


def test_round_trip_with_specials(spark, tok):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ROUND_TRIP)], "doc_id long, text string")
    ids = codec.encode_corpus(docs, tok)
    inv = tok.inverse()
    for r in ids.collect():
        assert list(r.ids) == bruteforce.encode(ROUND_TRIP[r.doc_id], tok.merges, inv, tok.specials)
    back = {r.doc_id: r.text for r in codec.decode_corpus(ids, tok).collect()}
    assert back == dict(enumerate(ROUND_TRIP))


def test_special_is_one_id(spark, tok):
    docs = spark.createDataFrame([(0, f"a{SPECIAL}{SPECIAL}b")], "doc_id long, text string")
    ids = list(codec.encode_corpus(docs, tok).first().ids)
    assert ids.count(0) == 2


def test_overlapping_specials_longest_wins(spark):
    double = SPECIAL * 2
    tok = bpe.Tokenizer.from_merges([], [SPECIAL, double])
    docs = spark.createDataFrame([(0, f"x{double}y{SPECIAL}")], "doc_id long, text string")
    ids = list(codec.encode_corpus(docs, tok).first().ids)
    assert ids == [2 + ord("x"), 1, 2 + ord("y"), 0]


def test_decode_skips_unknown_and_replaces_bad_bytes(spark, tok):
    df = spark.createDataFrame([(0, [1 + 0xE2, 99999, 1 + 0x82, 1 + ord("a")])], "doc_id long, ids array<int>")
    assert codec.decode_corpus(df, tok).first().text == "�a"


def test_kernel_lowest_rank_first_with_equal_bytes():
    # merges (b,c)=0, (a,b)=1, (a,bc)=2, (ab,c)=3 : abc from two paths
    merges = [(b"b", b"c"), (b"a", b"b"), (b"a", b"bc"), (b"ab", b"c")]
    tok = bpe.Tokenizer.from_merges(merges, [SPECIAL])
    k = BpeKernel(tok.vocab, tok.merges, tok.specials)
    inv = tok.inverse()
    for piece in ["abc", "abcabc", "aabcc", "ab", "bcbc"]:
        assert k.encode_piece(piece) == bruteforce.encode_piece(piece, merges, inv)


def test_kernel_long_piece():
    merges = [(b"a", b"a"), (b"aa", b"aa"), (b"aaaa", b"a")]
    tok = bpe.Tokenizer.from_merges(merges, [])
    k = BpeKernel(tok.vocab, tok.merges, [])
    inv = tok.inverse()
    for n in (1, 2, 3, 5, 7, 1000):
        assert k.encode_piece("a" * n) == bruteforce.encode_piece("a" * n, merges, inv)


def test_register_special_tokens(spark, tok):
    v = bpe.vocab_frame(spark, tok)
    out = codec.register_special_tokens(v, [SPECIAL, "<|pad|>"])
    rows = {bytes(r.token): r.token_id for r in out.collect()}
    assert rows[SPECIAL.encode()] == 0
    assert rows[b"<|pad|>"] == max(tok.vocab) + 1


def test_token_frequencies_and_stats(spark, tok, small_docs):
    ids = codec.encode_corpus(small_docs, tok)
    n = sum(len(r.ids) for r in ids.collect())
    assert sum(r.n for r in codec.token_frequencies(ids).collect()) == n
    st = codec.corpus_stats(small_docs, ids).first()
    assert st.n_tokens == n and st.n_docs == 40


def test_decoding_stays_in_the_jvm(spark):
    from tokenloom.operators import bpe, codec

    tok = bpe.Tokenizer.from_merges([(b"\xc3", b"\xa9")], ["<|endoftext|>"])
    rows = [(0, [0xC3 + 1, 0xA9 + 1, 257]), (1, [0xC3 + 1, 98, -1, 5000]), (2, []), (3, None), (4, [0xE2 + 1, 0x82 + 1, 0xFF + 1])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    out = codec.decode_corpus(df, tok)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {0: "éé", 1: "\ufffda", 2: "", 3: None, 4: b"\xe2\x82\xff".decode("utf-8", "replace")}
