import regex

from tokenloom.functions import text as T
from tokenloom.operators import pretoken

import bruteforce

EDGE_TEXTS = [
    "Hello, how are you?",
    "Héllò hôw are ü? 🙃",
    "a b c d\u0085e  f",  # NBSP, EM SPACE, NEL
    "line one\r\nline two\rthree\n\n\n  four   ",
    "I'll say it's the 2nd time we've done 1,000 things!!",
    "digits ١٢٣ and ०१२ mixed",
    "   leading and trailing   ",
    "",
]


def test_pretokenize_matches_python_pattern(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE_TEXTS)], "doc_id long, text string")
    got = {r.doc_id: list(r.p) for r in df.select("doc_id", T.pretokenize("text").alias("p")).collect()}
    for i, t in enumerate(EDGE_TEXTS):
        assert got[i] == regex.findall(T.PRETOKEN_PATTERN, t), t


def test_split_special_keep_longest_first(spark):
    specials = ["<|endoftext|>", "<|endoftext|><|endoftext|>"]
    text = "a<|endoftext|>b<|endoftext|><|endoftext|>c<|endoftext|>"
    df = spark.createDataFrame([(text,)], "text string")
    parts = df.select(T.split_special_keep("text", specials).alias("p")).first().p
    assert parts == ["a", "<|endoftext|>", "b", "<|endoftext|><|endoftext|>", "c", "<|endoftext|>"]


def test_split_special_drop_and_empty_list(spark):
    df = spark.createDataFrame([("x<|endoftext|>y<|endoftext|>",)], "text string")
    assert df.select(T.split_special_drop("text", ["<|endoftext|>"]).alias("p")).first().p == ["x", "y", ""]
    assert df.select(T.split_special_drop("text", []).alias("p")).first().p == ["x<|endoftext|>y<|endoftext|>"]


def test_word_frequencies_match_bruteforce(spark, small_docs):
    got = {r.piece: r.n for r in pretoken.word_frequencies(small_docs, ["<|endoftext|>"]).collect()}
    texts = [r.text for r in small_docs.collect()]
    from collections import Counter

    exp = Counter(p for t in texts for p in bruteforce.pieces_of(t, ["<|endoftext|>"]))
    assert got == dict(exp)


def test_newline_folding(spark):
    df = spark.createDataFrame([("a\r\nb\rc\n",)], "text string")
    assert df.select(T.normalize_newlines("text").alias("t")).first().t == "a\nb\nc\n"


def test_hex_symbols(spark):
    df = spark.createDataFrame([("hé",)], "p string")
    assert df.select(T.hex_symbols("p").alias("s")).first().s == "<68><C3><A9>"
