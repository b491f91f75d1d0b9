"""Cases that once gave silent wrong answers."""

import math

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import bpe, codec, model, tokens, vectors
from tokenloom.sources import corpus, token_stream, tokenizer_io


def test_freed_tokenizers_are_never_mixed_up(spark):
    docs = spark.createDataFrame([(0, "abab")], "doc_id long, text string")
    for k in range(6):
        merges = [(b"a", b"b")] if k % 2 else []
        tok = bpe.Tokenizer.from_merges(merges, [])
        ids = codec.encode_corpus(docs, tok).first()["ids"]
        assert list(ids) == ([256, 256] if merges else [97, 98, 97, 98])
        del tok


def test_specials_absent_from_the_vocabulary_are_registered(spark):
    base = bpe.Tokenizer.from_merges([(b"a", b"b")], [])
    late = bpe.Tokenizer(base.vocab, base.merges, ["<|x|>", "<|x|><|x|>", "<|x|>"])
    assert late.vocab[257] == b"<|x|>" and late.vocab[258] == b"<|x|><|x|>" and len(late.vocab) == 259
    docs = spark.createDataFrame([(0, "ab<|x|><|x|><|x|>b")], "doc_id long, text string")
    assert list(codec.encode_corpus(docs, late).first()["ids"]) == [256, 258, 257, 98]
    flags = {r.token_id for r in bpe.vocab_frame(spark, late).where("is_special").collect()}
    assert flags == {257, 258}
    again = codec.register_special_tokens(bpe.vocab_frame(spark, base), ["<p>", "<p>"])
    assert again.where(F.col("token") == F.lit(b"<p>")).count() == 1


def test_projection_keeps_labels(spark):
    x = spark.createDataFrame([(1, [1.0, 2.0])], "k int, v array<double>")
    w = spark.createDataFrame([(5, [1.0, 0.0]), (9, [0.0, 1.0])], "j long, w array<double>")
    got = {(r.k, r.j): r.y for r in vectors.linear_projection_rows(x, "k", "v", w).collect()}
    assert got == {(1, 5): 1.0, (1, 9): 2.0}


def test_unseen_contexts_count_in_the_evaluation(spark):
    params = spark.createDataFrame([(0, 1, [0.0] * 4)], "run_id int, prev_id int, w array<double>")
    counts = spark.createDataFrame([(1, 2, 1), (7, 2, 9), (8, 0, 2), (1, 9, 3)], "prev_id int, next_id int, n long")
    r = model.evaluate(params, counts).first()
    assert r.n_pairs == 15 and r.eval_loss == pytest.approx(math.log(4))


def test_saving_an_iteration_twice_replaces_it(spark, tmp_path):
    params = model.init_params(spark, 3, [0])
    path = str(tmp_path / "c")
    for i in (1, 2, 2):
        model.save_checkpoint(params, i, path)
    got, i = model.load_checkpoint(spark, path)
    assert i == 2 and got.count() == params.count()


def test_exchange_form(spark, tmp_path):
    vocab = spark.createDataFrame([(0, bytearray(b"ab")), (1, bytearray(b"ab")), (2, bytearray(b"c "))], "token_id int, token binary")
    merges = spark.createDataFrame([(0, bytearray(b"a"), bytearray(b"b"))], "rank int, left binary, right binary")
    tokenizer_io.export_gpt2_tokenizer(vocab, merges, str(tmp_path))
    v, m = tokenizer_io.import_gpt2_tokenizer(spark, str(tmp_path))
    assert {(r.token_id, bytes(r.token)) for r in v.collect()} == {(1, b"ab"), (2, b"c ")}
    assert [(r["rank"], bytes(r.left), bytes(r.right)) for r in m.collect()] == [(0, b"a", b"b")]
    bad = spark.createDataFrame([("a中b",)], "s string").select(tokenizer_io.from_printable(F.col("s")))
    with pytest.raises(Exception, match="stands for no byte"):
        bad.collect()


def test_a_stream_of_one_token_has_no_window(spark):
    ids = spark.createDataFrame([(0, [])], "doc_id long, ids array<int>")
    assert tokens.pack_windows(ids, 0, 4).count() == 0


def test_bad_bytes(spark, tmp_path):
    rows = [(b"ab",), (b"a\xffb",), (None,), ("é".encode()[:1],), ("é".encode(),)]
    got = [r[0] for r in spark.createDataFrame(rows, "b binary").select(corpus.drop_bad_utf8(F.col("b"))).collect()]
    assert got == ["ab", "ab", None, "", "é"]
    (tmp_path / "c.txt").write_bytes(b"ab\xffc<|endoftext|>d")
    got = [r.text for r in corpus.read_delimited_corpus(spark, str(tmp_path / "c.txt"), bad_bytes="drop").collect()]
    assert got == ["abc", "d"]
    trained = bpe.train_bpe(corpus.read_delimited_corpus(spark, str(tmp_path / "c.txt"), bad_bytes="drop"), 258)
    assert len(trained.merges) == 2


def test_unpacking_is_linear_and_right(spark):
    import numpy as np

    x = np.arange(5000, dtype="<u2")
    df = spark.createDataFrame([(bytearray(x.tobytes()),), (bytearray(),), (None,)], "b binary")
    got = [r[0] for r in df.select(token_stream.unpack_u16(F.col("b"))).collect()]
    assert got == [x.tolist(), [], None]
