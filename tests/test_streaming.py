import tempfile


from tokenloom.operators import bpe, codec, pretoken
from tokenloom.streaming import corpus_streams as CS

SF = "/root/testdata/sf0.001"


def test_stream_word_frequencies_equal_batch(spark):
    src = f"{SF}/documents.parquet"
    schema = spark.read.parquet(src).schema
    d = tempfile.mkdtemp(prefix="tokenloom-test-stream-")
    q = CS.stream_word_frequencies(spark, src[:-1] + "[t]", schema, ["<|endoftext|>"], d + "/out", d + "/ck")
    q.awaitTermination()
    got = {r.piece: r.n for r in CS.read_word_frequencies(spark, d + "/out").collect()}
    exp = {r.piece: r.n for r in pretoken.word_frequencies(spark.read.parquet(src), ["<|endoftext|>"]).collect()}
    assert got == exp


def test_stream_encode_equal_batch(spark, small_docs):
    tok = bpe.train_bpe(small_docs, 257 + 10, ["<|endoftext|>"])
    src = f"{SF}/documents.parquet"
    schema = spark.read.parquet(src).schema
    d = tempfile.mkdtemp(prefix="tokenloom-test-stream-")
    q = CS.stream_encode(spark, src[:-1] + "[t]", schema, tok, d + "/sink", d + "/ck")
    q.awaitTermination()
    got = {r.doc_id: list(r.ids) for r in spark.read.parquet(d + "/sink").collect()}
    exp = {r.doc_id: list(r.ids) for r in codec.encode_corpus(spark.read.parquet(src), tok).collect()}
    assert got == exp


def test_many_files_and_a_restart(spark):
    """Several micro-batches, a second run over new files, and a replayed batch."""
    d = tempfile.mkdtemp(prefix="tokenloom-test-stream-")
    docs = spark.createDataFrame([(i, f"one two w{i % 5} the end") for i in range(40)], "doc_id long, text string")
    docs.where("doc_id < 20").repartition(5).write.parquet(d + "/src")
    run = lambda: CS.stream_word_frequencies(
        spark, d + "/src", docs.schema, [], d + "/out", d + "/ck", max_files_per_trigger=2
    ).awaitTermination()
    run()
    docs.where("doc_id >= 20").repartition(3).write.mode("append").parquet(d + "/src")
    run()
    run()  # nothing new
    got = {r.piece: r.n for r in CS.read_word_frequencies(spark, d + "/out").collect()}
    exp = {r.piece: r.n for r in pretoken.word_frequencies(docs, []).collect()}
    assert got == exp
    assert CS.DeltaTables(spark, d + "/out").versions()[-1] > 2


def test_many_batches_are_few_tables_and_replays_are_never_half_seen(spark, monkeypatch):
    import os

    d = tempfile.mkdtemp(prefix="tokenloom-test-deltas-") + "/out"
    tables = CS.DeltaTables(spark, d)
    assert CS.read_word_frequencies(spark, d).collect() == []
    batch = lambda i: spark.createDataFrame([("a", 1), (f"p{i % 4}", i + 1)], "piece string, n long").coalesce(1)
    exp = {}
    for i in range(14):
        tables.add(batch(i), i, fanout=3)
        exp["a"] = exp.get("a", 0) + 1
        exp[f"p{i % 4}"] = exp.get(f"p{i % 4}", 0) + i + 1
    counts = lambda: {r.piece: r.n for r in CS.read_word_frequencies(spark, d).collect()}
    assert counts() == exp
    entries = tables.entries(13)
    assert [level for level, _ in entries] == [2, 1, 0, 0]  # 9 + 3 + 1 + 1 batches
    assert len(tables.versions()) == CS.KEPT_MANIFESTS
    assert len(os.listdir(f"{d}/tables")) < 14
    # a batch that fails after its table is written, before its manifest is there
    with monkeypatch.context() as m:
        m.setattr(CS.DeltaTables, "_publish", lambda *a: 1 / 0)
        try:
            tables.add(batch(13), 13, fanout=3)
            raise AssertionError("the replay should have failed")
        except ZeroDivisionError:
            pass
    assert counts() == exp
    tables.add(batch(13), 13, fanout=3)  # replayed: replaces itself
    assert counts() == exp and len(tables.entries(13)) == 4
