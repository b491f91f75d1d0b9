import tempfile

from pyspark.sql import functions as F

from tokenloom.operators import bpe, generate, model
from tokenloom.sources import corpus as C
from tokenloom.sources import tokenizer_io as TIO

SPECIAL = "<|endoftext|>"


def test_delimited_corpus_round_trip(spark):
    texts = ["first doc\nwith lines", "second\r\ndoc", "third ü 🙃", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    path = tempfile.mkdtemp(prefix="tokenloom-test-corpus-") + "/c"
    C.write_delimited_corpus(df, path)
    got = sorted(r.text for r in C.read_delimited_corpus(spark, path).collect())
    assert got == sorted(t for t in texts if t) or got == sorted(texts)


def test_bad_utf8(spark):
    rows = [(bytearray(b"ok"),), (bytearray(b"a\xe2\x82"),), (bytearray(b"\xffb"),), (bytearray("é".encode()),)]
    df = spark.createDataFrame(rows, "b binary")
    rep = [r.t for r in df.select(C.replace_bad_utf8(F.col("b")).alias("t")).collect()]
    drop = [r.t for r in df.select(C.drop_bad_utf8(F.col("b")).alias("t")).collect()]
    assert rep == [bytes(x[0]).decode("utf-8", "replace") for x in rows]
    assert drop == [bytes(x[0]).decode("utf-8", "ignore") for x in rows]


def test_tokenizer_parquet_and_gpt2_round_trip(spark, small_docs):
    tok = bpe.train_bpe(small_docs, 257 + 12, [SPECIAL])
    d = tempfile.mkdtemp(prefix="tokenloom-test-tok-")
    TIO.save_tokenizer(spark, tok, d + "/pq")
    back = TIO.load_tokenizer(spark, d + "/pq")
    assert back.vocab == tok.vocab and back.merges == tok.merges and back.specials == tok.specials
    TIO.export_gpt2_tokenizer(bpe.vocab_frame(spark, tok), bpe.merges_frame(spark, tok), d + "/g")
    v, m = TIO.import_gpt2_tokenizer(spark, d + "/g")
    assert {r.token_id: bytes(r.token) for r in v.collect()} == tok.vocab
    assert [(bytes(r.left), bytes(r.right)) for r in m.orderBy("rank").collect()] == tok.merges


def test_printable_map_is_a_bijection():
    chars = TIO.byte_to_char()
    assert len(set(chars)) == 256 and chars[ord("!")] == "!" and chars[32] == chr(256 + 32)


def test_checkpoint_save_load_and_generation(spark):
    counts = spark.createDataFrame([(0, 1, 3), (1, 2, 2), (2, 0, 2), (1, 0, 1)], "prev_id int, next_id int, n long")
    params = model.init_params(spark, 3, [0])
    d = tempfile.mkdtemp(prefix="tokenloom-test-ckpt-")
    steps = counts.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(3))))
    res = model.train_model(
        params, steps, [model.RunConfig(0, lr_max=0.5)], checkpoint_every=2,
        on_checkpoint=lambda p, it: model.save_checkpoint(p, it, d),
    )
    loaded, it = model.load_checkpoint(spark, d)
    assert it == 4 and loaded.count() == 3
    a = {r.prev_id: r.w for r in loaded.collect()}
    b = {r.prev_id: r.w for r in res.params.collect()}
    assert a == b
    prompts = spark.createDataFrame([(0, [1]), (1, [2, 0]), (2, [])], "prompt_id long, ids array<int>")
    logits = model.logits_for(model.smoothed_params(counts, 3))
    g1 = {r.prompt_id: list(r.ids) for r in generate.generate_batch(prompts, logits, 5, 0.9, 0.9, eos_id=2, seed=1).collect()}
    g2 = {r.prompt_id: list(r.ids) for r in generate.generate_batch(prompts, logits, 5, 0.9, 0.9, eos_id=2, seed=1).collect()}
    assert g1 == g2  # hash-based draws: reproducible
    assert g1[2] == []
    for pid, ids in g1.items():
        assert len(ids) <= len(prompts.where(F.col("prompt_id") == pid).first().ids) + 5
        if 2 in ids[1:-1]:
            raise AssertionError("generation continued after the end token")


def _py_generate(logits, prompts, max_new, temp, top_p, eos, seed):
    import hashlib
    import math

    out = {}
    for pid, ids in prompts:
        ids = list(ids)
        if not ids:
            out[pid] = ids
            continue
        for i in range(max_new):
            row = logits.get(ids[-1])
            if row is None:
                break
            x = {t: v / temp for t, v in row.items()}
            m = max(x.values())
            e = {t: math.exp(v - m) for t, v in x.items()}
            z = sum(e.values())
            p = sorted(((v / z, t) for t, v in e.items()), key=lambda a: (-a[0], a[1]))
            if top_p < 1.0:
                kept, before = [], 0.0
                for pr, t in p:
                    if before <= top_p:
                        kept.append((pr, t))
                    before += pr
                s = sum(pr for pr, _ in kept)
                p = [(pr / s, t) for pr, t in kept]
            u = int(hashlib.md5(f"{seed}:{pid}:{i}".encode()).hexdigest()[:15], 16) / float(1 << 60)
            tot, run, tok = sum(pr for pr, _ in p), 0.0, p[-1][1]
            for pr, t in p:
                run += pr
                if run >= u * tot:
                    tok = t
                    break
            ids.append(tok)
            if tok == eos:
                break
        out[pid] = ids
    return out


def test_generation_matches_python_rule(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    V = 6
    logits = {prev: {t: float(rng.normal() * 2) for t in range(V)} for prev in range(V)}
    rows = [(prev, t, v) for prev, r in logits.items() for t, v in r.items()]
    ldf = spark.createDataFrame(rows, "prev_id int, next_id int, logit double")
    prompts = [(k, [int(k % V)]) for k in range(30)]
    pdf = spark.createDataFrame(prompts, "prompt_id long, ids array<int>")
    rows = generate.candidate_rows(ldf.where("prev_id <> 4"))  # a context without a row ends the text
    del logits[4]
    exp = _py_generate(logits, prompts, 6, 0.8, 0.9, 5, 3)
    states = []
    for most in (generate.MAX_TABLE_BYTES, 0):  # in the map, and joined step by step
        out = generate.generate_batch(pdf, rows, 6, 0.8, 0.9, eos_id=5, seed=3, max_table_bytes=most)
        assert {r.prompt_id: list(r.ids) for r in out.collect()} == exp
        states.append(sorted((r.prompt_id, r.prompt_len, r.n_new, r.stopped) for r in out.collect()))
    assert states[0] == states[1]


def test_complete_text_and_its_end(spark):
    from tokenloom.operators.bpe import Tokenizer

    tok = Tokenizer.from_merges([(b"a", b"b")], ["<|endoftext|>"])
    assert generate.end_id(tok, "<|endoftext|>") == 0 and generate.end_id(tok, "ab") == 257
    assert generate.end_id(tok, "abc") is None and generate.end_id(tok, "") is None and generate.end_id(tok, None) is None
    rows = spark.createDataFrame([(257, [98 + 1 + 1], [0.0]), (100, [0], [0.0])], "prev_id int, next_ids array<int>, logits array<double>")
    prompts = spark.createDataFrame([(1, "xab"), (2, ""), (3, "é")], "prompt_id long, text string")
    run = lambda **kw: {r.prompt_id: (r.text, r.n_new) for r in generate.complete_text(prompts, tok, rows, 5, **kw).collect()}
    assert run() == {1: ("xabc<|endoftext|>", 2), 2: ("", 0), 3: ("é", 0)}
    assert run(end="c")[1] == ("xabc", 1)


def test_from_file_to_encoded_stream(spark):
    """A corpus file read with ids trains a tokenizer and becomes a stream."""
    from tokenloom.operators import bpe, codec
    from tokenloom.operators import tokens as TK
    from tokenloom.sources import corpus

    d = tempfile.mkdtemp(prefix="tokenloom-test-file-")
    texts = [f"the {i} cat é sat on the mat " * (i % 7 + 1) for i in range(60)]
    for name, part in (("a.txt", texts[:25]), ("b.txt", texts[25:])):
        with open(f"{d}/{name}", "w", encoding="utf-8") as f:
            f.write("<|endoftext|>".join(part))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # many splits a file
    try:
        docs = corpus.read_delimited_corpus(spark, d, with_ids=True)
        assert [tuple(r) for r in docs.orderBy("doc_id").collect()] == list(enumerate(texts))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    tok = bpe.train_bpe(docs, 257 + 20, ["<|endoftext|>"])
    ids = codec.encode_corpus(docs, tok)
    stream = TK.token_stream(ids, 0)
    assert stream.count() == TK.stream_length(ids)
    assert [r.text for r in codec.decode_corpus(ids, tok).orderBy("doc_id").collect()] == texts


def test_dropping_bad_bytes_in_the_jvm(spark):
    from tokenloom.sources import corpus

    rows = [b"ok \xef\xbf\xbd", b"\xe2\x82a\xac", b"\xf0\x9f\x99\x82\xf0\x9f", b"\xff\xc0\xaf\xed\xa0\x80z", b"", None, b"\xf4\x90\x80\x80", b"\xc3\xa9\x80"]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in enumerate(rows)], "i int, b binary")
    out = df.select("i", corpus.drop_bad_utf8(F.col("b")).alias("t"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.i: r.t for r in out.collect()} == {i: None if b is None else b.decode("utf-8", "ignore") for i, b in enumerate(rows)}
