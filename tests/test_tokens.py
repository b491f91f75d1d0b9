import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import tokens as TK
from tokenloom.sources import token_stream as TS


@pytest.fixture(scope="module")
def ids(spark):
    rows = [(0, [1, 2, 3]), (1, []), (2, [4, 5, 6, 7, 8]), (5, [9]), (7, list(range(10, 40)))]
    return spark.createDataFrame(rows, "doc_id long, ids array<int>")


def flat(ids_rows, eot=0):
    out = []
    for i, (_, ids) in enumerate(sorted(ids_rows)):
        if i:
            out.append(eot)
        out.extend(ids)
    return out


def test_stream_and_windows(spark, ids):
    exp = flat([(r.doc_id, list(r.ids)) for r in ids.collect()])
    n = TK.stream_length(ids)
    assert n == len(exp)
    got = [r.token_id for r in TK.token_stream(ids, 0).orderBy("gpos").collect()]
    assert got == exp
    for T in (1, 2, 3, 7, 64):
        w = {r.window_id: list(r.ids) for r in TK.pack_windows(ids, 0, T, n).collect()}
        for wid, seq in w.items():
            assert seq == exp[wid * T : wid * T + T + 1]
        assert sorted(w) == list(range((n - 2) // T + 1))


def exchanges(df):
    """The keys and columns of every exchange of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


def test_ordered_ids_are_not_moved(spark):
    """No exchange of the whole ids, with broadcast joins off: only slices at
    document edges are shuffled."""
    from tokenloom.session import cut_lineage

    rows = [(i, list(range(i % 50 + 1))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>").repartitionByRange(6, "doc_id").sortWithinPartitions("doc_id")
    kept = cut_lineage(df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert exchanges(TK.doc_offsets(kept, stable=True)) == []
        assert exchanges(TK.token_stream(kept, 0, stable=True)) == []
        moved = exchanges(TK.pack_windows(kept, 0, 8, stable=True))
        assert len(moved) == 1 and "rangepartitioning(window_id" in moved[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exp = flat(rows)
    assert [r.token_id for r in TK.token_stream(kept, 0, stable=True).orderBy("gpos").collect()] == exp


def test_any_kind_of_id_and_equal_ids(spark):
    rows = [("b", [3, 4]), ("a", [1]), ("é", [9]), ("b", [3, 2]), ("Z", []), ("c", list(range(20, 60)))]
    df = spark.createDataFrame(rows, "doc_id string, ids array<int>").repartition(3)
    order = sorted(rows, key=lambda r: (r[0].encode(), r[1]))
    exp = [t for i, (_, x) in enumerate(order) for t in ([0] if i else []) + x]
    assert [r.token_id for r in TK.token_stream(df, 0).orderBy("gpos").collect()] == exp
    offs = sorted((r.off, r.doc_id, r.len) for r in TK.doc_offsets(df).collect())
    assert [o[1] for o in offs] == [r[0] for r in order] and [o[2] for o in offs] == [len(r[1]) + 1 for r in order]
    w = {r.window_id: list(r.ids) for r in TK.pack_windows(df, 0, 5).collect()}
    assert all(seq == exp[i * 5 : i * 5 + 6] for i, seq in w.items()) and len(w) == (len(exp) - 2) // 5 + 1


def test_draws_prune_the_window_table(spark, tmp_path):
    """Only blocks that a draw needs are read."""
    rows = [(i, [i % 250] * 40) for i in range(400)]
    ids = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    T, n = 8, TK.stream_length(ids)
    w = TK.write_windows(TK.pack_windows(ids, 0, T, n), str(tmp_path / "w"), per_block=32)
    assert w.select("block").distinct().count() == -(-((n - 2) // T + 1) // 32)
    starts = TK.sample_starts(spark, 1, 2, n, T, seed=5)
    b = TK.sample_batches(w, starts, T, per_block=32)
    assert "dynamicpruning" in b._jdf.queryExecution().executedPlan().toString().lower()
    exp, st = flat(rows), {(r.step, r.sample): r.start for r in starts.collect()}
    got = b.collect()
    assert len(got) == 2 * T
    for r in got:
        s = st[r.step, r.sample] + r.offset
        assert (r.input_id, r.target_id) == (exp[s], exp[s + 1])


def test_pairs_cover_stream_once(spark, ids):
    exp = flat([(r.doc_id, list(r.ids)) for r in ids.collect()])
    w = TK.pack_windows(ids, 0, 4)
    pairs = sorted((r.gpos, r.input_id, r.target_id) for r in TK.next_token_pairs(w, 4).collect())
    assert pairs == [(i, exp[i], exp[i + 1]) for i in range(len(exp) - 1)]


def test_sample_batches_shift_and_range(spark, ids):
    exp = flat([(r.doc_id, list(r.ids)) for r in ids.collect()])
    T, n = 4, TK.stream_length(ids)
    w = TK.pack_windows(ids, 0, T, n)
    starts = TK.sample_starts(spark, 50, 8, n, T, seed=3)
    st = {(r.step, r.sample): r.start for r in starts.collect()}
    assert all(0 <= s <= n - T - 1 for s in st.values())
    b = TK.sample_batches(w, starts, T).collect()
    assert len(b) == 50 * 8 * T
    for r in b:
        s = st[(r.step, r.sample)]
        assert r.input_id == exp[s + r.offset] and r.target_id == exp[s + r.offset + 1]


def test_start_distribution(spark):
    # 32,000 draws over [0, N-T-1] (N=100, T=7): every value, spread within 5 sigma
    n, T = 100, 7
    starts = TK.sample_starts(spark, 1000, 32, n, T, seed=42)
    counts = {r.start: r.c for r in starts.groupBy("start").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert sorted(counts) == list(range(n - T))
    mean = 32000 / (n - T)
    sd = (32000 * (1 / (n - T)) * (1 - 1 / (n - T))) ** 0.5
    assert all(abs(c - mean) <= 5 * sd for c in counts.values())


def test_shards_round_trip_and_range_check(spark, ids):
    T, n = 4, TK.stream_length(ids)
    w = TK.pack_windows(ids, 0, T, n)
    path = tempfile.mkdtemp(prefix="tokenloom-test-shards-") + "/s"
    TS.write_token_stream(w, path, T, n)
    got = [r.token_id for r in TS.read_token_stream(spark, path).orderBy("gpos").collect()]
    assert got == flat([(r.doc_id, list(r.ids)) for r in ids.collect()])
    bad = spark.createDataFrame([(0, [1, 70000])], "window_id long, ids array<int>")
    with pytest.raises(Exception):
        TS.write_token_stream(bad, path + "-bad", 4, 2)


def test_raw_file_of_any_size(spark):
    """A prime number of tokens, read by many tasks without an RDD."""
    import numpy as np

    from tokenloom.sources import raw_tokens as RT

    d = tempfile.mkdtemp(prefix="tokenloom-test-raw-")
    for n in (0, 1, 7919):
        arr = (np.arange(n) * 7 % 65536).astype(np.uint16)
        f = os.path.join(d, f"tokens{n}.bin")
        arr.tofile(f)
        df = RT.read_raw_stream(spark, f, range_bytes=1001)
        assert [(r.gpos, r.token_id) for r in df.orderBy("gpos").collect()] == list(enumerate(arr.tolist()))
    assert df.rdd.getNumPartitions() == -(-2 * 7919 // 1000)
    with open(os.path.join(d, "odd.bin"), "wb") as f:
        f.write(b"abc")
    with pytest.raises(Exception, match="16-bit"):
        RT.read_raw_stream(spark, os.path.join(d, "odd.bin")).collect()


def test_raw_round_trip(spark, ids):
    from tokenloom.sources import raw_tokens as RT

    T, n = 4, TK.stream_length(ids)
    d = tempfile.mkdtemp(prefix="tokenloom-test-raw-")
    TS.write_token_stream(TK.pack_windows(ids, 0, T, n), d + "/s", T, n)
    assert RT.write_raw_stream(spark.read.parquet(d + "/s"), d + "/raw") == n
    exp = flat([(r.doc_id, list(r.ids)) for r in ids.collect()])
    assert [r.token_id for r in RT.read_raw_stream(spark, d + "/raw").orderBy("gpos").collect()] == exp
    whole = b"".join(open(os.path.join(d, "raw", f), "rb").read() for f in sorted(os.listdir(d + "/raw")) if f.endswith(".bin"))
    assert len(whole) == 2 * n
