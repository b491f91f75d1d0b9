import duckdb

import __spark_entry__ as E
from check_oracles import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["rank", "left_hex", "right_hex", "pair_count"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_cheap_oracles_match(spark):
    con = _duck()
    for name in ["word_frequencies", "pair_counts", "train_bpe", "encode_corpus", "pack_windows", "softmax"]:
        got = E.queries()[name](spark, SF).toPandas()
        exp = con.execute(E.oracle_sql()[name]).df()
        assert digest(got) == digest(exp), name


def test_sql_utf8_decoder_equals_python():
    """The oracle's SQL decoder agrees with Python's replace/ignore rules."""
    import random

    from tokenloom.plans import oracle_sql as O

    rng = random.Random(5)
    pool = [0x41, 0x7F, 0xC2, 0xC3, 0xA9, 0xE0, 0xE2, 0x82, 0xAC, 0xED, 0xA0, 0xF0, 0xF4, 0x9F, 0x90, 0x80, 0xFF]
    cases = [b"", b"\xf0\x9f\x99\x83", b"\xe2\x82"] + [
        bytes(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(2000)
    ]
    con = duckdb.connect()
    for rep, mode in [("�", "replace"), ("", "ignore")]:
        sql = (
            f"SELECT {O.utf8_decode_sql('h', rep)} FROM "
            "(SELECT unnest($1::VARCHAR[]) AS h, unnest(generate_series(1, len($1))) AS i) ORDER BY i"
        )
        got = [r[0] for r in con.execute(sql, [[c.hex().upper() for c in cases]]).fetchall()]
        assert got == [c.decode("utf-8", mode) for c in cases]
