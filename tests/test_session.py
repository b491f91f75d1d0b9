import tempfile

from pyspark.sql import functions as F

from tokenloom.session import bounded_broadcast, spread
from tokenloom.sources import corpus as C


def _has_broadcast(df) -> bool:
    """True when the analyzed plan carries a broadcast hint."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(True)
    return "strategy=broadcast" in buf.getvalue()


def test_bounded_broadcast_falls_back_to_shuffle(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert _has_broadcast(bounded_broadcast(small, 100))
    assert not _has_broadcast(bounded_broadcast(big, 100))
    j = spark.range(2000).join(bounded_broadcast(big, 100), "id")
    assert j.count() == 1000


def test_spread_only_when_few_splits(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(many).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2
    assert sorted(r.id for r in spread(one).collect()) == list(range(100))


def test_delimited_corpus_survives_many_splits(spark):
    docs = spark.range(20000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("story "), F.col("id").cast("string"), F.lit("\nline two ü\n"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int"))).alias("text"),
    )
    path = tempfile.mkdtemp(prefix="tokenloom-test-split-") + "/c"
    C.write_delimited_corpus(docs.coalesce(1), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")  # many splits over one file
    try:
        back = C.read_delimited_corpus(spark, path)
        assert back.rdd.getNumPartitions() > 5
        got = sorted(r.text for r in back.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(r.text for r in docs.collect())
