import duckdb

import __spark_entry__ as E
import corpus_pipeline
from check_oracles import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_oracles(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("op6_mtree_topk", "op10_chat_format", "op11_vector_codes", "op13_source_divergence"):
        assert digest(E.queries()[name](spark, SF).toPandas()) == digest(con.execute(E.oracle_sql()[name]).df()), name


def test_pipeline_stages(spark, tmp_path):
    """Every stage takes its predecessor's rows; all but the last keep the columns."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        rows.append(docs.count())
        if i < 4:
            assert docs.columns == columns, name
    assert rows[0] > rows[1] == rows[2] >= rows[3] > 0
    filled = docs.groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in filled) / (2048 * len(filled)) > 0.9


def test_pipeline_of_no_documents(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
