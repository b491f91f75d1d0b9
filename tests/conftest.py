import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tokenloom.session import build_session

    s = build_session("local[4]", app="tokenloom-tests", shuffle_partitions=8)
    sc = s.sparkContext
    if not sc.getCheckpointDir():
        # tests only: a private folder when the session names none
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tokenloom-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_docs(spark):
    """The first 40 documents of sf0.001 (a small fixture for brute force)."""
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(40)
    return spark.createDataFrame(df.collect(), "doc_id long, text string")
