"""Session helpers.

Library functions never create a session; they take the one they are given.
`build_session` is for tests, the bench and scripts only.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    app: str = "tokenloom",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session tuned for this library; AQE on, UI off."""
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (`spark.checkpoint.dir` or the context's checkpoint
    dir).  Only a local-mode session without one gets a private folder, as in
    tests; on a cluster a missing setting is an error, never a local temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises in some versions
            conf_dir = None
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder of the cluster"
        )
    local = tempfile.mkdtemp(prefix="tokenloom-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{os.getpid()}-{next(_counter)}"


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that no frame will read again."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


#: Most bytes of an Arrow batch between the JVM and Python in a job that writes a table.
ARROW_BYTES = 8 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs run inside send Arrow batches of at most `ARROW_BYTES`, if the
    session allows more: a batch is held by the JVM, outside its heap, and by
    the Python worker, once for what goes in and once for what comes out."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    allowed = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(key, str(min(allowed, ARROW_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (survives executor loss).

    One job computes the rows and writes them as they come; nothing of them is
    cached, so an executor's memory does not grow with the table."""
    checkpoint_dir(df.sparkSession)
    with small_batches(df.sparkSession):
        return df.checkpoint(eager=True)


def persist(df: DataFrame) -> DataFrame:
    """Cache that spills; recomputed from lineage if an executor is lost."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `tokenloom` importable in Python workers (what `--py-files` does):
    zip the package once per application and add it to the context."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    if "tokenloom" in (sc.getConf().get("spark.submit.pyFiles", "") or ""):
        _SHIPPED.add(app)  # already distributed at submit time
        return
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="tokenloom-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.join("tokenloom", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def spread(df: DataFrame, order: str | None = None) -> DataFrame:
    """Spread CPU-heavy per-row work over all cores when the source has fewer
    input splits than the default parallelism (e.g. one parquet row group).
    A large input already has many splits and is left as is (no shuffle).
    Round-robin repartitioning sorts first, so retried tasks see the same rows;
    with `order`, rows are dealt by ranges of that column and stay in its order."""
    if df.isStreaming:
        return df  # micro-batches are split by the source
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        if order:
            return df.repartitionByRange(target, order).sortWithinPartitions(order)
        return df.repartition(target)
    return df


MAX_BROADCAST_ROWS = 1 << 20


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast `df` only after checking its size; beyond `max_rows` it is
    returned as is and the planner joins by shuffle (with AQE skew handling)."""
    if df.count() <= max_rows:
        from pyspark.sql import functions as F

        return F.broadcast(df)
    return df
