"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import scratch_path, ship_package

#: Word separators of every contract: space and the ASCII controls 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rows_of(docs: DataFrame, *columns: str) -> DataFrame:
    """Only `columns`, null texts as empty: other columns of the input, with
    whatever names, never meet the operators' own."""
    ship_package(docs.sparkSession)
    return docs.select(
        *(F.coalesce(docs[c], F.lit("")).alias(c) if c in ("text", "html") else docs[c].alias(c) for c in columns)
    )


#: Spark removes a query's shuffle files when the query has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, paths: list[str] | None = None, **options: str) -> DataFrame:
    """`df` as a table below the shared checkpoint folder: it is computed once,
    and a lost executor costs a reread.  The shuffles of the write are freed
    with it.  `paths`, if given, gets the table's path, for `discard`."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if paths is not None:
        paths.append(path)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").options(**options).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that no frame will read again."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    paths.clear()


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc) of every row of `docs`, doc with all its columns, as a table:
    the numbers stay the rows' own however later scans are split."""
    ship_package(docs.sparkSession)
    whole = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*(docs[c] for c in docs.columns)).alias("doc")
    )
    return written(whole, "rows", compression="zstd")


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether `df` has at most `max_rows` rows, read no further than needed."""
    return df.limit(max_rows + 1).count() <= max_rows


#: What an operator keeps in a worker process between tasks; one operator's at a time.
_KEPT: dict[tuple, object] = {}


def kept(owner: tuple, make=None):
    """`make()`, made once per worker process and owner.  Another owner's turn
    gives the memory of the one before back to the system, so operators that
    run one after the other in the same workers do not add up."""
    if owner not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            import ctypes
            import gc

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library: it keeps what it has
        _KEPT[owner] = make() if make else None
    return _KEPT[owner]


def slices(batches, rows: int = 256):
    """The batches in parts of `rows` rows, so few texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


__all__ = ["SPACES", "discard", "fits", "kept", "numbered", "rows_of", "scratch_path", "slices", "table", "written"]
