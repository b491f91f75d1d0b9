"""Structured Streaming forms of the encoder and the piece counter.

`stream_encode`: documents arriving as files are encoded each on its own (the
lazy per-item encoding of the reference), stateless, appended to a parquet
sink; restartable from its checkpoint.

`stream_word_frequencies`: running piece counts of a growing corpus.  Each
micro-batch adds its own counts as a table, from `foreachBatch`; tables of one
level are merged into one of the next when there are FANOUT of them, so
readers sum few tables however long the stream runs, and a count is rewritten
once a level.  A manifest per batch, put in place by an atomic rename, lists
the tables that make up the counts: a reader sees a batch whole or not at all,
also while one is replayed.  No state store is kept.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenloom.operators.bpe import Tokenizer
from tokenloom.operators.codec import broadcast_tokenizer, encoded, pieces_for_encoding
from tokenloom.operators.pretoken import training_pieces

#: Tables of one level that are merged into one of the next.
FANOUT = 8
#: Newest manifests whose tables are kept for readers that have just read them.
KEPT_MANIFESTS = 4
#: Files of one micro-batch, unless the caller says otherwise.
MAX_FILES_PER_TRIGGER = 256


def document_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def encode_stream(docs: DataFrame, tok: Tokenizer, text_col: str = "text") -> DataFrame:
    """Streaming (or batch) documents -> (doc_id, ids); row-wise, no state."""
    bc = broadcast_tokenizer(docs.sparkSession, tok)
    return encoded(docs.select("doc_id", pieces_for_encoding(F.col(text_col), tok.specials).alias("pieces")), bc)


def stream_encode(
    spark: SparkSession,
    source: str,
    schema,
    tok: Tokenizer,
    sink: str,
    checkpoint: str,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Encode every new document file; append (doc_id, ids) to parquet."""
    enc = encode_stream(document_stream(spark, source, schema, max_files_per_trigger), tok)
    return (
        enc.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


class DeltaTables:
    """The manifests and tables of running counts below a folder."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        root = self._path(f"{self.out}/manifests")
        self._fs = root.getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        options = jvm.org.apache.hadoop.fs.Options.Rename
        self._overwrite = spark._sc._gateway.new_array(options, 1)
        self._overwrite[0] = options.OVERWRITE

    def versions(self) -> list[int]:
        folder = self._path(f"{self.out}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def entries(self, version: int) -> list[tuple[int, str]]:
        """(level, table) of a manifest, older tables first."""
        stream = self._fs.open(self._path(f"{self.out}/manifests/{version:012d}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [(int(level), name) for level, name in json.loads(text)]

    def read(self, entries: list[tuple[int, str]]) -> DataFrame:
        """(piece, n) over the tables."""
        if not entries:
            return self.spark.createDataFrame([], "piece string, n long")
        rows = self.spark.read.schema("piece string, n long").parquet(*(f"{self.out}/{name}" for _, name in entries))
        return rows.groupBy("piece").agg(F.sum("n").alias("n"))

    def add(self, counts: DataFrame, version: int, fanout: int = FANOUT) -> None:
        """Add a batch's counts as `version`; adding one again replaces it."""
        before = [v for v in self.versions() if v < version]
        entries = self.entries(before[-1]) if before else []
        entries.append((0, self._write(counts, 0, version)))
        while len(last := entries[-fanout:]) == fanout and len({level for level, _ in last}) == 1:
            level = last[0][0] + 1
            entries[-fanout:] = [(level, self._write(self.read(last), level, version))]
        self._publish(version, entries)
        self._clean(version)

    def _write(self, counts: DataFrame, level: int, version: int) -> str:
        # a name of this attempt: a replayed batch never touches what readers see
        name = f"tables/{version:012d}-{level}-{uuid.uuid4().hex}"
        counts.write.parquet(f"{self.out}/{name}")
        return name

    def _publish(self, version: int, entries: list[tuple[int, str]]) -> None:
        temporary = self._path(f"{self.out}/manifests/.{version:012d}-{uuid.uuid4().hex}")
        stream = self._fs.create(temporary)
        stream.write(bytearray(json.dumps(entries).encode()))
        stream.close()
        self._context.rename(temporary, self._path(f"{self.out}/manifests/{version:012d}"), self._overwrite)

    def _clean(self, version: int) -> None:
        """Delete manifests but the newest, and tables that none of them lists."""
        versions = self.versions()
        kept = versions[-KEPT_MANIFESTS:]
        for v in versions[: -len(kept)]:
            self._fs.delete(self._path(f"{self.out}/manifests/{v:012d}"), False)
        used = {name for v in kept for _, name in self.entries(v)}
        for f in self._fs.listStatus(self._path(f"{self.out}/tables")):
            name = f"tables/{f.getPath().getName()}"
            # newer versions' tables may belong to a batch that is being written
            if name not in used and int(f.getPath().getName().split("-")[0]) <= version:
                self._fs.delete(f.getPath(), True)


def stream_word_frequencies(
    spark: SparkSession,
    source: str,
    schema,
    specials: list[str],
    out: str,
    checkpoint: str,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    fanout: int = FANOUT,
) -> StreamingQuery:
    """Piece counts of every new document file, added to the tables below
    `out` as one version per micro-batch; `read_word_frequencies` sums them."""
    docs = document_stream(spark, source, schema, max_files_per_trigger)

    def write(batch: DataFrame, epoch: int) -> None:
        counts = training_pieces(batch, specials).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
        DeltaTables(batch.sparkSession, out).add(counts, epoch, fanout)

    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_word_frequencies(spark: SparkSession, out: str) -> DataFrame:
    """(piece, n) over all micro-batches written so far."""
    tables = DeltaTables(spark, out)
    versions = tables.versions()
    return tables.read(tables.entries(versions[-1]) if versions else [])
