"""Connected components of an edge table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) -> (node, label), label = the smallest node of the component.

    Each round is two aggregations and two joins on node ids and is written to
    the shared folder; the edge table never grows beyond its number of nodes
    after the first round.  A node of very high degree is one key of a join
    whose other side has one row per key, so adaptive skew splitting applies.
    Loops (u = v) add nothing; nodes without another node do not appear."""
    e = edges.where("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct()
    e = written(e, "edges")
    before = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # here u > v throughout: link the lower neighbours of each node to the lowest
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = written(small.where("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
