"""Connected components of a graph that is too large for one machine.

Large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)
until nothing changes. Each step is one minimum per node, combined before the shuffle, and one join
with a written table, so that a hub with very many neighbours is split over tasks. Every step is
written to the shared folder, which keeps the lineage short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import written


def _star(spark: SparkSession, edges: DataFrame, large: bool) -> DataFrame:
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    lowest = written(spark, lowest, "star-minima")
    met = near.join(lowest, "u")
    if large:
        found = met.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        found = met.select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v"))
    found = found.where("u <> v").distinct()
    return written(spark, found, "star-edges")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the bigint edges ``(u, v)``.

    ``component`` is the smallest node that can be reached. Loops and repeated edges do no harm; nodes
    without an edge to another node are not listed; no edges give no rows.
    """
    edges = written(
        spark,
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
        "edges",
    )
    state = None
    while True:
        edges = _star(spark, _star(spark, edges, large=True), large=False)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == state:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        state = tuple(now)
