"""Connected components of a link table, by alternating star contractions.

Each round is two grouped minimums and two joins over the links; a node with
very many links is reduced map-side and its join partition is split by AQE.
Links are written out after every round, so no lineage grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every neighbour above u links to the least of u's
    neighbourhood.  Small star: every neighbour below u does, and u itself."""
    if large:
        arcs = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = arcs.join(least, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node in ``links`` (u, v): root is the least node
    reachable.  Nodes are longs; links may repeat, in either direction."""
    edges = _written(links.where("u <> v").select("u", "v").distinct(), name)
    before = None
    while True:
        edges = _written(_star(_star(edges, True), False), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    rooted = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
