"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from presslake.session import scratch_dir


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or the not larger) neighbours of each node to its least neighbour."""
    if larger:
        arcs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        arcs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = arcs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    linked = arcs.join(least, "a")
    if larger:
        moved = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; ``root`` is the least node it is linked with.

    Nodes are of any ordered type. A node never gathers its neighbours: each round
    takes minima (combined before the shuffle) and moves edges towards them, and
    the number of rounds grows with the logarithm of the longest path. Edges with
    a null end are left out; no edges give no rows.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = _written(edges.where("a <> b and a is not null and b is not null").distinct(), "edges")
    mark = None
    while True:
        edges = _written(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots)
