"""Connected components of an edge table: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.llm._util import Stage


def _stars(edges: DataFrame, stage: Stage) -> DataFrame:
    """Tie each neighbour ``v`` of ``u`` (edges u -> v) to the least of u and its neighbours.

    The minima are a staged table, so that the join reads two plain tables and
    Spark may split a node that has a large share of the edges.
    """
    least = stage.table(edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
    return edges.join(least, "u")


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b: longs) the least node that it reaches.

    Large star then small star (Kiveris et al., "Connected Components in
    MapReduce and Beyond"), until a round changes nothing; rounds grow with the
    logarithm of the longest path. Edges stay in Spark throughout: the driver
    gets a count and a checksum a round. Loops and repeated edges are allowed.
    """
    now = stage.table(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _checksum(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, stage).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage.table(large.filter("u <> v").distinct())
        small = _stars(large, stage)  # u > v in every edge
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        small = stage.table(small.filter("u <> v").distinct())
        again = _checksum(small)
        now, stop = small, again == mark
        mark = again
        if stop:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*").alias("n"), F.sum(h.bitwiseAND(F.lit(2**40 - 1))).alias("s"), F.bit_xor(h).alias("x")).first()
    return row["n"], row["s"], row["x"]
