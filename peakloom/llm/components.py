"""Connected components of links between documents, on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, materialise


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of edges: the smallest node that it is linked to, directly or not.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): every node's larger, then smaller,
    neighbours are linked to the least node around it, until nothing changes. A step is a minimum by
    node, combined before it shuffles, and a join that broadcasts the minima of hubs (common.attach), so no task
    holds a hub's edges; no neighbourhood is collected. Both steps make one table.
    Rows with a null or with equal ends count as nodes without links.
    """
    now = materialise(edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).filter("x <> y").distinct())
    seen = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"), F.count("*").alias("n"))
        large = attach(both, least, "x", "n", 2 * seen[0]).filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).filter("x <> y")
        star = attach(large, large.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("n")), "x", "n", seen[0])
        small = star.select(F.explode(F.array(F.struct(F.col("y").alias("x"), F.col("m").alias("y")), F.struct("x", F.col("m").alias("y")))).alias("e")).select("e.*")
        new = materialise(small.filter("x <> y").distinct())
        if (after := _state(new)) == seen:
            break
        now, seen = new, after
    found = new.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("component"))
    return found.unionByName(new.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Number and hashes of distinct edges: equal for equal sets."""
    h = F.xxhash64("x", "y")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())
