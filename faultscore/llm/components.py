"""Connected components of a link table, by alternating star contraction.

Each round links every node's larger neighbours to its least neighbour, then
every node and its smaller neighbours to the least of them; rounds end when
the links no longer change.  Rounds are written to the shared folder, so a
lost executor costs one round at most.  Only two numbers per round reach the
driver.  A hub's links are joined to one row of that hub, which the engine's
skew handling can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every linked id; component is the least id reachable.

    ``links`` has two columns of one integer type; self-links and repeated
    links are allowed, links with a null are ignored.
    """
    a, b = links.columns
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = written(_small_star(_large_star(edges)), "links")
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
