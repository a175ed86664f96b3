"""Connected components as a Spark job: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.session import written

MAX_STEPS = 40


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Rows (node, component) for every node of an edge table (a, b); component is the smallest node.

    Ids are of any type that sorts. Each step points nodes at the smallest neighbour they
    know, first for larger neighbours, then for smaller ones; the number of steps grows with
    the logarithm of the longest path. The minimum of a node's neighbours combines before
    the shuffle, and the join back is one that adaptive execution splits where a node is hot.
    The edges of each step are written to the shared folder, which cuts the lineage.
    Edges with a null end and loops are ignored; no edges give no rows.
    """
    links = edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(links.distinct(), name)
    seen = None
    for _ in range(MAX_STEPS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # large-star: every larger neighbour of a node joins the smallest one around it
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        # small-star: a node and its smaller neighbours join the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        links = written(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct(), name)
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
