"""Connected components of an edge table, by rounds of joins.

Rounds of large-star and small-star: every node's larger neighbours are tied to
its least neighbour, then its smaller ones, until nothing changes. Groups end
as stars around their least node after about log(n) rounds. Each round is
written to the shared folder, so lineage stays short and lost executors cost
one round. Neighbour lists are never gathered: a node's least neighbour is an
aggregate, and it is joined back to the node's edges. Joins are sorted ones, as
broadcasts of many rounds would fill the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import spent, staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("k", "m").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Edge (v, least of u's) for each u and each neighbour v above u."""
    near = _both(edges)
    joined = near.join(_least(near).hint("merge"), near["u"] == F.col("k"))
    return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Edge (v, least) for each u and each neighbour v below u, and for u itself."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = _least(down)
    joined = down.join(least.hint("merge"), down["u"] == F.col("k"))
    tied = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node reachable, for every node of ``edges`` (a, b).

    Loops and repeated edges are allowed; an edge with a null end is left out.
    """
    now = staged(edges.where("a is not null and b is not null").select(F.col("a").alias("u"), F.col("b").alias("v")), "edges")
    loops = now.where("u = v").select(F.col("u").alias("node")).distinct()
    now = now.where("u <> v")
    last, before = None, None
    while True:
        now = staged(small_star(large_star(now)), "star")
        if before is not None:
            spent(before)
        before = now
        # The order of rows is free, so the sum of their hashes tells whether an edge changed.
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == last:
            break
        last = found
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = stars.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    alone = loops.join(stars.unionAll(roots).hint("merge"), "node", "left_anti").withColumn("root", F.col("node"))
    return stars.unionAll(roots).unionAll(alone)
