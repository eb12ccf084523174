"""Connected components of an edge table, by minimum neighbours and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.packed import saved


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not the smallest
    of its component; root is the smallest node.

    Each round points every node at its smallest neighbour, carries its other
    neighbours over to that one, and then halves the paths.  Rounds end when
    every node has one edge, which leads to a root; their number grows with the
    logarithm of the longest path.  Each round is a written table, so a lost
    executor costs at most one round.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), spark)
    while True:
        least = now.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        near = now.join(least.select("u", "m"), "u")
        carried = (near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(least.select("u", F.col("m").alias("v"))).distinct())
        carried = saved(carried, spark)
        parent = carried.groupBy("u").agg(F.min("v").alias("up"))
        jumped = (carried.join(parent.withColumnRenamed("u", "v"), "v", "left")
                  .select("u", F.coalesce("up", "v").alias("v"), F.col("up").isNotNull().alias("moved")))
        now = saved(jumped.groupBy("u", "v").agg(F.max("moved").alias("moved")), spark)
        state = now.agg(F.count("*").alias("n"), F.countDistinct("u").alias("nodes"), F.max("moved").alias("moved")).first()
        if not state["moved"] and state["n"] == state["nodes"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = now.select("u", "v")
