"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeload.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``): for every node of the edges (``u``, ``v``), the least node it is connected to.

    Alternates two contractions until the edges form stars: every node's
    greater neighbours move to its least neighbour, then every node and its
    lesser neighbours do. That takes a number of rounds that grows with the
    logarithm of the nodes. The least neighbours are aggregated before the
    shuffle, and the joins are plain, so a centre of any degree is split by
    adaptive execution. Null ends and loops are ignored.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, known = settled(edges), None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == known:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        known = (state["n"], state["h"])
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = settled(small.select("e.*").where("u <> v").distinct())
