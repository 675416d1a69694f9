"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Nodes of ``edges`` with the smallest node that each reaches:
    (node, root). Nodes without an edge are not listed.

    Each round links every larger neighbour of a node to the smallest
    node of its neighbourhood (large star), then every smaller neighbour
    likewise (small star). Minima are aggregated before the shuffle and
    the joins are plain equi-joins, so a node that a third of all edges
    share stays splittable. The number of rounds grows with the
    logarithm of the largest component; each round is one table in the
    shared folder, and the driver sees one count.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = table(spark, e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.*").where("u <> v").distinct())
        new = table(spark, small)
        # stars: no node is both a leaf and a centre, and no leaf has two centres
        deep = new.join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        twice = deep or new.groupBy("u").count().where("count > 1").limit(1).count()
        e = new
        if not twice:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
