"""Pointer jumping: chains and forests in a number of rounds that grows
with the logarithm of their depth.

Each round replaces a pointer by the pointer of its goal, so after k rounds
it reaches 2^k steps back. A round is one equi-join of narrow rows, written
once to the shared checkpoint folder; the driver sees one count a round.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import shared_table


def rounds_for(n: int) -> int:
    """Rounds after which every pointer of ``n`` nodes has left its chain."""
    return math.ceil(math.log2(max(n, 2))) + 1


def rank_chains(nodes: DataFrame, node: str = "id", before: str = "before") -> DataFrame:
    """List ranking: (``node``, head, position) of every node. ``before``
    is the node in front of it (null, or a node that is not there, for the
    head of a chain). Position counts from 0. Nodes on a cycle or behind
    one have no head: both are null. Nodes are distinct and not null."""
    spark = nodes.sparkSession
    own = nodes.select(F.col(node).alias("id"), F.col(before).alias("up"))
    there = own.select(F.col("id").alias("up"), F.lit(True).alias("_there"))
    linked = own.join(there, "up", "left").select("id", F.when(F.col("_there"), F.col("up")).alias("up"))
    state = shared_table(spark, linked.select(
        "id", "up", F.when(F.col("up").isNull(), F.col("id")).alias("head"),
        F.when(F.col("up").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("far")))
    for _ in range(rounds_for(state.count())):
        live = state.where("up is not null")
        if not live.limit(1).count():
            break
        goal = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("head").alias("_head"), F.col("far").alias("_far"))
        moved = live.join(goal, "up").select("id", F.col("next").alias("up"), F.col("_head").alias("head"), (F.col("far") + F.col("_far")).alias("far"))
        state = shared_table(spark, state.where("up is null").unionByName(moved))
    return state.select(F.col("id").alias(node), "head", F.when(F.col("head").isNotNull(), F.col("far")).alias("position"))


def below(edges: DataFrame, seeds: DataFrame, *, src: str = "src", dst: str = "dst", seed_col: str = "id") -> DataFrame:
    """R1 for deep trees: every node reachable from the seeds, seeds
    included (ids only), like ``graph.closure``.

    Each node keeps one pointer to its smallest parent and a mark that says
    whether a seed lies on the way; pointers double. The other edges
    (further parents) join two parts of the forest: nodes that they reach
    become seeds of another pass over what is not reached yet. A tree of
    any depth takes one pass; cycles end after ``rounds_for`` rounds."""
    spark = edges.sparkSession
    e = shared_table(spark, edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where(
        "src is not null and dst is not null and src <> dst").distinct())
    marks = seeds.select(F.col(seed_col).alias("id")).where("id is not null").distinct()
    ids = e.select(F.col("src").alias("id")).unionByName(e.select(F.col("dst").alias("id"))).unionByName(marks).distinct()
    parents = e.groupBy(F.col("dst").alias("id")).agg(F.min("src").alias("up"))
    forest = shared_table(spark, ids.join(parents, "id", "left"))
    further = shared_table(spark, e.join(parents, (F.col("dst") == F.col("id")) & (F.col("src") == F.col("up")), "left_anti"))
    most = rounds_for(forest.count())
    reached = None
    while True:
        state = shared_table(spark, forest.join(marks.withColumn("_hit", F.lit(True)), "id", "left").select(
            "id", "up", F.coalesce("_hit", F.lit(False)).alias("hit")))
        for _ in range(most):
            live = state.where("not hit and up is not null")
            if not live.limit(1).count():
                break
            goal = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("hit").alias("_hit"))
            moved = live.join(goal, "up").select("id", F.col("next").alias("up"), F.col("_hit").alias("hit"))
            state = shared_table(spark, state.where("hit or up is null").unionByName(moved))
        hit = state.where("hit").select("id")
        reached = hit if reached is None else reached.unionByName(hit)
        marks = shared_table(spark, further.join(hit, F.col("src") == F.col("id"), "left_semi").select(F.col("dst").alias("id")).distinct()
                             .join(reached, "id", "left_anti"))
        if not marks.limit(1).count():
            return reached
        # what is reached has no way back into the rest but over further edges
        rest = forest.join(hit, "id", "left_anti")
        known = rest.select(F.col("id").alias("up"), F.lit(True).alias("_there"))
        forest = shared_table(spark, rest.join(known, "up", "left").select("id", F.when(F.col("_there"), F.col("up")).alias("up")))
