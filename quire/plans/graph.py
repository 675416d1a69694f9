"""Frontier loops over edge tables: transitive closure (R1) and the
depth-bounded crawl (R2).

Spark's recursive CTE accepts UNION ALL only, so cycles need an explicit
visited set: each hop joins the frontier with the edges, de-duplicates,
removes what was visited and checkpoints the new frontier into the shared
checkpoint folder (lineage stays one hop long, executors may be lost).
The driver only sees one row count per hop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.filters import BROADCAST_MAX_ROWS
from quire.session import ensure_checkpoint_dir

# visited frontiers are re-compacted into one checkpoint every this many hops
_COMPACT_EVERY = 8


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` into the shared checkpoint folder (lineage cut).
    Measured against writing each frontier as a Parquet table and against
    persisting before the checkpoint: the plain eager checkpoint was the
    fastest of the three for frontier-sized data."""
    return df.checkpoint(eager=True)


def _prepare_edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where(
        F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()
    # Checkpointed once, spread by (src, dst) from the distinct. It is not
    # partitioned by src on purpose: a hub node holding a third of all edges
    # would make one partition (one task) that large on every hop. A small
    # frontier is broadcast against the balanced edge partitions; a large
    # one is shuffled and AQE splits a skewed hub partition.
    return materialize(e)


def _id_set(ids: DataFrame) -> DataFrame:
    return materialize(ids.select(F.col(ids.columns[0]).alias("id")).where(F.col("id").isNotNull()).distinct())


def frontier_search(edges: DataFrame, seeds: DataFrame, *, src: str = "src", dst: str = "dst",
                    seed_col: str = "id", max_hops: int | None = None,
                    blocked: DataFrame | None = None, stoppers: DataFrame | None = None) -> DataFrame:
    """Breadth-first search from ``seeds``: (id, hop) with the minimum hop
    of every reached node, seeds at hop 0.

    ``blocked`` ids are never visited; ``stoppers`` ids are visited but not
    expanded; ``max_hops`` bounds the hop (None = closure).
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    e = _prepare_edges(edges, src, dst)
    # id sets read on every hop are computed once
    if blocked is not None:
        blocked = _id_set(blocked)
    if stoppers is not None:
        stoppers = _id_set(stoppers)
    start = seeds.select(F.col(seed_col).alias("id")).where(F.col("id").isNotNull()).distinct()
    if blocked is not None:
        start = start.join(blocked, "id", "left_anti")
    frontier = materialize(start.withColumn("hop", F.lit(0)))
    layers = [frontier]
    visited = frontier
    hop = 0
    n = frontier.count()
    seen_total = n
    while n > 0 and (max_hops is None or hop < max_hops):
        hop += 1
        expand = frontier.select("id")
        if stoppers is not None:
            expand = expand.join(stoppers, "id", "left_anti")
        # the frontier is broadcast only when its counted size is small
        side = F.broadcast(expand) if n <= BROADCAST_MAX_ROWS else expand
        cand = side.join(e, side["id"] == e["src"]).select(F.col("dst").alias("id")).distinct()
        if blocked is not None:
            cand = cand.join(blocked, "id", "left_anti")
        if seen_total <= BROADCAST_MAX_ROWS:
            # small visited set: AQE broadcasts it into the anti join
            nxt = cand.join(visited.select("id"), "id", "left_anti")
        else:
            # large visited set: never shuffle it when the candidates are few;
            # find the visited candidates by scanning it against the broadcast
            # candidate set, then remove them (both sides small)
            cand = materialize(cand)
            if cand.count() <= BROADCAST_MAX_ROWS:
                hit = visited.select("id").join(F.broadcast(cand), "id", "left_semi")
                nxt = cand.join(hit, "id", "left_anti")
            else:
                nxt = cand.join(visited.select("id"), "id", "left_anti")
        frontier = materialize(nxt.withColumn("hop", F.lit(hop)))
        n = frontier.count()
        if n == 0:
            break
        seen_total += n
        layers.append(frontier)
        visited = visited.unionByName(frontier)
        if len(layers) % _COMPACT_EVERY == 0:
            visited = materialize(visited)
    return visited


def closure(edges: DataFrame, seeds: DataFrame, *, src: str = "src", dst: str = "dst",
            seed_col: str = "id") -> DataFrame:
    """Every node reachable from the seeds, seeds included (ids only)."""
    return frontier_search(edges, seeds, src=src, dst=dst, seed_col=seed_col).select("id")


def bounded_crawl(edges: DataFrame, seeds: DataFrame, depth: int, *, blocked: DataFrame | None = None,
                  stoppers: DataFrame | None = None, src: str = "src", dst: str = "dst",
                  seed_col: str = "id") -> DataFrame:
    """R2: pages saved by a crawl of ``depth`` (1 = the seeds only):
    minimum hop < depth, banned-URL pages never visited, banned-title and
    missing pages visited but not expanded."""
    if depth <= 0:  # nothing is visited; keep the id type of the seeds
        return seeds.select(F.col(seed_col).alias("id"), F.lit(0).alias("hop")).where(F.lit(False))
    return frontier_search(edges, seeds, src=src, dst=dst, seed_col=seed_col, max_hops=depth - 1,
                           blocked=blocked, stoppers=stoppers)


def grouped_frontier_search(edges: DataFrame, seeds: DataFrame, max_hops: DataFrame, *, group: str = "g",
                            stoppers: DataFrame | None = None) -> DataFrame:
    """Many breadth-first searches in one loop: every row carries a group
    (e.g. a crawl target) with its own edges, seeds, stoppers, hop bound and
    visited set. ``edges`` (group, src, dst), (src, dst) shared by all
    groups, or (groups, src, dst) with the list of groups that may follow
    the edge; ``seeds`` (group, id),
    ``max_hops`` (group, max_hop: a small configuration table, broadcast; null = no bound),
    ``stoppers`` (group, id). Returns (group, id, hop), minimum hop per group."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [group, "id"]
    shared = group not in edges.columns  # one edge table for every group (e.g. the child-page tree)
    listed = ["groups"] if "groups" in edges.columns else []
    e = materialize(edges.select(*([] if shared else [group]), *listed, "src", "dst").where(
        F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct())
    bounds = F.broadcast(max_hops.select(group, F.col("max_hop").cast("int").alias("_max")))
    if stoppers is not None:
        stoppers = materialize(stoppers.select(group, F.col(stoppers.columns[1]).alias("id")).distinct())
    start = seeds.select(group, F.col(seeds.columns[1]).alias("id")).where(F.col("id").isNotNull()).distinct()
    frontier = materialize(start.withColumn("hop", F.lit(0)))
    visited, hop, n, layers = frontier, 0, frontier.count(), 1
    seen_total = n
    while n > 0:
        hop += 1
        # only groups whose bound allows another hop expand
        expand = frontier.join(bounds, group).where(F.col("_max").isNull() | (F.col("hop") < F.col("_max"))).select(*keys)
        if stoppers is not None:
            expand = expand.join(stoppers, keys, "left_anti")
        side = F.broadcast(expand) if n <= BROADCAST_MAX_ROWS else expand
        match = side["id"] == e["src"] if shared else (side[group] == e[group]) & (side["id"] == e["src"])
        if listed:
            match = match & F.array_contains(e["groups"], side[group])
        cand = side.join(e, match).select(side[group], F.col("dst").alias("id")).distinct()
        if seen_total <= BROADCAST_MAX_ROWS:
            nxt = cand.join(visited.select(*keys), keys, "left_anti")
        else:  # as in frontier_search: a large visited set is scanned, never shuffled, for few candidates
            cand = materialize(cand)
            if cand.count() <= BROADCAST_MAX_ROWS:
                nxt = cand.join(visited.select(*keys).join(F.broadcast(cand), keys, "left_semi"), keys, "left_anti")
            else:
                nxt = cand.join(visited.select(*keys), keys, "left_anti")
        frontier = materialize(nxt.withColumn("hop", F.lit(hop)))
        n = frontier.count()
        if n == 0:
            break
        seen_total += n
        visited = visited.unionByName(frontier)
        layers += 1
        if layers % _COMPACT_EVERY == 0:
            visited = materialize(visited)
    return visited
