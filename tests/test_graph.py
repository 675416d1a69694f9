import random
from collections import deque

from quire.plans.graph import bounded_crawl, closure, frontier_search


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def _ids(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def _bfs(pairs, seeds, max_hops=None, blocked=(), stoppers=()):
    adj = {}
    for s, d in pairs:
        adj.setdefault(s, []).append(d)
    hop = {s: 0 for s in seeds if s not in blocked}
    q = deque(hop)
    while q:
        u = q.popleft()
        if u in stoppers or (max_hops is not None and hop[u] >= max_hops):
            continue
        for v in adj.get(u, []):
            if v not in hop and v not in blocked:
                hop[v] = hop[u] + 1
                q.append(v)
    return hop


def test_closure_shapes(spark):
    # chain 1-2-3, diamond 1-4-6 / 1-5-6, self-loop 7, 3-cycle 8-9-10, unreachable 11
    pairs = [(1, 2), (2, 3), (1, 4), (1, 5), (4, 6), (5, 6), (7, 7), (3, 8), (8, 9), (9, 10), (10, 8), (11, 1)]
    got = {r.id for r in closure(_edges(spark, pairs), _ids(spark, [1, 7])).collect()}
    assert got == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10}
    assert closure(_edges(spark, pairs), _ids(spark, [])).count() == 0


def test_excluded_inner_node_keeps_children(spark):
    pairs = [(1, 2), (2, 3)]
    got = closure(_edges(spark, pairs), _ids(spark, [1])).join(_ids(spark, [2]), "id", "left_anti")
    assert {r.id for r in got.collect()} == {1, 3}


def test_frontier_matches_bfs_on_random_graph(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(150)]
    blocked, stoppers = {5, 17}, {9, 23, 40}
    want = _bfs(pairs, [0, 1, 2], max_hops=3, blocked=blocked, stoppers=stoppers)
    got = frontier_search(_edges(spark, pairs), _ids(spark, [0, 1, 2]), max_hops=3,
                          blocked=_ids(spark, blocked), stoppers=_ids(spark, stoppers))
    assert {r.id: r.hop for r in got.collect()} == want


def test_crawl_depths_and_shorter_second_path(spark):
    # 0 -> 1 -> 2 -> 3 and a shortcut 0 -> 3
    pairs = [(0, 1), (1, 2), (2, 3), (0, 3)]
    e = _edges(spark, pairs)
    assert bounded_crawl(e, _ids(spark, [0]), 0).count() == 0
    assert {r.id for r in bounded_crawl(e, _ids(spark, [0]), 1).collect()} == {0}
    d2 = {r.id: r.hop for r in bounded_crawl(e, _ids(spark, [0]), 2).collect()}
    assert d2 == {0: 0, 1: 1, 3: 1}
    # a banned seed is never visited
    assert bounded_crawl(e, _ids(spark, [0]), 3, blocked=_ids(spark, [0])).count() == 0


def test_hub_node_edges_are_not_one_partition(spark):
    from quire.plans.graph import _prepare_edges
    hub = [(0, i) for i in range(1, 3001)] + [(i, i + 1) for i in range(1, 3000)]
    # small test data would be coalesced into one partition by AQE; look at the partitioning itself
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        e = _prepare_edges(_edges(spark, hub), "src", "dst")
        sizes = [len(p) for p in e.rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 0.6 * len(hub)


def test_large_visited_path_matches_bfs(spark, monkeypatch):
    import quire.plans.graph as g
    monkeypatch.setattr(g, "BROADCAST_MAX_ROWS", 5)   # force the large-visited branch
    rnd = random.Random(21)
    pairs = [(rnd.randint(0, 90), rnd.randint(0, 90)) for _ in range(260)]
    want = _bfs(pairs, [0, 1], max_hops=None, blocked={4}, stoppers={7, 8})
    got = g.frontier_search(_edges(spark, pairs), _ids(spark, [0, 1]), blocked=_ids(spark, [4]),
                            stoppers=_ids(spark, [7, 8]))
    assert {r.id: r.hop for r in got.collect()} == want


import pytest


@pytest.mark.parametrize("threshold", [200_000, 4])
def test_grouped_search_equals_one_search_per_group(spark, monkeypatch, threshold):
    import quire.plans.graph as gmod
    from quire.plans.graph import grouped_frontier_search
    monkeypatch.setattr(gmod, "BROADCAST_MAX_ROWS", threshold)  # 4 forces the large-visited path
    rnd = random.Random(8)
    groups = {"a": (3, {5}), "b": (1, set()), "c": (None, {2, 3})}  # group -> (max hops, stoppers)
    edge_rows, seed_rows, bound_rows, stop_rows, want = [], [], [], [], {}
    for gname, (mh, stops) in groups.items():
        pairs = [(rnd.randint(0, 30), rnd.randint(0, 30)) for _ in range(60)]
        seeds = [0, 1]
        edge_rows += [(gname, s, d) for s, d in pairs]
        seed_rows += [(gname, s) for s in seeds]
        bound_rows.append((gname, 1000 if mh is None else mh))
        stop_rows += [(gname, s) for s in stops]
        for node, h in _bfs(pairs, seeds, max_hops=mh, stoppers=stops).items():
            want[(gname, node)] = h
    got = grouped_frontier_search(
        spark.createDataFrame(edge_rows, "g string, src long, dst long"),
        spark.createDataFrame(seed_rows, "g string, id long"),
        spark.createDataFrame(bound_rows, "g string, max_hop int"),
        stoppers=spark.createDataFrame(stop_rows, "g string, id long"))
    assert {(r.g, r.id): r.hop for r in got.collect()} == want


def test_grouped_search_with_shared_edges(spark):
    from quire.plans.graph import grouped_frontier_search
    rnd = random.Random(12)
    pairs = [(rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(90)]
    seeds = {"a": [0], "b": [5, 9], "c": [33]}
    want = {}
    for g, sd in seeds.items():
        for node, h in _bfs(pairs, sd).items():
            want[(g, node)] = h
    got = grouped_frontier_search(
        spark.createDataFrame(pairs, "src long, dst long"),
        spark.createDataFrame([(g, s) for g, sd in seeds.items() for s in sd], "g string, id long"),
        spark.createDataFrame([(g, 10 ** 6) for g in seeds], "g string, max_hop int"))
    assert {(r.g, r.id): r.hop for r in got.collect()} == want
