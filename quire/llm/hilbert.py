"""Nearest neighbours along shifted space-filling curves.

Equal vectors are one node. Nodes are projected to a few dimensions,
shifted and ordered along several Hilbert curves; Spark range-partitions
each order, so every node has a place on every curve. How wide the window
around a query must be is measured: for a bounded sample of queries all
vectors are compared, and the window is the distance along the curves
within which the wanted share of their true neighbours lies. A query then
meets the slices of each curve that its window touches; what they find is
merged and reranked with the original vectors.

An exact check may follow (``exact``): the nodes of the first curve lie
in blocks with a centre and a radius, and every block that may hold a
better one for a query is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quire.llm.common import binary, table
from quire.llm.vectors import matrix, valid

CURVES, DIMS, BITS = 12, 6, 10
RECALL, SAMPLE = 0.97, 128 # share of the true neighbours of so many sampled queries that the windows hold
LEAST = 256                # places on either side of a query, at least
SLICE = 8192               # places of a slice of a curve
ROUGH = 2                  # times k nodes by rounded vectors are reranked
SALT = 8                   # parts of the queries of one node
BLOCK = 1024               # rows of a block
QUERIES = 512              # queries of a group
CHUNK = 8                  # blocks that share a copy of the query groups


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points with ``bits``-bit integer
    coordinates (rows); dims * bits must not exceed 62."""
    x = x.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:                       # undo the excess rotations from the top bit down
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):              # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve_keys(v: np.ndarray, curve: int) -> np.ndarray:
    """The places of vectors on one curve: a seeded projection of their
    directions, shifted, within three standard deviations."""
    d = v.shape[1]
    rng = np.random.default_rng(1000 + curve)
    m = min(DIMS, d)
    turn = np.linalg.qr(rng.standard_normal((d, m)))[0]
    shift = rng.random(m) * 0.5
    y = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ turn * np.sqrt(d) / 8 + 0.375 + shift / 2
    return hilbert(np.clip(y * (1 << BITS), 0, (1 << BITS) - 1), BITS)


def _nodes(kind: str):
    """(id, asked, vector as bytes, rounded vector as bytes, its unit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column(2).value_lengths())
            for d in np.unique(size).tolist():
                part = batch.filter(pa.array(size == d))
                v = matrix(part.column(2), d)
                unit = np.abs(v).max(1) / 127
                code = np.rint(v / unit[:, None]).astype(np.int8)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(len(v), d, np.int32)), binary([x.tobytes() for x in v.astype(kind)]),
                     binary([x.tobytes() for x in code]), pa.array(unit)], names=["id", "asked", "dim", "vec", "code", "unit"])
    return run


def _rows(col: pa.Array, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def _by_dim(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    size = np.asarray(batch.column(at))
    for d in np.unique(size).tolist():
        yield d, batch.filter(pa.array(size == d))


def _keys(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in _by_dim(batch, 1):
                v = _rows(part.column(2), kind, d)
                for c in range(CURVES):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(v), c, np.int32)), part.column(1), pa.array(curve_keys(v, c)), part.column(0)],
                        names=["curve", "dim", "key", "id"])
    return run


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (q * x).sum(1)              # one fixed order of addition: equal vectors score equally


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their number within the partition."""
    n = 0
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(n, n + batch.num_rows))], names=[*batch.schema.names, "at"])
        n += batch.num_rows


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` best of a row of scores, ties to the smaller id."""
    if len(score) > k:
        able = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return able[np.lexsort((ids[able], -score[able]))[:k]]
    return np.lexsort((ids, -score))


def _compared(sample: list[tuple[int, bytes]], kind: str, k: int):
    """The ``k`` nodes of a partition that are nearest to each sampled one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for d, part in _by_dim(batch, 1):
                ids, v = np.asarray(part.column(0)), _rows(part.column(2), kind, d)
                for q, vec in sample:
                    x = np.frombuffer(vec, kind).astype(np.float64)
                    if len(x) != d:
                        continue
                    own, score = ids, v @ x
                    if q in best:
                        own, score = np.append(best[q][0], own), np.append(best[q][1], score)
                    score = np.where(own == q, -np.inf, score)
                    t = _top(score, own, k)
                    t = t[score[t] > -np.inf]
                    best[q] = own[t], score[t]
        for q, (own, score) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), q)), pa.array(own), pa.array(score)], names=["query_id", "vec_id", "score"])
    return run


def _slices(k: int, window: int):
    """Sorted rows of (curve, dim, slice), its nodes before the queries
    that touch it: the ``k`` nodes nearest to each query by rounded
    vectors. The nodes of one slice and one batch of queries are held."""
    def found(d: int, ids, pos, v, part: pa.RecordBatch) -> pa.RecordBatch | None:
        qids, at = np.asarray(part.column(5)), np.asarray(part.column(4))
        q = _rows(part.column(6), "i1", d) * np.asarray(part.column(7))[:, None]
        lo, hi = np.searchsorted(pos, at - window), np.searchsorted(pos, at + window, side="right")
        out = []
        for i in range(0, len(q), 256):
            a, b = lo[i:i + 256].min(), hi[i:i + 256].max()
            s = q[i:i + 256] @ v[a:b].T
            for n, row in enumerate(s, i):
                row[ids[a:b] == qids[n]] = -np.inf
                t = _top(row, ids[a:b], k)
                t = t[row[t] > -np.inf]
                out.append((np.full(len(t), qids[n]), ids[a:b][t], row[t]))
        if out:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["query_id", "vec_id", "rough"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        here, nodes = None, None
        for batch in batches:
            cols = [np.asarray(batch.column(c)) for c in range(4)]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
            starts = np.flatnonzero(new)
            for a, b in zip(starts.tolist(), np.append(starts[1:], batch.num_rows).tolist()):
                where, query = tuple(int(c[a]) for c in cols[:3]), bool(cols[3][a])
                part, d = batch.slice(a, b - a), where[1]
                if where != here:
                    here, held, nodes = where, [], None
                if not query:
                    held.append((np.asarray(part.column(5)), np.asarray(part.column(4)),
                                 _rows(part.column(6), "i1", d) * np.asarray(part.column(7))[:, None]))
                elif held:
                    nodes = nodes or [np.concatenate(x) for x in zip(*held)]
                    more = found(d, *nodes, part)
                    if more is not None:
                        yield more
    return run


def _reranked(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in _by_dim(batch, 2):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(_scores(_rows(part.column(3), kind, d), _rows(part.column(4), kind, d)))],
                    names=["query_id", "vec_id", "score"])
    return run


def _packed(size: int, queries: bool):
    """Runs of ``size`` rows of one dim of a sorted partition as one row
    each: dim, ids, vectors, and centre and radius (or the bounds of the
    queries). One run is held at a time."""
    def packed(part: list[tuple]) -> pa.RecordBatch:
        v = np.frombuffer(b"".join(r[2] for r in part), np.float64).reshape(len(part), -1)
        if queries:
            more = np.array([r[3] for r in part])
        else:
            centre = v.mean(0)
            more = np.append(centre, np.sqrt(((v - centre) ** 2).sum(1)).max())
        return pa.RecordBatch.from_arrays(
            [pa.array([part[0][0]], pa.int32()), binary([np.array([r[1] for r in part]).tobytes()]),
             binary([v.tobytes()]), binary([more.tobytes()])], names=["dim", "ids", "vecs", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if part and (len(part) >= size or part[0][0] != row[0]):
                    yield packed(part)
                    part = []
                part.append(row)
        if part:
            yield packed(part)
    return run


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, ids, vecs, ball, qids, qvecs, least in zip(*(c.to_pylist() for c in batch.columns)):
            ids, qids, least = np.frombuffer(ids, np.int64), np.frombuffer(qids, np.int64), np.frombuffer(least)
            v, q, ball = (np.frombuffer(x).reshape(-1, dim) if i < 2 else np.frombuffer(x) for i, x in enumerate((vecs, qvecs, ball)))
            norm = np.sqrt((q * q).sum(1))
            slack = 1e-9 * norm * (np.sqrt((v * v).sum(1)).max() + 1)
            able = np.flatnonzero(q @ ball[:-1] + norm * ball[-1] >= least - slack)
            if not len(able):
                continue
            a, b = np.nonzero(q[able] @ v.T >= (least - slack)[able][:, None])
            a = able[a]
            other = qids[a] != ids[b]
            a, b = a[other], b[other]
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[a]), pa.array(ids[b]), pa.array(_scores(q[a], v[b]))], names=["query_id", "vec_id", "score"])


def _best(found: DataFrame, k: int, score: str = "score") -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc(score), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _parts(spark: SparkSession, rows: int, of: int) -> int:
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + rows // of))


def places(spark: SparkSession, nodes: DataFrame, kind: str) -> DataFrame:
    """curve, dim, id and pos: the place of every node on every curve."""
    keys = nodes.select("id", "dim", "vec").mapInArrow(_keys(kind), "curve int, dim int, key long, id long")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = table(spark, keys.repartitionByRange(n, "curve", "dim", "key", "id").sortWithinPartitions("curve", "dim", "key", "id")
                   .select("curve", "dim", "id").mapInArrow(_numbered, "curve int, dim int, id long, at long")
                   .withColumn("part", F.spark_partition_id()))
    # one row per range and curve: where its places start
    first = ranged.groupBy("curve", "dim", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("curve", "dim").orderBy("part")) - F.col("n") - F.col("low")
    start = first.select("curve", "dim", "part", before.alias("start"))
    return table(spark, ranged.join(start, ["curve", "dim", "part"]).select("curve", "dim", "id", (F.col("at") + F.col("start")).alias("pos")))


def measured_window(spark: SparkSession, nodes: DataFrame, placed: DataFrame, kind: str, k: int, recall: float = RECALL,
                    sample: int = SAMPLE) -> int:
    """Places on either side of a query within which, on some curve, the
    share ``recall`` of the true neighbours of at most ``sample`` queries
    lies. Their vectors are the only ones that the driver sees."""
    asked = nodes.where("asked").orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "vec").collect()
    true = _best(nodes.select("id", "dim", "vec").mapInArrow(
        _compared([(r.id, bytes(r.vec)) for r in asked], kind, k), "query_id long, vec_id long, score double"), k)
    true = table(spark, true.select("query_id", "vec_id"))
    ends = true.select(F.col("query_id").alias("id")).union(true.select(F.col("vec_id").alias("id"))).distinct()
    pos = table(spark, placed.join(F.broadcast(ends), "id", "left_semi"))    # at most sample * (k + 1) nodes
    q = pos.select(F.col("id").alias("query_id"), "curve", F.col("pos").alias("at"))
    near = (true.join(q, "query_id").join(pos.withColumnRenamed("id", "vec_id"), ["vec_id", "curve"])
            .groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("pos") - F.col("at"))).alias("off")))
    off = near.agg(F.percentile("off", recall)).first()[0]
    return max(LEAST, int(np.ceil(off or 0)))


def windows(spark: SparkSession, nodes: DataFrame, placed: DataFrame, kind: str, k: int, window: int) -> DataFrame:
    """The ``k`` best nodes of each query found in the windows of the
    curves: query_id, vec_id, score, rank."""
    slim = nodes.select("id", "asked", "code", "unit").join(placed, "id")
    here = F.floor(F.col("pos") / SLICE)
    rows = slim.select("curve", "dim", here.alias("slice"), F.lit(0).alias("query"), "pos", "id", "code", "unit")
    touched = F.sequence(F.floor(F.greatest(F.col("pos") - window, F.lit(0)) / SLICE), F.floor((F.col("pos") + window) / SLICE))
    asked = slim.where("asked").select("curve", "dim", F.explode(touched).alias("slice"), F.lit(1).alias("query"), "pos", "id", "code", "unit")
    rough = (rows.unionByName(asked).repartition("curve", "dim", "slice").sortWithinPartitions("curve", "dim", "slice", "query", "pos")
             .mapInArrow(_slices(ROUGH * k, window), "query_id long, vec_id long, rough double"))
    once = rough.groupBy("query_id", "vec_id").agg(F.max("rough").alias("rough"))      # several curves find a pair
    few = table(spark, _best(once, ROUGH * k, "rough").select("query_id", "vec_id"))
    full = (few.join(nodes.select(F.col("id").alias("query_id"), "dim", F.col("vec").alias("q")), "query_id")
            .join(nodes.select(F.col("id").alias("vec_id"), "vec"), "vec_id").select("query_id", "vec_id", "dim", "q", "vec"))
    return _best(table(spark, full.mapInArrow(_reranked(kind), "query_id long, vec_id long, score double")), k)


def _checked(spark: SparkSession, nodes: DataFrame, placed: DataFrame, best: DataFrame, kind: str, k: int) -> DataFrame:
    """The ``k`` best nodes of each query, exactly: blocks that cannot
    hold a node better than the last one found are passed over."""
    floor = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    full = nodes.select("id", "asked", "dim", F.col("vec")).join(placed.where("curve = 0").select("id", F.col("pos").alias("key")), "id")
    if kind != "<f8":
        full = full.mapInArrow(_widened(kind), "id long, asked boolean, dim int, vec binary, key long")
    first = table(spark, full)
    n = _parts(spark, first.count(), 4 * BLOCK)
    blocks = table(spark, first.repartitionByRange(n, "dim", "key", "id").sortWithinPartitions("dim", "key", "id")
                   .select("dim", "id", "vec").mapInArrow(_packed(BLOCK, False), "dim int, ids binary, vecs binary, more binary")
                   .withColumn("chunk", F.monotonically_increasing_id()))
    chunks = max(1, blocks.count() // CHUNK)
    asked = (first.where("asked").join(floor.withColumnRenamed("query_id", "id"), "id", "left")
             .select("dim", "key", "id", "vec", F.coalesce("least", F.lit(float("-inf"))).alias("least")))
    groups = table(spark, asked.repartitionByRange(max(1, n // 4), "dim", "key", "id").sortWithinPartitions("dim", "key", "id")
                   .select("dim", "id", "vec", "least").mapInArrow(_packed(QUERIES, True), "dim int, ids binary, vecs binary, more binary"))
    groups = groups.select(F.col("dim").alias("qdim"), F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"),
                           F.col("more").alias("least"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("part"))
    pairs = (blocks.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(chunks)).cast("int")).join(groups, "part")
             .where("dim = qdim").select("dim", "ids", "vecs", "more", "qids", "qvecs", "least"))
    return _best(pairs.mapInArrow(_check, "query_id long, vec_id long, score double"), k)


def _widened(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = binary([np.frombuffer(x, kind).astype(np.float64).tobytes() for x in batch.column(3).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], vecs, batch.column(4)], names=batch.schema.names)
    return run


def nearest(spark: SparkSession, df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding", exact: bool = True, recall: float = RECALL) -> DataFrame:
    """The ``k`` rows with the largest inner product for every query:
    query_id, rank, vec_id, score (double precision, original vectors),
    ties to the smaller id.

    ``is_query`` makes a condition of the id column. Candidates are all
    rows of the query's length but its own. Vectors that are null, zero
    or not finite and rows without an id take no part; of several rows of
    one id the smallest counts. Equal vectors are searched once, so a
    group of copies costs as much as one vector. Without ``exact`` the
    result is what the windows find: they are as wide as the share
    ``recall`` of a sample's true neighbours asks for. Other columns are
    not read; an empty table gives no row.
    """
    kind = "<f4" if df.schema[vec_col].dataType.elementType.simpleString() == "float" else "<f8"
    rows = valid(df, id_col, vec_col).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))     # -0.0 is 0.0
    own = table(spark, rows.select("id", is_query(F.col("id")).alias("query"), "v",
                                   F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")))
    same = ["h1", "h2"]
    ranked = (own.select("id", *same).withColumn("n", F.row_number().over(W.partitionBy(*same).orderBy("id")))
              .where(F.col("n") <= k + 1))
    members = table(spark, ranked.groupBy(*same).agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids")))
    asked = own.where("query").select(*same).distinct().withColumn("asked", F.lit(True))
    heads = members.join(asked, same, "left").select(F.col("node").alias("id"), F.coalesce("asked", F.lit(False)).alias("asked"))
    nodes = table(spark, own.select("id", "v").join(heads, "id").select("id", "asked", "v").mapInArrow(
        _nodes(kind), "id long, asked boolean, dim int, vec binary, code binary, unit double"))
    placed = places(spark, nodes, kind)
    best = windows(spark, nodes, placed, kind, k, measured_window(spark, nodes, placed, kind, k, recall))
    if exact:
        best = _checked(spark, nodes, placed, best, kind, k)
    # the copies of a query's own vector and of each node found, then one list per node
    self = nodes.where("asked").select("id", "dim", F.col("vec").alias("q"), F.col("vec")).selectExpr("id as query_id", "id as vec_id", "dim", "q", "vec")
    found = best.select("query_id", "vec_id", "score").unionByName(self.mapInArrow(_reranked(kind), "query_id long, vec_id long, score double"))
    each = (found.withColumnRenamed("vec_id", "node").join(members.select("node", "ids"), "node")
            .select("query_id", "score", F.explode("ids").alias("vec_id")))
    lists = (_best(each, k + 1).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))).alias("found"))
             .join(members.select(F.col("node").alias("query_id"), *same), "query_id")
             .select(*same, "found", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))
    asked = own.where("query").select(F.col("id").alias("query_id"), *same, F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int").alias("salt"))
    other = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asked.join(lists, [*same, "salt"]).select("query_id", F.posexplode(other).alias("at", "of"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("of.vec_id").alias("vec_id"), (-F.col("of.less")).alias("score")))
