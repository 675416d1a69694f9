"""Embedding near-duplicates: rotated binary codes, Hamming tables, exact
cosine.

Equal vectors of a label are one node. Iterative quantisation learns
rotations that make the signs of the rotated vectors close to the vectors
(balanced codes). The code is cut into disjoint substrings, one table
each; nodes that agree in a substring meet in one bucket. Only codes
travel to the buckets: partners are chosen by the Hamming distance of the
whole code, and the original vectors are read for nodes that have one,
where the cosine confirms each pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import binary, cells_of, table
from quire.llm.graph import components
from quire.llm.vectors import finite, matrix

SAMPLE_ROWS = 10_000       # bound of the sample that the rotations are learned from
MISS = 0.002               # share of pairs right at the limit that share no substring, in expectation
BLOCK = 1024               # nodes in a block of a bucket
ROUNDS = 15
SPREAD = 6.0               # standard deviations that the distance of codes may lie above its mean at the limit


def rotations(sample: np.ndarray, bits: int, seed: int = 5) -> np.ndarray:
    """A dim x bits matrix of orthogonal blocks, each learned from another
    random start by alternating signs and rotation."""
    d = sample.shape[1]
    rng = np.random.default_rng(seed)
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)     # not centred: a bit flips by the angle alone
    out = []
    for _ in range(-(-bits // d)):
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for _ in range(ROUNDS):
            u, _, w = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
            r = (u @ w).T
        out.append(r)
    return np.hstack(out)[:, :bits]


def shape(n: int, cosine: float) -> tuple[int, int]:
    """(bits of a substring, tables): substrings grow with the number of
    vectors, tables so that MISS holds at the limit."""
    p = 1 - math.acos(cosine) / math.pi
    k = max(6, round(math.log2(max(n, 2))) - 5)
    return k, max(1, math.ceil(math.log(MISS) / math.log(1 - p ** k)))


def furthest(k: int, tables: int, cosine: float) -> int:
    """The largest Hamming distance of codes that is looked at. Bits of one
    rotation hang together, so the spread allows for twice that of
    independent bits."""
    n, p = k * tables, math.acos(cosine) / math.pi
    return math.ceil(n * p + 2 * SPREAD * math.sqrt(n * p * (1 - p)))


def _encode(models: dict[int, np.ndarray], k: int):
    kind = np.uint16 if k <= 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column(2).value_lengths())
            for d in np.unique(size).tolist():
                part = batch.filter(pa.array(size == d))
                v = matrix(part.column(2), d)
                on = (v @ models[d] >= 0).reshape(len(v), -1, k)
                keys = (on * (1 << np.arange(k))).sum(2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(keys.astype(np.int32)), pa.list_(pa.int32())),
                     binary([x.tobytes() for x in keys.astype(kind)]), pa.array(np.full(len(v), d, np.int32))],
                    names=["node", "label", "keys", "code", "dim"])
    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches (bucket first) cut where buckets end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = np.asarray(batch.column(0))
        start = int(np.searchsorted(bucket, bucket[-1], side="left"))
        if start or held and held[-1].column(0)[0] != batch.column(0)[0]:
            yield pa.Table.from_batches([*held, batch.slice(0, start)]).combine_chunks()
            held = []
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _likely(k: int, most: int):
    """(bucket, node) of the nodes that have a partner in their bucket: a
    code within ``most`` bits whose first common table is this one."""
    kind = np.uint16 if k <= 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _buckets(batches):
            bucket, at = np.asarray(part.column(0)), np.asarray(part.column(1))
            code = np.frombuffer(b"".join(part.column(3).to_pylist()), kind).reshape(len(bucket), -1)
            able = np.zeros(len(bucket), bool)
            for step in range(1, len(bucket)):           # every node with the one ``step`` places on
                i = np.flatnonzero(bucket[step:] == bucket[:-step])
                if not len(i):
                    break
                differ = code[i] ^ code[i + step]
                near = (np.bitwise_count(differ).sum(1) <= most) & ((differ == 0).argmax(1) == at[i])
                able[i[near]] = able[i[near] + step] = True
            yield pa.RecordBatch.from_arrays([pa.array(bucket[able]), pa.array(np.asarray(part.column(2))[able])], names=["bucket", "node"])
    return run


def _confirmed(k: int, cosine: float):
    """Counts and the links of a spanning forest of the nodes in a cell."""
    kind = np.uint16 if k <= 16 else np.uint32

    def cell(part: list[tuple]) -> pa.RecordBatch | None:
        at, i, j = part[0][3], part[0][1], part[0][2]
        ids, many = np.array([r[5] for r in part]), np.array([r[6] for r in part])
        v = np.array([r[8] for r in part], np.float64)
        code = np.frombuffer(b"".join(r[7] for r in part), kind).reshape(len(part), -1)
        second = np.array([r[4] for r in part])
        norm = np.sqrt((v * v).sum(1))
        a, b = (np.flatnonzero(~second), np.flatnonzero(second)) if i != j else (np.arange(len(part)),) * 2
        near = (v[a] @ v[b].T) / (norm[a][:, None] * norm[b][None, :]) >= cosine
        if i == j:
            near = np.triu(near, 1)
        x, y = np.nonzero(near)
        x, y = a[x], b[y]
        mine = ((code[x] ^ code[y]) == 0).argmax(1) == at    # a pair counts in the first table that both share
        x, y = x[mine], y[mine]
        if not len(x):
            return None
        count = np.bincount(x, many[y], len(part)) + np.bincount(y, many[x], len(part))
        root = np.arange(len(part))
        while True:                                          # smallest place reached inside the cell
            new = root.copy()
            np.minimum.at(new, x, root[y])
            np.minimum.at(new, y, root[x])
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(count[some].astype(np.int64)), pa.array(ids[root[some]])], names=["node", "n", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in cells_of(batches, 3):
            # buckets are hashes of label, length, table and key: rows of one cell that differ in these part again
            for key in sorted({(r[3], r[9], len(r[8])) for r in whole}):
                part = [r for r in whole if (r[3], r[9], len(r[8])) == key]
                found = cell(part) if len(part) > 1 else None
                if found is not None:
                    yield found
    return run


def _links(spark: SparkSession, nodes: DataFrame, coded: DataFrame, k: int, tables: int, cosine: float) -> DataFrame:
    """(node, n, to): how many other vectors a node is linked to in a
    cell, and a node that it reaches there."""
    spread = coded.select(F.posexplode("keys").alias("at", "key"), "node", "label", "code", F.col("dim")).select(
        F.xxhash64("label", "dim", "at", "key").alias("bucket"), "at", "node", "code")
    hot = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > BLOCK).select(
        "bucket", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    hot = table(spark, hot)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cold = spread.join(hot, "bucket", "left_anti").repartition(n, "bucket").sortWithinPartitions("bucket")
    chosen = table(spark, cold.select("bucket", "at", "node", "code").mapInArrow(_likely(k, furthest(k, tables, cosine)), "bucket long, node long"))
    at = F.expr("transform(keys, (key, at) -> struct(at, xxhash64(label, dim, at, key) AS bucket))")
    own = nodes.select("node", "label", "v", F.col("many").alias("many")).join(coded.select("node", "code", "dim", at.alias("places")), "node")
    place = F.filter("places", lambda x: x["bucket"] == F.col("bucket"))
    single = chosen.join(own, "node").select(
        "bucket", F.lit(0).alias("i"), F.lit(0).alias("j"), F.explode(place["at"]).alias("at"), F.lit(False).alias("second"),
        "node", "many", "code", "v", "label")
    mine = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    dealt = (spread.select("bucket", "at", "node").join(hot, "bucket").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(own.drop("places"), "node")
             .select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "at",
                     (F.col("mine") > F.col("other")).alias("second"), "node", "many", "code", "v", "label"))
    cells = single.unionByName(dealt).repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "at")
    return table(spark, cells.mapInArrow(_confirmed(k, cosine), "node long, n long, to long"))


def near_duplicates(spark: SparkSession, df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", cosine: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``df``.

    Vectors of equal label and length are linked when their cosine is at
    least ``cosine``. Rows whose vector is null, zero or not finite, or
    whose label or id is null, link with nothing. Every distinct pair of
    id and vector counts as one vector: repeated rows get one result, and
    rows of one id with other vectors get their own. A bucket of any size
    is dealt into pairs of blocks; a cell gives counts and the links of a
    spanning forest, never its pairs. Other columns are not read.
    """
    v = df[vec_col]
    fine = F.forall(v, lambda x: finite(x)) & F.exists(v, lambda x: x != 0) & df[label_col].isNotNull() & df[id_col].isNotNull()
    label = df[label_col].cast("string")
    # 128 bits of label and vector name a node (-0.0 as 0.0)
    same = F.transform(v, lambda x: x + 0)
    rows = df.select(df[id_col].cast("long").alias("vec_id"), F.when(fine, F.struct(
        F.xxhash64(label, same).alias("a"), F.xxhash64(F.lit("node"), same, label).alias("b"))).alias("mark"), label.alias("label"), v.alias("v"))
    ids = rows.where("mark is not null").select("mark", "vec_id").distinct().groupBy("mark").agg(
        F.count(F.lit(1)).alias("many"), F.min("vec_id").alias("low"))
    held = rows.where("mark is not null").groupBy("mark").agg(F.any_value("label").alias("label"), F.any_value("v").alias("v"))
    nodes = table(spark, held.join(ids, "mark").withColumn("node", F.monotonically_increasing_id()))
    dims = {r[0]: r[1] for r in nodes.groupBy(F.size("v")).count().collect()}
    if dims:
        k, tables = shape(sum(dims.values()), cosine)
        models = {}
        for d, n in dims.items():
            part = nodes.where(F.size("v") == d).where(
                F.pmod(F.xxhash64("low", F.lit("sample")), F.lit(1 << 20)) <= int((1 << 20) * min(1.0, SAMPLE_ROWS / n)))
            sample = np.array([r[0] for r in part.orderBy("low", "mark").select("v").limit(2 * SAMPLE_ROWS).collect()] or [[1.0] * d], np.float64)
            models[d] = rotations(sample, k * tables)
        coded = table(spark, nodes.select("node", "label", F.col("v").cast("array<double>").alias("v")).mapInArrow(
            _encode(models, k), "node long, label string, keys array<int>, code binary, dim int"))
        found = _links(spark, nodes, coded, k, tables, cosine)
    else:
        found = spark.createDataFrame([], "node long, n long, to long")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    root = components(spark, found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    reach = nodes.select("mark", "node", "many", "low").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = reach.groupBy("root").agg(F.min("low").alias("component_id"))
    known = reach.join(low, "root").join(counts, "node", "left").select(
        "mark", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id")
    return (rows.select("vec_id", "mark").join(known, "mark", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))

