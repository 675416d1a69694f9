"""Versioned snapshots with digest trees (K4, K5).

A version is a folder of its own: its rows by bucket (a hash of the key),
and the digests of the buckets, of groups of buckets, and so on up to one
digest of the whole. Two versions are compared from the top: equal groups
are left out, and only the rows of differing buckets are joined. A version
becomes the current one by one small pointer file, so a run that ends
before leaves the old version in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.publish import row_hash
from quire.sources import folders

BUCKETS = 1 << 12          # fixed for a folder: about the rows of its table over 10,000
FAN = 64                   # nodes of one group
LITERALS = 1000            # differing buckets that are pushed into the scan as a list


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _tree(index: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """(level, node, digest): level 0 are the buckets (of their rows' keys
    and hashes in order), the last level is one node."""
    line = F.to_json(F.struct(*keys, "_hash"))
    level = index.groupBy(F.col("_bucket").cast("long").alias("node")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest")).withColumn("level", F.lit(0))
    out, n, k = level, buckets, 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
        level = level.groupBy((F.col("node") / FAN).cast("long").alias("node")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(
            F.concat_ws(":", F.lpad(F.col("node").cast("string"), 20, "0"), "digest"))), "\n"), 256).alias("digest")).withColumn("level", F.lit(k))
        out = out.unionByName(level)
    return out.select("level", "node", "digest")


def write(df: DataFrame, folder: str, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS) -> str:
    """Write ``df`` (one row per key) as a new version and return its name.
    It is not the current one until :func:`make_current`."""
    spark = df.sparkSession
    name = uuid.uuid4().hex
    at = f"{folder}/versions/{name}"
    rows = df.withColumn("_bucket", bucket_of(keys, buckets)).withColumn("_hash", row_hash(values))
    rows.repartitionByRange("_bucket").sortWithinPartitions("_bucket").write.parquet(f"{at}/rows")
    index = spark.read.parquet(f"{at}/rows").select("_bucket", *keys, "_hash")
    _tree(index, keys, buckets).write.parquet(f"{at}/tree")
    return name


def make_current(spark: SparkSession, folder: str, name: str) -> None:
    folders.write_text(spark, f"{folder}/CURRENT", name)


def current(spark: SparkSession, folder: str) -> str | None:
    return folders.read_text(spark, f"{folder}/CURRENT")


def read(spark: SparkSession, folder: str, name: str | None = None) -> DataFrame:
    """The rows of a version, of the current one without a name."""
    return spark.read.parquet(f"{folder}/versions/{name or current(spark, folder)}/rows").drop("_bucket", "_hash")


def differing(spark: SparkSession, folder: str, old: str, new: str) -> DataFrame:
    """(node) the buckets whose rows differ between two versions, found
    from the top of the trees downwards."""
    a, b = (spark.read.parquet(f"{folder}/versions/{v}/tree") for v in (old, new))
    both = a.select("level", "node", F.col("digest").alias("_a")).join(
        b.select("level", "node", F.col("digest").alias("_b")), ["level", "node"], "full_outer")
    changed = both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("level", "node")
    # a bucket below an equal group cannot differ; digests are bounded by the number of buckets
    top = changed.agg(F.max("level")).first()[0] or 0
    found = changed.where(F.col("level") == top).select("node")
    for level in range(top - 1, -1, -1):
        below = changed.where(F.col("level") == level).select("node")
        found = below.join(found.select(F.col("node").alias("_up")), (F.col("node") / FAN).cast("long") == F.col("_up"), "left_semi")
    return found


def diff(spark: SparkSession, folder: str, old: str | None, new: str, keys: Sequence[str]) -> DataFrame:
    """K5: one row per key of either version with action insert, update,
    delete or same, like ``publish.snapshot_diff``; rows of equal buckets
    are ``same`` without a join. Without an old version all are inserts."""
    index = lambda v: spark.read.parquet(f"{folder}/versions/{v}/rows").select("_bucket", *keys, "_hash")
    if old is None:
        return index(new).select(*keys, F.lit("insert").alias("action"))
    buckets = [r[0] for r in differing(spark, folder, old, new).limit(LITERALS + 1).collect()]
    if len(buckets) <= LITERALS:
        chosen = lambda df: df.where(F.col("_bucket").isin(buckets)) if buckets else df.where(F.lit(False))
        others = lambda df: df.where(~F.col("_bucket").isin(buckets)) if buckets else df
    else:
        nodes = differing(spark, folder, old, new).select(F.col("node").cast("int").alias("_bucket"))
        chosen, others = (lambda how: lambda df: df.join(nodes, "_bucket", how))("left_semi"), (lambda df: df.join(nodes, "_bucket", "left_anti"))
    p = chosen(index(old)).select(*keys, F.col("_hash").alias("_p"))
    n = chosen(index(new)).select(*keys, F.col("_hash").alias("_n"))
    action = (F.when(F.col("_p").isNull(), "insert").when(F.col("_n").isNull(), "delete")
              .when(F.col("_p") == F.col("_n"), "same").otherwise("update"))
    joined = p.join(n, list(keys), "full_outer").select(*keys, action.alias("action"))
    return joined.unionByName(others(index(new)).select(*keys, F.lit("same").alias("action")))


def publish(df: DataFrame, folder: str, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` as the next version, compare it with the current one
    and make it current; returns the comparison."""
    spark = df.sparkSession
    old, new = current(spark, folder), write(df, folder, keys, values, buckets)
    make_current(spark, folder, new)
    return diff(spark, folder, old, new, keys)
