"""Latest-wins / first-wins by key (A4-A6) and distinct keys.

``max_by`` / ``min_by`` over a struct are declarative aggregates: Spark
runs a partial aggregate before the shuffle, so a hot key is reduced on
every map task and arrives at the reducer as one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = agg(F.struct(*rest), F.struct(*order)).alias("_q_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_q_row.*")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (last wins)."""
    return _pick(df, keys, order, F.max_by)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` (first wins)."""
    return _pick(df, keys, order, F.min_by)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], heavy: str) -> DataFrame:
    """:func:`latest_by` for rows with a large column ``heavy`` (the tie
    behind ``order``, by its MD5): winners are found on narrow rows, and
    the rows themselves are read again and kept only if they won. Of rows
    that are equal in all of these one is kept."""
    tie = F.md5(F.coalesce(F.col(heavy).cast("string"), F.lit(""))).alias("_q_tie")
    narrow = df.select(*keys, *order, tie)
    won = (narrow.groupBy(*keys, *order, "_q_tie").agg(F.count(F.lit(1)).alias("_q_m"))
           .groupBy(*keys).agg(F.max(F.struct(*order, "_q_tie", "_q_m")).alias("_q_w"))
           .select(*[F.col(k).alias(f"_q_k{i}") for i, k in enumerate(keys)],
                   *[F.col(f"_q_w.{c}").alias(f"_q_o{i}") for i, c in enumerate(order)], F.col("_q_w._q_tie").alias("_q_t"), F.col("_q_w._q_m").alias("_q_m")))
    rows = df.withColumn("_q_tie", tie)
    same = rows["_q_tie"] == won["_q_t"]
    for i, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(won[f"_q_k{i}"])
    for i, c in enumerate(order):
        same = same & rows[c].eqNullSafe(won[f"_q_o{i}"])
    once = rows.join(won.where("_q_m = 1"), same, "left_semi").drop("_q_tie")
    several = rows.join(won.where("_q_m > 1"), same, "left_semi").drop("_q_tie").dropDuplicates(list(keys))
    return once.unionByName(several)
