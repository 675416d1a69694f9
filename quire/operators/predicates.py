"""Many queries over one table at once (S11, C9 for any number of queries).

A query is a list of equalities and a list of ranges. It waits at its
rarest equality, so rows meet a query only by an equi-join on that field
and value; the other equalities are counted and the ranges checked in the
row. The plan does not grow with the number of queries, and no group with
the rows of a frequent value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import shared_table

SLICE_ROWS = 100_000           # rows of a value that meet its queries in one group; more are dealt over slices

QUERY = "query_id long, equal array<struct<field: string, value: string>>, within array<struct<field: string, low: double, high: double>>"


def answers(rows: DataFrame, key: str, fields: Mapping[str, Column], numbers: Mapping[str, Column], queries: DataFrame,
            query_id: str = "query_id") -> DataFrame:
    """(``query_id``, ``key``): the rows that answer each query.

    ``fields`` names the text values that equalities compare, ``numbers``
    those of ranges (both ends included, a null end is open). ``queries``
    has the columns of ``QUERY``; every query needs an equality, one with
    an unknown field, a null value or none answers nothing; a null in the
    row meets no equality and no range. Keys of rows and ids of queries
    are distinct."""
    spark = rows.sparkSession
    q = queries.select(F.col(query_id).alias("q"), F.array_distinct("equal").alias("equal"), F.coalesce("within", F.array()).alias("within"))
    parts = shared_table(spark, q.select("q", "equal", "within", F.explode("equal").alias("part")))
    # one narrow row per value that some query names
    values = rows.select(F.col(key).alias("k"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), v.cast("string").alias("value")) for f, v in fields.items()])).alias("part"))
    often = shared_table(spark, values.groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    # values of many rows, at most one in SLICE_ROWS of all: few enough for every task, whatever the size of the table
    hot = F.broadcast(often.where((F.col("n") > SLICE_ROWS) & F.col("part.value").isNotNull()))
    seen = parts.join(hot, "part").unionByName(parts.join(hot, "part", "left_anti").join(often, "part", "left"))
    rarest = shared_table(spark, seen.groupBy("q").agg(
        F.min_by(F.struct("part", F.coalesce("n", F.lit(0)).alias("n")), F.struct(F.coalesce("n", F.lit(0)), "part")).alias("at"),
        F.any_value("equal").alias("equal"), F.any_value("within").alias("within")).select("q", "at.part", "at.n", "equal", "within"))
    slices = F.ceil(F.col("n") / SLICE_ROWS).cast("int")
    own = rows.select(
        F.col(key).alias("k"), F.array(*[F.struct(F.lit(f).alias("field"), v.cast("string").alias("value")) for f, v in fields.items()]).alias("parts"),
        F.map_from_arrays(F.array(*map(F.lit, numbers)), F.array(*[v.cast("double") for v in numbers.values()])).alias("numbers")
        if numbers else F.lit(None).cast("map<string,double>").alias("numbers"))
    # rows of a hot value go nowhere without a query that waits there, else into slices, each with all its queries
    waited = F.broadcast(hot.join(rarest.where(F.col("n") > SLICE_ROWS).select("part").distinct().withColumn("waited", F.lit(True)), "part", "left")
                         .select("part", "waited", slices.alias("slices")))
    met = (own.withColumn("part", F.explode("parts")).where("part.value is not null").join(waited, "part", "left")
           .where("slices is null or waited").withColumn("slice", F.coalesce(F.pmod(F.xxhash64("k"), "slices").cast("int"), F.lit(0)))
           .drop("waited", "slices"))
    waiting = rarest.withColumn("slice", F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1))).drop("n")
    counted = F.size(F.array_intersect("equal", "parts")) == F.size("equal")
    inside = F.forall("within", lambda w: F.coalesce(
        F.try_element_at("numbers", w["field"]).between(F.coalesce(w["low"], F.lit(float("-inf"))), F.coalesce(w["high"], F.lit(float("inf")))),
        F.lit(False)))
    return met.join(waiting, ["part", "slice"]).where(counted & inside).select(F.col("q").alias(query_id), F.col("k").alias(key))
