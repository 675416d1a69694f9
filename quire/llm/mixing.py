"""Mixing sources to target weights.

Sizes are summed per source; the target of a source is its share by
weight, at most ``most`` times its size, with the excess shared again
among the others. Each document is taken floor(rate) times, and once more
by a draw that is seeded by a hash of its id and its text; the second and
later ones of equal rows have draws of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quire.llm.common import table
from quire.operators.filters import checked_broadcast
from quire.operators.ordering import number_rows

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
CHUNK = 4096               # equal rows that one task numbers
KEY = ("source", "doc_id", "u", "v")       # of equal rows: u is their draw, v more of the same digest


def words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest(*cols: Column) -> Column:
    return F.md5(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols)).cast("binary"))


def draw(*cols: Column) -> Column:
    """A uniform number of [0, 2**32) from a hash of the columns."""
    return F.conv(F.substring(digest(*cols), 1, 8), 16, 10).cast("long")


def _again(at: Column) -> Column:
    """The draw of the equal row number ``at``, from 0."""
    return F.when(at == 0, F.col("u")).otherwise(draw(F.col("doc_id"), F.col("u"), F.col("v"), at))


def targets(spark: SparkSession, sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
            most: float = MOST) -> DataFrame:
    """(source, source_size) -> the same with weight and target.

    Sources in order of code points, null last, weigh ``weights`` in
    turn and share the whole of all sizes. While a share exceeds ``most``
    times its source's size it stops there and the rest is shared among
    the others by weight. The driver sees two sums a round; sources are
    ranked by range partitions, never in one task.
    """
    n = max(1, min(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranged = table(spark, sizes.repartitionByRange(n, F.col("source").asc_nulls_last())
                   .withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("part").agg(F.count("*").alias("m"))
    before = parts.select("part", (F.sum("m").over(W.orderBy("part")) - F.col("m")).alias("before"))
    ranked = ranged.join(before, "part").withColumn(
        "place", F.col("before") + F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    src = table(spark, ranked.select("source", "source_size", weight.alias("weight")))
    total = src.agg(F.sum("source_size")).first()[0] or 0
    unit = None
    while True:
        over = F.lit(False) if unit is None else F.col("weight") * unit > F.col("source_size") * most
        full, weighing = src.agg(F.sum(F.when(over, F.col("source_size"))),
                                 F.sum(F.when(~over, F.col("weight")))).first()
        new = (total - most * (full or 0)) / weighing if weighing else None
        if new is None or new == unit:
            break
        unit = new
    share = F.col("weight") * (unit or 0.0)
    cap = F.col("source_size") * most
    return src.withColumn("target", F.when(share > cap, cap).otherwise(share).cast("double"))


def cuts(spark: SparkSession, d: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """(source, size, u) -> one row per source: of, source_size, target,
    whole (copies that every document gets) and cut (draws below it, by
    their upper 16 bits, get one more)."""
    bins = table(spark, d.groupBy("source", F.shiftright("u", 16).alias("bin")).agg(F.sum("size").alias("size")))
    goal = targets(spark, bins.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.withColumn("whole", F.floor(rate)).withColumn("want", F.col("target") - F.col("whole") * F.col("source_size"))
    met = (bins.withColumn("past", F.sum("size").over(W.partitionBy("source").orderBy("bin")))
           .join(goal.select(F.col("source").alias("s"), "want"), F.col("source").eqNullSafe(F.col("s")))
           .withColumn("off", F.abs(F.col("past") - F.col("want"))).where("off < want"))
    cut = met.groupBy("s").agg(F.min_by(F.col("bin") + 1, F.struct("off", "bin")).alias("cut"))
    return table(spark, goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut")))


def copies(u: Column, goal: DataFrame) -> Column:
    return goal["whole"] + (F.shiftright(u, 16) < goal["cut"]).cast("long")


def _key(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    more = F.conv(F.substring(digest(docs[id_col], docs[text_col]), 9, 15), 16, 10).cast("long")
    return [docs[source_col].alias("source"), docs[id_col].cast("long").alias("doc_id"),
            draw(docs[id_col], docs[text_col]).alias("u"), more.alias("v")]


def _groups(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Equal rows as one: their key, size and number."""
    rows = docs.select(*_key(docs, id_col, text_col, source_col), words(docs[text_col]).alias("size"))
    return table(spark, rows.groupBy(*KEY).agg(F.max("size").alias("size"), F.count("*").alias("many")))


def _drawn(spark: SparkSession, groups: DataFrame) -> DataFrame:
    """doc_id, source, size and u of every row. Equal rows are numbered in
    chunks, so a hot group is spread over tasks."""
    columns = ("doc_id", "source", "size", _again(F.col("at")).alias("u"))
    single = groups.where("many = 1").select("doc_id", "source", "size", "u")
    few = groups.where(F.col("many").between(2, CHUNK)).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)))
    chunks = (groups.where(F.col("many") > CHUNK)
              .withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1, F.lit(CHUNK).cast("long")))).repartition(*KEY, "first"))
    last = F.least(F.col("first") + CHUNK, F.col("many")) - 1
    many = chunks.withColumn("at", F.explode(F.sequence(F.col("first"), last)))
    return table(spark, single.unionByName(few.select(*columns)).unionByName(many.select(*columns)))


def mix(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """How often a mix takes each document: doc_id, source, size,
    source_size, target and copies; one row per input row.

    A document is taken floor(rate) times, rate being target over size
    of its source, and once more if its draw lies below the cut of its
    source. The draws are uniform and seeded by id and text, so a rerun
    takes the same. The cut is the fraction of the rate, moved to where
    the drawn sizes meet the target: with few or very long documents a
    fixed cut would miss it. Sources of any number of documents are
    handled through sums over 65,536 classes of draws.

    Null or blank texts have size 0; their copies follow the draw as
    well. Null sources are one source. Repeated rows (equal source, id and
    text) are numbered and draw one by one. Other columns are not read.
    """
    d = _drawn(spark, _groups(spark, docs, id_col, text_col, source_col))
    goal = cuts(spark, d, weights, most)
    return d.join(goal, d.source.eqNullSafe(goal.of)).select(
        "doc_id", "source", "size", "source_size", "target", copies(F.col("u"), goal).alias("copies"))


def emit(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``docs`` with each row as often as ``mix`` takes it, all columns
    kept; a row that is not taken is left out. Rows of equal source, id
    and text are numbered in the order of a digest of all their columns."""
    groups = _groups(spark, docs, id_col, text_col, source_col)
    goal = cuts(spark, _drawn(spark, groups), weights, most)
    packed = docs.select(*_key(docs, id_col, text_col, source_col), F.struct(*(docs[c] for c in docs.columns)).alias("own"))
    repeated = table(spark, groups.where("many > 1").select(*(F.col(c).alias(f"r_{c}") for c in KEY)))
    if not repeated.isEmpty():
        keys = checked_broadcast(repeated)
        same = [packed[c].eqNullSafe(keys[f"r_{c}"]) for c in KEY]
        ordered = (packed.join(keys, same).select(*KEY, "own").withColumn("whole_row", F.md5(F.to_json("own").cast("binary")))
                   .withColumn("rid", F.monotonically_increasing_id()))
        numbered = number_rows(ordered, KEY, [("whole_row", True), ("rid", True)], "at")
        packed = (packed.join(keys, same, "left_anti").select("source", "u", "own")
                  .unionByName(numbered.select("source", _again(F.col("at") - 1).alias("u"), "own")))
    rows = packed.join(goal, packed.source.eqNullSafe(goal.of)).withColumn("n", copies(F.col("u"), goal)).where("n > 0")
    return rows.select("own", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("own.*")
