"""X1 with bounded files: a streaming catalog in levels.

Every micro-batch writes the latest record of its keys as one run. As soon
as ``FAN`` runs of a level are there, they are merged into one run of the
next level, and the merged ones go. A run is named by the batches it
covers, so a replayed batch writes and merges the same runs again. The
number of runs grows with the logarithm of the number of batches, and each
record is rewritten once a level. Deleted keys stay as marks, one row a
key: a later batch may bring records that are older than the deletion. No
state store is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators.dedupe import latest_by
from quire.sources import folders

FAN = 4


def _run(level: int, first: int) -> str:
    return f"level={level}/first={first}"


def _newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_by(df, list(keys), list(order))


def _write(spark: SparkSession, df: DataFrame, folder: str) -> None:
    # one write task a sized partition: small runs are one file
    df.hint("rebalance").write.mode("overwrite").parquet(folder)


def live_runs(spark: SparkSession, out: str) -> list[tuple[int, int]]:
    """(level, first batch) of the complete runs that no higher run covers."""
    levels = sorted((int(n.split("=")[1]) for n in folders.names(spark, out) if n.startswith("level=")), reverse=True)
    live: list[tuple[int, int]] = []
    for level in levels:
        for n in folders.names(spark, f"{out}/level={level}"):
            first = int(n.split("=")[1])
            covered = any(f <= first < f + FAN ** k for k, f in live)
            if not covered and folders.complete(spark, f"{out}/{_run(level, first)}"):
                live.append((level, first))
    return live


def write_batch(spark: SparkSession, batch: DataFrame, number: int, out: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """One batch (its rows hold the keys, the order and ``_deleted``), and
    the merges that it completes."""
    _write(spark, _newest(batch, keys, order), f"{out}/{_run(0, number)}")
    level, first = 0, number
    while (first // FAN ** level + 1) % FAN == 0:
        parts = [first - i * FAN ** level for i in reversed(range(FAN))]
        there = [f"{out}/{_run(level, p)}" for p in parts]
        goal = f"{out}/{_run(level + 1, parts[0])}"
        if not folders.complete(spark, goal):
            if not all(folders.complete(spark, t) for t in there):
                break
            merged = _newest(spark.read.parquet(*there), keys, order)
            _write(spark, merged, goal)
        for t in there:
            folders.delete(spark, t)
        level, first = level + 1, parts[0]


def start(stream: DataFrame, out: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], deleted: Column | None = None,
          available_now: bool = True) -> StreamingQuery:
    """Start the upsert of ``stream`` into ``out``: the row with the
    greatest ``order`` wins a key; rows where ``deleted`` holds end it."""
    spark = stream.sparkSession
    marked = stream.withColumn("_deleted", F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False)))
    w = (marked.writeStream.foreachBatch(lambda df, n: write_batch(spark, df, n, out, keys, order))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def current(spark: SparkSession, out: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The catalog now: the latest row of each key over the live runs."""
    runs = [f"{out}/{_run(*r)}" for r in live_runs(spark, out)]
    return _newest(spark.read.parquet(*runs), keys, order).where("not _deleted").drop("_deleted")
