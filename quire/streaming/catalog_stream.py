"""The catalog upsert (A4, K3) as a Structured Streaming job.

Metadata records land as NDJSON files (one JSON record per line with a
``seq`` for latest-wins). A streaming aggregation keeps the latest record
per (crawl target, file name) in the state store; each micro-batch emits
the keys it changed (update mode) and ``foreachBatch`` writes them to a
folder named by the batch id. A replayed batch rewrites the same folder
with the same rows, so replays are no-ops. The catalog is the latest row
per key over all batch folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators.dedupe import latest_by
from quire.plans.catalog import METADATA_SCHEMA, flatten

LANDED_SCHEMA = METADATA_SCHEMA + ", crawl_target string, seq long"
KEYS = ["crawl_target", "filename"]


def catalog_updates(records: DataFrame) -> DataFrame:
    """Latest catalog row per key, as a (streaming) aggregation."""
    flat = flatten(records)
    rest = [c for c in flat.columns if c not in KEYS]
    return flat.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), F.col("seq")).alias("_row")).select(*KEYS, "_row.*")


def start(spark: SparkSession, landing: str, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the upsert stream from ``landing`` into ``out``."""
    src = spark.readStream.schema(LANDED_SCHEMA).json(landing)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    w = (catalog_updates(src).writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def current_catalog(spark: SparkSession, out: str) -> DataFrame:
    """The catalog now: the latest row per key over all written batches."""
    rows = spark.read.parquet(out).drop("batch")
    return latest_by(rows, KEYS, ["seq"])
