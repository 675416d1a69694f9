"""Run a crawl configuration over landed snapshots and publish it.

    python -m quire run.json

``run.json``::

    {"crawlTargets": {...same shape as the crawl configuration...},
     "landed": {"spaces": "path/spaces.json", "pages": "...", "page_children": "...",
                "attachments": "...", "issues": "...", "comments": "...",
                "test_steps": "...", "web_pages": "..."},
     "baseUrl": "https://corp.example.com", "bucket": "my-bucket",
     "out": "s3://bucket/runs/2024-06-01", "previousCatalog": "s3://bucket/runs/2024-05-31/catalog",
     "stores": {"target-a": "store-id"},
     "customFields": [["Epic", "customfield_10014"], ["Story Points", "customfield_10036"]]}

``crawlTargets`` may also have the shape that ``plans.targets.from_settings``
reads; ``queries`` then gives the predicate of each issue query.

Landed files are JSON lines with the declared schemas of quire.schemas
(Parquet is read as is when the path ends with .parquet).
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.operators.dedupe import first_by
from quire.operators.issues import CUSTOM_FIELDS
from quire.plans.corpus import Corpus, run_targets
from quire.plans.publish import publish_snapshot
from quire.plans.targets import destinations_frame, from_settings
from quire.session import ensure_checkpoint_dir, shared_table

LANDED = {
    "spaces": schemas.SPACE, "pages": schemas.PAGE, "page_children": schemas.CHILD,
    "attachments": schemas.ATTACHMENT, "issues": schemas.ISSUE, "comments": schemas.COMMENTS_RESPONSE,
    "test_steps": schemas.TEST_STEPS_RESPONSE, "web_pages": schemas.WEB_PAGE,
}


def load_tables(spark: SparkSession, landed: dict[str, str]):
    out = {}
    for name, path in landed.items():
        if name not in LANDED:
            raise ValueError(f"unknown landed table {name!r}")
        out[name] = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.schema(LANDED[name]).json(path)
    return out


def execute(spark: SparkSession, run: dict) -> dict:
    """Run one configuration; returns the published DataFrames."""
    targets = run["crawlTargets"]
    if targets and all(isinstance(s, dict) and "targets" in s and "sources" not in s for s in targets.values()):
        targets = from_settings(targets, run.get("queries"))
    for name, spec in targets.items():  # only the current configuration shape is accepted
        if not isinstance(spec, dict) or "sources" not in spec:
            raise ValueError(f"crawl target {name!r}: expected {{'uploadDestination': ..., 'sources': [...]}}")
    ensure_checkpoint_dir(spark)
    tables = load_tables(spark, run["landed"])
    fields = [tuple(f) for f in run["customFields"]] if "customFields" in run else CUSTOM_FIELDS
    corpus = run_targets(spark, targets, tables, base_url=run["baseUrl"], bucket=run["bucket"], custom_fields=fields)
    # the jobs run once: publishing and the summary read what they gave
    corpus = Corpus(shared_table(spark, corpus.documents), shared_table(spark, corpus.metadata), corpus.extra)
    prev = spark.read.parquet(run["previousCatalog"]) if run.get("previousCatalog") else None
    stores = None
    if run.get("stores"):
        stores = spark.createDataFrame(sorted(run["stores"].items()), "target string, store_id string")
    res = publish_snapshot(corpus.documents, corpus.metadata, run["out"], prev_catalog=prev, stores=stores,
                           targets=list(targets), destinations=destinations_frame(spark, targets))
    # The run summary (documents and metadata records per target and media type)
    docs_n = corpus.documents.groupBy("crawl_target", "mime_type").agg(F.count(F.lit(1)).alias("documents"))
    meta_n = corpus.metadata.groupBy("crawl_target", F.col("metadata.content.mimeType").alias("mime_type")).agg(
        F.count(F.lit(1)).alias("metadata_records"))
    res["summary"] = meta_n.join(docs_n, ["crawl_target", "mime_type"], "full_outer").fillna(0)
    extra = dict(corpus.extra)
    if "downloads" in extra:
        # An attachment file that exists already is not overwritten: the first wins
        extra["downloads"] = first_by(extra["downloads"], ["crawl_target", "filename"], ["run_ord", "downloadUrl"])
    for name, df in {**res, **extra}.items():
        if name != "catalog":
            df.write.mode("overwrite").parquet(f"{run['out']}/{name}")
    return res


def main(argv: list[str]) -> int:
    if len(argv) != 1:
        print(__doc__)
        return 2
    with open(argv[0]) as f:
        run = json.load(f)
    spark = SparkSession.builder.appName("quire").config("spark.ui.enabled", "false").getOrCreate()
    try:
        execute(spark, run)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
