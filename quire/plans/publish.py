"""Publishing (K4-K6, J7, J8): snapshot diff against the previous run and
the upload manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import basename
from quire.operators.ordering import number_rows
from quire.session import shared_table


def row_hash(cols: Sequence[str]) -> F.Column:
    """Content hash of a catalog row; NULL and '' hash differently."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def snapshot_diff(prev: DataFrame, new: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """K5 (re-aimed full reconciliation): one row per key of either
    snapshot with action insert / update / delete / same. Both sides are
    reduced to (keys, hash) before the full outer join."""
    p = prev.select(*keys, row_hash(value_cols).alias("_h_prev"))
    n = new.select(*keys, row_hash(value_cols).alias("_h_new"))
    j = p.join(n, list(keys), "full_outer")
    action = (F.when(F.col("_h_prev").isNull(), "insert").when(F.col("_h_new").isNull(), "delete")
              .when(F.col("_h_prev") == F.col("_h_new"), "same").otherwise("update"))
    return j.select(*keys, action.alias("action"))


def with_store(catalog: DataFrame, stores: DataFrame, target: str = "crawl_target") -> DataFrame:
    """Only targets with a configured store id are published."""
    return catalog.join(stores, catalog[target] == stores[stores.columns[0]], "left_semi")


def upload_manifest(metadata: DataFrame, bodies: DataFrame, uri: str = "uri", body_file: str = "filename",
                    target: str = "crawl_target") -> DataFrame:
    """K6 + J8 + P13: metadata records matched to written bodies by base
    name; a record whose body is missing is listed as ``missing_body``
    (one missing file does not stop the rest)."""
    m = metadata.withColumn("filename", basename(uri))
    b = bodies.select(F.col(target).alias("_t"), F.col(body_file).alias("_f")).distinct()
    cond = (m[target] == b["_t"]) & (m["filename"] == b["_f"])
    j = m.join(b, cond, "left")
    return j.withColumn("status", F.when(F.col("_f").isNull(), "missing_body").otherwise("ready")).drop("_t", "_f")


def destination_manifest(metadata: DataFrame, bodies: DataFrame, destinations: DataFrame, stores: DataFrame,
                         order: Sequence[str] = ("run_ord",)) -> DataFrame:
    """What each target sends where: (crawl_target, destination,
    store_id, seq, filename, title, status).

    ``destinations`` (crawl_target, destination) and ``stores`` (target,
    store_id) are configuration. A ``gcp`` target uploads every written
    body, by name; its store, if it has one, is refreshed afterwards. A
    ``dify`` target is uploaded only if it has a store, record by record in
    the order of its metadata log (repeated records included), with the
    record's title; a record without a written body is ``missing_body``.
    Targets with another destination send nothing. Sequences are numbered
    in range slices, so a target of any size is spread."""
    conf = destinations.join(stores.select(F.col(stores.columns[0]).alias("crawl_target"), "store_id"), "crawl_target", "left")
    files = bodies.select("crawl_target", "filename").distinct()
    to = lambda name: F.broadcast(conf.where(F.col("destination") == name))
    folder = number_rows(files.join(to("gcp"), "crawl_target"), ["crawl_target"], [("filename", True)], "seq").select(
        "crawl_target", "destination", "store_id", "seq", "filename", F.lit(None).cast("string").alias("title"), F.lit("ready").alias("status"))
    records = metadata.join(to("dify").where("store_id is not null"), "crawl_target").select(
        "crawl_target", "destination", "store_id", *order, basename("metadata.content.uri").alias("filename"),
        F.col("metadata.structData.title").alias("title"), F.to_json("metadata").alias("_line"))
    listed = number_rows(records, ["crawl_target"], [*[(c, True) for c in order], ("_line", True)], "seq")
    there = files.withColumn("_there", F.lit(True))
    listed = listed.join(there, ["crawl_target", "filename"], "left").select(
        "crawl_target", "destination", "store_id", "seq", "filename", "title",
        F.when(F.col("_there"), "ready").otherwise("missing_body").alias("status"))
    return folder.unionByName(listed)


def _clear_partitions(spark, folder: str, column: str, values: Sequence[str]) -> None:
    """Delete ``folder/column=value`` for each value (Hadoop file system of the folder)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for v in values:
        name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(v)
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{column}={name}")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)


def publish_snapshot(documents: DataFrame, metadata: DataFrame, out_dir: str, *,
                     prev_catalog: DataFrame | None = None, stores: DataFrame | None = None,
                     order: Sequence[str] = ("run_ord",), targets: Sequence[str] = (),
                     destinations: DataFrame | None = None) -> dict[str, DataFrame]:
    """L4: write the target snapshots and return the catalog, the diff
    against the previous catalog and the upload manifest.

    documents: latest wins per (target, file name) (A5), written as
    Parquet replacing only the targets present (K2, K4); metadata: the
    NDJSON log keeps every record of the run (K1); catalog: latest record per
    (target, file name) (A4, P20, K3). ``targets`` names every target of
    the run: one that produced nothing has its old snapshot cleared too.
    With ``destinations`` (and ``stores``), ``uploads`` lists what each
    target sends where (see :func:`destination_manifest`)."""
    from quire.plans import catalog as cat
    from quire.operators.dedupe import latest_rows
    # ties in the run order are broken by content, so a rerun publishes the same rows
    docs = latest_rows(documents, ["crawl_target", "filename"], list(order), "body")
    cat.write_documents(docs.drop(*order), f"{out_dir}/documents")
    flat = cat.flatten(metadata.withColumn("_tie", F.md5(F.to_json(F.col("metadata")))), "metadata")
    spark = documents.sparkSession
    new = shared_table(spark, cat.build_catalog(flat, [*order, "_tie"]).drop(*order, "_tie"))
    out = {}
    if prev_catalog is not None:  # before the previous catalog may be replaced below
        out["diff"] = shared_table(spark, snapshot_diff(prev_catalog, new, ["crawl_target", "filename"],
                                                        ["id", "title", "webUrl", "createdAt", "mimeType", "uri"]))
    # the catalog and the log are replaced per target, like the documents
    prev_mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        cat.write_metadata(metadata, f"{out_dir}/metadata", mode="overwrite")
        new.write.mode("overwrite").partitionBy("crawl_target").parquet(f"{out_dir}/catalog")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev_mode)
    if targets:
        # K4: a configured target without any document this run is emptied (the target list is the
        # configuration, so collecting the distinct targets that did produce rows is bounded)
        present = {r[0] for r in new.select("crawl_target").distinct().collect()}
        empty = [t for t in targets if t not in present]
        for part in ("documents", "catalog", "metadata"):
            _clear_partitions(spark, f"{out_dir}/{part}", "crawl_target", empty)
    catalog = out["catalog"] = spark.read.parquet(f"{out_dir}/catalog")
    published = catalog if stores is None else with_store(catalog, stores)
    bodies = documents.sparkSession.read.parquet(f"{out_dir}/documents").select("crawl_target", "filename")
    out["manifest"] = upload_manifest(published, bodies)
    if destinations is not None:
        none = spark.createDataFrame([], "target string, store_id string")
        out["uploads"] = destination_manifest(metadata, bodies, destinations, none if stores is None else stores, order)
    return out
