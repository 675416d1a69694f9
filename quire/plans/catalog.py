"""Metadata records, the catalog and the document sinks (P19, P20, U1,
A4-A8, K1-K3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import basename
from quire.operators.dedupe import latest_by

METADATA_SCHEMA = (
    "id string, structData struct<title:string, spaceName:string, webUrl:string, createdAt:string, "
    "updatedAt:string>, content struct<mimeType:string, uri:string>")


def storage_uri(bucket: str, target, filename) -> Column:
    """``gs://<bucket>/<crawl target>/<file name>``."""
    t = F.lit(target) if isinstance(target, str) else target
    return F.concat(F.lit(f"gs://{bucket}/"), t, F.lit("/"), filename)


def metadata_record(id_: Column, title: Column, web_url: Column, created_at: Column, mime: Column,
                    uri: Column, space_name: Column | None = None, updated_at: Column | None = None) -> Column:
    """One metadata struct (wiki records carry spaceName, issue
    records updatedAt)."""
    sd = [title.alias("title")]
    if space_name is not None:
        sd.append(space_name.alias("spaceName"))
    sd += [web_url.alias("webUrl"), created_at.alias("createdAt")]
    if updated_at is not None:
        sd.append(updated_at.alias("updatedAt"))
    return F.struct(id_.cast("string").alias("id"), F.struct(*sd).alias("structData"),
                    F.struct(mime.alias("mimeType"), uri.alias("uri")).alias("content"))


def metadata_line(record: Column) -> Column:
    """K1: one NDJSON line (NULL fields are left out)."""
    return F.to_json(record)


def write_metadata(records: DataFrame, path: str, record: str = "metadata", target: str = "crawl_target",
                   mode: str = "append") -> None:
    """K1: append the metadata log as NDJSON, one folder per crawl target
    (duplicates are kept, as in an append-only log)."""
    (records.select(target, metadata_line(F.col(record)).alias("value"))
     .write.mode(mode).partitionBy(target).text(path))


def write_documents(docs: DataFrame, path: str, target: str = "crawl_target") -> None:
    """K2 + K4: replace the document snapshot of exactly the crawl targets
    present in ``docs`` (dynamic partition overwrite, other targets stay)."""
    spark = docs.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        docs.write.mode("overwrite").partitionBy(target).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def read_metadata(spark, path: str) -> DataFrame:
    """Read the NDJSON metadata log back with a declared schema (never
    inferred); the crawl target comes from the folder name."""
    return spark.read.schema(METADATA_SCHEMA + ", crawl_target string").json(path)


def flatten(records: DataFrame, record: str | None = None) -> DataFrame:
    """P20: catalog columns of a metadata record (spaceName and updatedAt
    are not catalog columns); the key is the file name of the URI."""
    r = (lambda c: F.col(f"{record}.{c}")) if record else F.col
    catalog_cols = ("filename", "id", "title", "webUrl", "createdAt", "mimeType", "uri", "structData", "content")
    return records.select(
        *[c for c in records.columns if c != record and c not in catalog_cols],
        basename(r("content.uri")).alias("filename"), r("id").alias("id"),
        r("structData.title").alias("title"), r("structData.webUrl").alias("webUrl"),
        r("structData.createdAt").alias("createdAt"), r("content.mimeType").alias("mimeType"),
        r("content.uri").alias("uri"))


def build_catalog(flat: DataFrame, order: Sequence[str], keys: Sequence[str] = ("crawl_target", "filename")) -> DataFrame:
    """A4 + K3: one catalog row per (crawl target, file name), the latest
    record by ``order`` winning."""
    return latest_by(flat, list(keys), list(order))


def run_counts(rows: DataFrame, by: Sequence[str] = ("crawl_target", "source")) -> DataFrame:
    """Counts per crawl target and source (the run summary)."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def counts_at(rows: DataFrame, what: str, grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """A8 at every grain in one pass: (grain, the columns of all grains,
    ``what``, n). ``rows`` is a narrow stream of things that a run saw, one
    row each; a grain is a list of its columns. A row without a value for
    the last column of a grain (a page has no issue) does not count there;
    columns outside a grain are null. Rows are expanded and counted before
    the one shuffle, so a hot target is no hot task."""
    cols = list(dict.fromkeys(c for g in grains.values() for c in g))
    sets = [[*[F.col(c) for c in g], F.col(what)] for g in grains.values()]
    out = rows.select(*cols, what).groupingSets(sets, *[F.col(c) for c in cols], F.col(what)).agg(
        F.count(F.lit(1)).alias("n"), *[F.grouping(c).alias(f"_g_{c}") for c in cols])
    name = F.lit(None).cast("string")
    for grain, g in grains.items():
        here = F.lit(True)
        for c in cols:
            here = here & (F.col(f"_g_{c}") == (0 if c in g else 1))
        name = F.when(here & F.col(g[-1]).isNotNull(), grain).otherwise(name)
    return out.withColumn("grain", name).where("grain is not null").select("grain", *cols, what, "n")
