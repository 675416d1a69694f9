import os
import tempfile

from pyspark.sql import functions as F

from quire.plans import catalog as cat
from quire.plans import publish as pub
from quire.sources import landed


def _meta(spark):
    rows = [("t1", 1, "id1", "A", "u/f1.html"), ("t1", 2, "id1", "B", "u/f1.html"), ("t1", 3, "id1", "C", "u/f1.html"),
            ("t2", 1, "id1", "Z", "u/f1.html"), ("t1", 4, "id2", "D", "u/f2.pdf")]
    df = spark.createDataFrame(rows, "crawl_target string, seq long, id string, title string, uri string")
    rec = cat.metadata_record(F.col("id"), F.col("title"), F.lit("w"), F.lit("c"), F.lit("text/html"), F.col("uri"))
    return df.select("crawl_target", "seq", rec.alias("metadata"))


def test_catalog_upsert_latest_per_target(spark):
    flat = cat.flatten(_meta(spark), "metadata")
    got = {(r.crawl_target, r.filename): r.title for r in cat.build_catalog(flat, ["seq"]).collect()}
    assert got == {("t1", "f1.html"): "C", ("t2", "f1.html"): "Z", ("t1", "f2.pdf"): "D"}


def test_ndjson_roundtrip_and_dynamic_overwrite(spark):
    base = tempfile.mkdtemp(prefix="quire-test-", dir="/tmp")
    meta = os.path.join(base, "meta")
    cat.write_metadata(_meta(spark), meta)
    back = cat.read_metadata(spark, meta)
    assert back.count() == 5 and back.where("crawl_target = 't2'").first().structData.title == "Z"
    docs = os.path.join(base, "docs")
    d1 = spark.createDataFrame([("t1", "a.html", "x"), ("t2", "b.html", "y")], "crawl_target string, filename string, body string")
    cat.write_documents(d1, docs)
    d2 = spark.createDataFrame([("t1", "c.html", "z")], d1.schema)
    cat.write_documents(d2, docs)
    now = {(r.crawl_target, r.filename) for r in spark.read.parquet(docs).collect()}
    assert now == {("t1", "c.html"), ("t2", "b.html")}


def test_snapshot_diff_applied_to_prev_gives_new(spark):
    prev = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    new = spark.createDataFrame([(2, "b2"), (3, ""), (4, "d")], prev.schema)
    d = {r.k: r.action for r in pub.snapshot_diff(prev, new, ["k"], ["v"]).collect()}
    assert d == {1: "delete", 2: "update", 3: "update", 4: "insert"}
    p = {r.k: r.v for r in prev.collect()}
    n = {r.k: r.v for r in new.collect()}
    for k, a in d.items():
        if a == "delete":
            p.pop(k)
        elif a in ("insert", "update"):
            p[k] = n[k]
    assert p == n


def test_upload_manifest(spark):
    m = spark.createDataFrame([("t", "gs://b/t/a.html"), ("t", "gs://b/t/b.pdf"), ("u", "gs://b/u/c.html")],
                              "crawl_target string, uri string")
    bodies = spark.createDataFrame([("t", "a.html"), ("u", "c.html")], "crawl_target string, filename string")
    stores = spark.createDataFrame([("t", "s1")], "target string, store string")
    got = {r.filename: r.status for r in pub.upload_manifest(pub.with_store(m, stores), bodies).collect()}
    assert got == {"a.html": "ready", "b.pdf": "missing_body"}


def _resp(spark, rows):
    return spark.createDataFrame(rows, "request string, startAt long, maxResults long, total long, issues array<string>")


def test_offset_audit_edge_rows(spark):
    rows = [("exact", 0, 2, 4, ["a", "b"]), ("exact", 2, 2, 4, ["c", "d"]),
            ("short", 0, 2, 3, ["a", "b"]), ("short", 2, 2, 3, ["c"]),
            ("hole", 0, 2, 6, ["a", "b"]), ("hole", 4, 2, 6, ["e", "f"]),
            ("empty", 0, 2, 0, None), ("nofirst", 2, 2, 4, ["c", "d"])]
    got = {r.request: (r.pages, r.rows, r.total, r.has_gap) for r in landed.offset_audit(_resp(spark, rows)).collect()}
    assert got == {"exact": (2, 4, 4, False), "short": (2, 3, 3, False), "hole": (2, 4, 6, True),
                   "empty": (1, 0, 0, False), "nofirst": (1, 2, 4, True)}


def test_unpack_and_cursor_audit(spark):
    r = spark.createDataFrame([("p1", "p2", [("a",), ("b",)]), ("p2", "p9", None), ("p3", None, [])],
                              "request_path string, next_link string, results array<struct<id:string>>")
    assert sorted(x.id for x in landed.unpack(r).collect()) == ["a", "b"]
    assert [(x.request_path, x.next_link) for x in landed.cursor_audit(r).collect()] == [("p2", "p9")]


def test_publish_replaces_targets_and_clears_empty_ones(spark):
    base = tempfile.mkdtemp(prefix="quire-pub2-", dir="/tmp")
    def run(rows, targets):
        docs = spark.createDataFrame([(t, f, "text/html", b, 0) for t, f, b in rows],
                                     "crawl_target string, filename string, mime_type string, body string, run_ord int")
        meta = docs.select("crawl_target", "filename", cat.metadata_record(
            F.col("filename"), F.col("filename"), F.lit("w"), F.lit("c"), F.lit("text/html"),
            F.concat(F.lit("gs://b/"), F.col("crawl_target"), F.lit("/"), F.col("filename"))).alias("metadata"),
            "run_ord")
        pub.publish_snapshot(docs, meta, base, targets=targets)
        return sorted((r.crawl_target, r.filename) for r in spark.read.parquet(f"{base}/documents").collect())
    assert run([("a", "1.html", "x"), ("b", "2.html", "y")], ["a", "b"]) == [("a", "1.html"), ("b", "2.html")]
    # second run: target a produced nothing, target b a new file; a is emptied, b replaced
    assert run([("b", "3.html", "z")], ["a", "b"]) == [("b", "3.html")]


def test_ids_of_a_listing_up_to_its_last_page(spark):
    rows = [("a", 1, [("x",), ("y",)], True), ("a", 2, [("y",), ("z",)], False), ("a", 3, [("stale",)], False),
            ("b", 1, [("x",), ("w",)], True), ("b", 2, None, True), ("b", 4, [("v",)], True), (None, 1, [("u",)], None), (None, 2, [("t",)], True)]
    r = spark.createDataFrame(rows, "store string, page long, data array<struct<id:string>>, has_more boolean")
    assert sorted(x.id for x in landed.distinct_ids(landed.listing_pages(r, keep=["store"])).collect()) == ["u", "v", "w", "x", "y", "z"]
    assert sorted(x.id for x in landed.distinct_ids(landed.listing_pages(r.where("store = 'a'"))).collect()) == ["x", "y", "z"]
    open_ = r.where("store = 'b'")
    assert sorted(x.id for x in landed.distinct_ids(landed.listing_pages(open_)).collect()) == ["v", "w", "x"]


def test_purge_reads_every_listed_id(spark, tmp_path):
    from quire.analogues import purge_id_list
    spark.range(1003).selectExpr("id AS event_id").write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(x.id for x in purge_id_list(spark, str(tmp_path)).collect()) == list(range(1003))
