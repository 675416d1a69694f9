"""Driver queries over the operators for deep, long and large inputs:
closures by pointer jumping, cursor chains, exact coverage of offsets,
pattern tables, query indexes, run counts, URLs and markup of any kind."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.html import decode_entities, href_list, page_title
from quire.functions.urls import normalize_url, resolve_hrefs
from quire.job_queries import BASE_URL, landed_issues
from quire.operators import patterns, predicates, web
from quire.operators.ordering import prefix_sums
from quire.operators.filters import literal_frame
from quire.plans import catalog, corpus, publish, targets, versions
from quire.plans.pointers import below
from quire.session import ensure_checkpoint_dir
from quire.sources import landed
from quire.sources.tables import read_table as _t
from quire.streaming import leveled_catalog

# hosts as they are written and number hosts; the SQL has their ASCII forms
HOSTS = ["BÜCHER.de", "münchen.Example:080", "日本。jp", "0x7f.1", "3232235777", "b%C3%BCcher.DE", "faß.de:0443", "u:p@H.example:00080", "1.2.3.256"]
UPLOADS = {"en": "dify", "de": "gcp", "fr": "gcp", "es": "dify"}
MORE_PATTERNS = ["^(?:The|Die) ", "(?i)r[io]n?g ", "x{3}", r"\bgear\b|zzz"]


def _s(c: str) -> F.Column:
    return F.col(c).cast("string")


def deep_closure(spark: SparkSession, sf: str) -> DataFrame:
    """R1 S9 for deep trees: one chain through all documents (by language
    and id), and edges from document i to 40 i + 1; all below the first
    French document and document 3."""
    d = _t(spark, sf, "documents").select("doc_id", "lang").where("doc_id is not null")
    chain = prefix_sums(d, [], [("lang", True), ("doc_id", True)], {}, {"next": "doc_id"}).select(
        F.col("doc_id").alias("src"), F.col("next").alias("dst"))
    more = d.select(F.col("doc_id").alias("src")).join(
        d.select(((F.col("doc_id") - 1) / 40).alias("at"), F.col("doc_id").alias("dst")).where("at = floor(at)").select(
            F.col("at").cast("long").alias("src"), "dst"), "src")
    first = d.where("lang = 'fr'").agg(F.min("doc_id").alias("id"))
    return below(chain.unionByName(more), first.unionByName(d.where("doc_id = 3").select(F.col("doc_id").alias("id"))))


def cursor_chain(spark: SparkSession, sf: str) -> DataFrame:
    """S3 U2 in order: every turn is a page that names the next turn of its
    conversation, the last one the first turn of the conversation after
    it; conversations that are not there break the chain."""
    c = _t(spark, sf, "conversations").select("conv_id", "turn").where("conv_id is not null and turn is not null").distinct()
    path = lambda conv, turn: F.concat(F.lit("/c/"), F.lpad(conv.cast("string"), 12, "0"), F.lit("?cursor="), turn.cast("string"))
    ends = c.groupBy("conv_id").agg(F.max("turn").alias("last"))
    pages = c.join(ends, "conv_id").select("conv_id", "turn", path(F.col("conv_id"), F.col("turn")).alias("request_path"), F.when(
        F.col("turn") < F.col("last"), path(F.col("conv_id"), F.col("turn") + 1)).otherwise(path(F.col("conv_id") + 1, F.lit(0))).alias("next_link"))
    return landed.cursor_chains(pages)


def offset_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """S4 S5 exactly: turns of a conversation and lines of an order as
    landed offsets; ranges that are missing or landed more than once."""
    c = _t(spark, sf, "conversations").select(F.concat(F.lit("conversation "), _s("conv_id")).alias("request"), F.col("turn").cast("long").alias("start"))
    li = _t(spark, sf, "lineitem").select(F.concat(F.lit("order "), _s("l_orderkey")).alias("request"), (F.col("l_linenumber") - 1).cast("long").alias("start"))
    rows = c.unionByName(li).withColumn("stop", F.col("start") + 1)
    return landed.offset_coverage(rows.withColumn("total", F.col("stop")))


def pattern_table(spark: SparkSession, sf: str) -> DataFrame:
    """C3 C6 C7 C8 for tables of patterns: every word of a part name, in
    any case, and four patterns without a literal, over all documents."""
    words = _t(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("pattern_id")).distinct().select(
        "pattern_id", F.concat(F.lit("(?i)"), F.col("pattern_id")).alias("pattern"))
    more = spark.createDataFrame([(p, p) for p in MORE_PATTERNS], "pattern_id string, pattern string")
    return patterns.matches(_t(spark, sf, "documents"), "doc_id", "text", words.unionByName(more))


def query_index(spark: SparkSession, sf: str) -> DataFrame:
    """S11 C9 for any number of queries: each customer asks for its orders
    of a status (two segments of any) within a range of prices."""
    status = F.when(F.col("c_mktsegment") == "BUILDING", "F").when(F.col("c_mktsegment") == "MACHINERY", "O").when(F.col("c_mktsegment") == "FURNITURE", "P")
    part = lambda f, v: F.struct(F.lit(f).alias("field"), v.alias("value"))
    q = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("query_id"),
        F.filter(F.array(part("status", status), part("customer", _s("c_custkey"))), lambda x: x["value"].isNotNull()).alias("equal"),
        F.array(F.struct(F.lit("price").alias("field"), F.col("c_acctbal").alias("low"), (F.col("c_acctbal") + 200000).alias("high"))).alias("within"))
    orders = _t(spark, sf, "orders")
    return predicates.answers(orders, "o_orderkey", {"customer": F.col("o_custkey"), "status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")},
                              {"price": F.col("o_totalprice")}, q)


def run_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A8 at every grain: pages and links per target, source, space and
    page, comments and steps per issue, in one pass."""
    none = F.lit(None).cast("string")
    row = lambda df, target, source, what, space=none, issue=none, page=none: df.select(
        F.lit(target).alias("crawl_target"), F.lit(source).alias("source"), space.alias("space"), issue.alias("issue"), page.alias("page"),
        F.lit(what).alias("what"))
    pages = _t(spark, sf, "pages").select("page_id", "url", href_list("html").alias("hrefs"))
    links = web.links_from_hrefs(pages, "page_id", "url", "hrefs")
    seen = [row(_t(spark, sf, "documents"), "docs", "wiki", "page", space=F.col("lang"), page=_s("doc_id")),
            row(links, "docs", "web", "link", page=_s("page_id")),
            row(_t(spark, sf, "conversations"), "issues", "tracker", "comment", issue=F.concat(F.lit("O-"), _s("conv_id"))),
            row(_t(spark, sf, "lineitem"), "issues", "tracker", "step", issue=F.concat(F.lit("O-"), _s("l_orderkey")))]
    stream = seen[0]
    for s in seen[1:]:
        stream = stream.unionByName(s)
    own = ["crawl_target", "source"]
    return catalog.counts_at(stream, "what", {"target": own[:1], "source": own, "space": [*own, "space"], "issue": [*own, "issue"], "page": [*own, "page"]})


def _probes(spark: SparkSession, sf: str) -> DataFrame:
    p = _t(spark, sf, "pages").select("page_id", "html")
    return p.withColumn("host", F.element_at(F.array(*map(F.lit, HOSTS)), (F.col("page_id") % len(HOSTS) + 1).cast("int"))).withColumn(
        "title", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1))


def url_class(spark: SparkSession, sf: str) -> DataFrame:
    """P14 P15 of URLs as people write them: hosts beyond ASCII and number
    hosts, ports with zeros, encoded dot segments, and the page's title,
    blanks, accents and quotes included, as a part of the path."""
    url = F.concat(F.lit(" HTTP:\\\\"), F.col("host"), F.lit("/a b/%2E%2e/"), F.translate("title", "?#/\\\t\n\r", ""), F.lit("/./x\\é?q#f"))
    u = _probes(spark, sf).select("page_id", url.alias("url")).select("page_id", normalize_url("url").alias("norm_url"))
    return u.select("page_id", "norm_url", F.md5("norm_url").alias("id"))


def link_lexer(spark: SparkSession, sf: str) -> DataFrame:
    """P17 of markup that patterns misread: '<' and '>' in quoted values,
    anchors inside values, comments, scripts and unclosed tags, references
    without ';', repeated hrefs; behind the page's own markup."""
    n = _s("page_id")
    extra = F.concat(
        F.lit('<p><a title="a > b" href="/x'), n, F.lit('">1</a><a data-x="<" href=\'/y'), n, F.lit("'>2</a><b title=\"<a href='/no'>\">3</b>"),
        F.lit("<textarea><a href='/no'></textarea><!-- <a href=/no> --><script>'<a href=/no>'</script><A\nID=1 HREF = /z"), n,
        F.lit("?copy=1&copy=2&amp;lt=3&notit;&ltx href=/no>4</A><a href>5</a><a name=href>6</a><a href=\"/é b"), n,
        F.lit("&#x2F;&eacute\">7</a><a href=/open \"<a href=/no"))
    p = _t(spark, sf, "pages").select("page_id", F.lit("http://h.example/d/").alias("url"), F.concat(F.regexp_replace("html", "(?s)<a [^>]*>", ""), extra).alias("html"))
    links = p.select("page_id", F.posexplode_outer(resolve_hrefs(href_list("html"), "url")).alias("pos", "l"))
    return links.select("page_id", "pos", "l.link", F.md5("l.norm").alias("id"))


def title_decode(spark: SparkSession, sf: str) -> DataFrame:
    """P16 with the whole table of references, old names without ';'."""
    extra = F.concat(F.lit("<!-- <title>no</title> --><b title='<title>no</title>'></b><TITLE lang=x>A &amp B &check; &notit; &notin &ltx&#65&#x42;&NotEqualTilde;&bogus;&"),
                     _s("page_id"), F.lit("</title ><title>second</title>"))
    p = _t(spark, sf, "pages").select("page_id", F.concat(extra, F.col("html")).alias("html"))
    return p.select("page_id", page_title("html").alias("title"), decode_entities(F.lit("a&copy=1&copy;&copyx&amp"), attribute=True).alias("value"))


def snapshot_tree(spark: SparkSession, sf: str) -> DataFrame:
    """K4 K5 by versions: the two catalogs of ``snapshot_diff`` published
    one after the other, compared by digests of buckets first."""
    d = _t(spark, sf, "documents").select("doc_id", "text")
    prev = d.where(F.col("doc_id") % 5 != 0)
    new = d.where(F.col("doc_id") % 7 != 0).withColumn(
        "text", F.when(F.col("doc_id") % 11 == 0, F.concat(F.col("text"), F.lit(" (edited)"))).otherwise(F.col("text")))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshots/{uuid.uuid4().hex}"
    versions.publish(prev, folder, ["doc_id"], ["text"], buckets=256)
    return versions.publish(new, folder, ["doc_id"], ["text"], buckets=256)


def catalog_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream of 24 files, one a batch; the latest
    event of a user wins, and an error as the latest deletes the user."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"
    e = _t(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    e.repartition(24, "event_id").write.parquet(f"{folder}/landed")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed")
    keys, order = ["user_id"], ["ts", "event_id"]
    leveled_catalog.start(stream, f"{folder}/catalog", f"{folder}/progress", keys, order, F.col("event_type") == "error").awaitTermination()
    return leveled_catalog.current(spark, f"{folder}/catalog", keys, order).select("user_id", "event_id", "event_type")


def upload_order(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as records of four targets (by language)
    with two kinds of destination; every record is in the log twice, two
    of the targets have a store, bodies exist where there is a text."""
    d = _t(spark, sf, "documents").select("doc_id", "lang", "text")
    target = F.concat(F.lit("docs-"), F.col("lang"))
    rec = catalog.metadata_record(F.col("doc_id"), F.concat(F.lit("Title "), _s("doc_id")), F.lit("w"), F.lit("c"), F.lit("text/html"),
                                  F.concat(F.lit("gs://b/x/"), _s("doc_id"), F.lit(".html")))
    log = d.select(target.alias("crawl_target"), rec.alias("metadata"), F.explode(F.array(F.lit(0), F.lit(1))).alias("n"), "doc_id").select(
        "crawl_target", "metadata", (F.col("n") * 10**9 - F.col("doc_id")).alias("run_ord"))
    bodies = d.where("length(text) > 300").select(target.alias("crawl_target"), F.concat(_s("doc_id"), F.lit(".html")).alias("filename"))
    conf = targets.destinations_frame(spark, {f"docs-{x}": {"uploadDestination": y} for x, y in UPLOADS.items()})
    stores = literal_frame(spark, [("docs-en", "store-en"), ("docs-de", "store-de")], "target string, store_id string")
    return publish.destination_manifest(log, bodies, conf, stores)


def landed_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Turns landed as JSON list responses of 16, read with a
    declared schema, unpacked to one row a result."""
    c = _t(spark, sf, "conversations")
    one = F.struct(F.col("turn"), F.struct(_s("turn").alias("id"), "role", "text").alias("item"))
    pages = c.groupBy("conv_id", (F.col("turn") / 16).cast("long").alias("page")).agg(F.array_sort(F.collect_list(one)).alias("l")).select(
        F.concat(F.lit("/c/"), _s("conv_id"), F.lit("?page="), _s("page")).alias("request_path"),
        F.struct(F.lit(None).cast("string").alias("next")).alias("_links"), F.transform("l", lambda x: x["item"]).alias("results"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed/{uuid.uuid4().hex}"
    pages.write.json(folder)
    rows = landed.read_list_responses(spark, folder, "id: string, role: string, text: string")
    return rows.select("request_path", F.col("id").cast("long").alias("turn"), "role", F.md5("text").alias("text_md5"))


def issue_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """The issues that conversations name, looked up by a key table."""
    keys = _t(spark, sf, "conversations").select(F.concat(F.lit("O-"), _s("conv_id")).alias("key"))
    found = corpus.issues_by_key(corpus.issues_view(landed_issues(spark, sf), BASE_URL), keys)
    return found.select("key", "title", "status", "web_url")


def document_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """K2 K4: whole documents written by target (language), then English
    ones once more as another run has them; the other targets stay."""
    d = _t(spark, sf, "documents").where("lang is not null").select(
        F.col("lang").alias("crawl_target"), F.concat(_s("doc_id"), F.lit(".html")).alias("filename"), F.col("text").alias("body"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/documents/{uuid.uuid4().hex}"
    catalog.write_documents(d, folder)
    catalog.write_documents(d.where("crawl_target = 'en' and length(body) > 1000").withColumn("body", F.concat("body", F.lit("!"))), folder)
    now = spark.read.schema("filename string, body string, crawl_target string").parquet(folder)
    return now.select("crawl_target", "filename", F.length("body").alias("size"), F.md5("body").alias("body_md5"))


QUERIES = {f.__name__: f for f in (
    document_snapshot, landed_lists, issue_by_key, snapshot_tree, catalog_stream, upload_order, deep_closure, cursor_chain, offset_coverage, pattern_table, query_index, run_counts, url_class, link_lexer, title_decode)}
