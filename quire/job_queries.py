"""Driver queries over the batched jobs: the test tables are brought into
the shape of landed snapshots and handed to the code that real runs call
(issue queries, epic summaries, wiki crawls, all targets of a run)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans import corpus
from quire.plans.catalog import METADATA_SCHEMA, build_catalog, flatten, metadata_line
from quire.sources.tables import read_table as _t

BASE_URL = "https://corp.example.com"
BUCKET = "corpus-bucket"
COMMENT_PAGE = 16        # comments of a landed response
TS = "yyyy-MM-dd'T'HH:mm:ss"

ISSUE_QUERIES = [
    {"target": "team-a", "where": "project_key = 'P1' AND status = 'Done'", "include_comments": True, "include_steps": True},
    {"target": "team-b", "where": "sprint_open AND array_contains(fix_versions, 'v1') AND title LIKE '%URGENT%'"},
    {"target": "team-b", "where": "epic_link = 'C-7' OR key IN ('O-1', 'O-2', 'C-5')", "include_comments": True},
]
EPIC_PROJECTS = [{"target": "team-a", "project": "P0"}, {"target": "team-a", "project": "P1"},
                 {"target": "team-b", "project": "P1"}]
WIKI_CRAWLS = [
    {"target": "team-a", "type": "spaces", "items": ["S3", "S7"]},
    {"target": "team-b", "type": "spaces", "items": []},
    {"target": "team-b", "type": "pages", "items": ["2"], "include_child_pages": True, "exclude_pages": ["9"]},
    {"target": "team-c", "type": "all", "banned_attachment_patterns": ["(?i)^PART-1"]},
]


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def _issue(id_, key, kind, summary, project, status, created, updated, sprint, epic, versions, custom, description):
    """One landed issue as columns (schemas.ISSUE)."""
    null = F.lit(None)
    return [
        id_.alias("id"), key.alias("key"),
        F.struct(
            F.struct(kind.alias("name")).alias("issuetype"),
            F.struct(project.alias("id"), F.concat(F.lit("Project "), project).alias("name"), project.alias("key")).alias("project"),
            null.cast("array<string>").alias("labels"), summary.alias("summary"), created.alias("created"),
            updated.alias("updated"),
            null.cast("array<struct<mimeType:string,filename:string,created:string,content:string>>").alias("attachment"),
            F.struct(null.cast("array<struct<id:string>>").alias("comments")).alias("comment"),
            F.struct(status.alias("name")).alias("status"), sprint.alias("sprint_open"), epic.alias("epic_link"),
            versions.alias("fix_versions")).alias("fields"),
        custom.alias("custom"), F.struct(description.alias("description")).alias("renderedFields")]


def landed_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as epics, orders as their stories; every sixth story lies
    in another project than its epic."""
    text = F.lit(None).cast("string")
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    day = F.lit("2024-01-01T00:00:00")
    epics = c.select(*_issue(
        _s("c_custkey"), F.concat(F.lit("C-"), _s("c_custkey")), F.lit("Epic"), F.col("c_name"),
        F.concat(F.lit("P"), (F.col("c_custkey") % 5).cast("string")), F.lit("Open"), day, day, F.lit(False), text,
        F.array().cast("array<string>"), F.lit(None).cast("map<string,string>"), text))
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    away = F.when(k % 6 == 0, 1).otherwise(0)
    link = F.concat(F.lit("C-"), _s("o_custkey"))
    points = F.element_at(F.array(*[F.lit(x) for x in (None, "0", "0.0", "12000000", "2.5", "x", "3")]), (k % 7 + 1).cast("int"))
    stories = o.select(*_issue(
        k.cast("string"), F.concat(F.lit("O-"), k.cast("string")), F.lit("Story"),
        F.concat(F.col("o_orderpriority"), F.lit(" order")),
        F.concat(F.lit("P"), ((F.col("o_custkey") + away) % 5).cast("string")),
        F.when(F.col("o_orderstatus") == "F", "Done").otherwise("Open"), F.date_format("o_orderdate", TS),
        F.date_format("o_orderdate", TS), k % 4 == 0, link, F.array(F.concat(F.lit("v"), (k % 3).cast("string"))),
        F.create_map(F.lit("customfield_10014"), F.when(k % 5 == 0, F.lit("0")).otherwise(link),
                     F.lit("customfield_10036"), points),
        F.when(k % 4 == 0, text).when(k % 9 == 0, "").when(k % 10 == 1, "0").otherwise(
            F.concat(F.lit("Order "), k.cast("string")))))
    return epics.unionByName(stories)


def landed_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as comment responses of at most 16 comments."""
    c = _t(spark, sf, "conversations")
    made = F.concat(F.lit("turn "), _s("turn"))
    one = F.struct("turn", F.struct(F.col("role").alias("displayName")).alias("author"), F.col("text").alias("renderedBody"),
                   made.alias("created"), made.alias("updated"))
    pages = c.groupBy("conv_id", (F.col("turn") / COMMENT_PAGE).cast("long").alias("p")).agg(
        F.array_sort(F.collect_list(one)).alias("l"))
    # where a turn is missing, later pages start earlier than p * 16, but their order is the same
    return pages.select(F.concat(F.lit("O-"), _s("conv_id")).alias("issue_key"),
                        (F.col("p") * COMMENT_PAGE).alias("startAt"),
                        F.transform("l", lambda x: x.dropFields("turn")).alias("comments"))


def landed_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as the test steps of their order, one response an order."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    data = F.when(F.col("l_returnflag") != "R", F.concat(F.lit("qty "), F.col("l_quantity").cast("long").cast("string")))
    one = F.struct(F.col("l_linenumber").cast("long").alias("orderId"),
                   F.concat(F.lit("Ship part "), _s("l_partkey"), F.lit(" from "), _s("l_suppkey")).alias("step"),
                   data.alias("data"), F.lit("").alias("result"))
    return li.groupBy(F.concat(F.lit("O-"), _s("l_orderkey")).alias("issue_key")).agg(
        F.array_sort(F.collect_list(one)).alias("testSteps"))


def landed_wiki(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Nations as spaces, documents as their pages (whole texts; pages of
    even id refer to the part of their number), parts as attachments."""
    n = _t(spark, sf, "nation")
    spaces = n.select(_s("n_nationkey").alias("id"), F.concat(F.lit("S"), _s("n_nationkey")).alias("key"),
                      F.col("n_name").alias("name"), F.lit(None).cast("string").alias("homepageId"),
                      F.when(F.col("n_regionkey") == 4, "personal").otherwise("global").alias("type"),
                      F.when(F.col("n_nationkey") % 6 == 5, "archived").otherwise("current").alias("status"))
    d = _t(spark, sf, "documents").select("doc_id", "text", "lang")
    i = F.col("doc_id")
    space = (i % 25).cast("string")
    ref = F.when(i % 2 == 0, F.concat(F.lit('<ri:attachment ri:filename="part-'), i.cast("string"), F.lit('.pdf" />')))
    body = F.concat(F.coalesce(F.col("text"), F.lit("")), F.coalesce(ref, F.lit("")))
    pages = d.select(
        i.cast("string").alias("id"), F.col("lang").alias("title"), space.alias("spaceId"),
        F.when(i % 19 == 0, "trashed").otherwise("current").alias("status"),
        F.struct(F.struct(body.alias("value")).alias("storage")).alias("body"),
        F.struct(F.lit("2024-02-02").alias("createdAt")).alias("version"),
        F.struct(F.concat(F.lit("/spaces/S"), space, F.lit("/pages/"), i.cast("string"), F.lit("/x")).alias("webui")).alias("_links"))
    children = d.where(i > 0).select((i / 4).cast("long").cast("string").alias("parent_id"), i.cast("string").alias("id"))
    k = _s("p_partkey")
    atts = _t(spark, sf, "part").select(
        F.concat(F.lit("a"), k).alias("id"), F.concat(F.lit("part-"), k, F.lit(".pdf")).alias("title"),
        F.when(F.col("p_partkey") % 3 == 0, "image/png").otherwise("application/pdf").alias("mediaType"), k.alias("pageId"),
        F.concat(F.lit("f"), k).alias("fileId"), F.concat(F.lit("/pages/"), k).alias("webuiLink"),
        F.concat(F.lit("/download/"), k).alias("downloadLink"), F.struct(F.lit("2024-03-03").alias("createdAt")).alias("version"),
        F.when(F.col("p_partkey") % 14 == 0, "trashed").otherwise("current").alias("status"))
    return {"spaces": spaces, "pages": pages, "page_children": children, "attachments": atts}


WEB = "https://w.example.com/p/"
WEB_CRAWLS = [
    {"target": "team-a", "seeds": [WEB + "0", WEB + "2", WEB + "./5?x=1"], "include_links": True, "depth": 4,
     "regex": r"^https://w\.example\.com/p/", "banned_url_patterns": [r"/p/\d*9$"],
     "banned_title_patterns": ["(?i)nicht"]},
    {"target": "team-b", "seeds": [WEB + "0", WEB + "7", WEB + "x"], "depth": 1},
    {"target": "team-c", "seeds": [WEB + "1"], "include_links": True, "depth": 3, "regex": r"^https://w\.example\.com/p/"},
]


def landed_web(spark: SparkSession, sf: str) -> DataFrame:
    """Pages (whole HTML) under short URLs, each with links to three more
    pages; every fifth is landed a second time, older and with other HTML,
    every seventh twice in the same row and once under a URL with a
    fragment."""
    p = _t(spark, sf, "pages").select("page_id", "html")
    i = F.col("page_id")

    def link(before: str, n: int, after: str = ""):
        return F.concat(F.lit(f"<a href='{before}"), (i * 4 + n).cast("string"), F.lit(f"{after}'>x</a>"))
    html = F.concat("html", link("../a/./../p/", 1), link("/p/", 2, "?q=/a/../b"), link("HTTPS://W.example.com:443/p/", 3))
    now = p.select("page_id", F.concat(F.lit(WEB), i.cast("string")).alias("url"), html.alias("html"),
                   F.lit("2024-05-05").alias("fetched_at"))
    old = now.where(i % 5 == 0).withColumn("html", F.lit("<title>old</title>")).withColumn("fetched_at", F.lit("2023-01-01"))
    twice = now.where(i % 7 == 0)
    return now.unionByName(old).unionByName(twice).unionByName(
        twice.withColumn("url", F.concat("url", F.lit("#z")))).select("url", "html", "fetched_at")


def _result(c: corpus.Corpus) -> DataFrame:
    """Documents (md5 of the whole body) and metadata records of a run."""
    docs = c.documents.select(F.lit("document").alias("kind"), "crawl_target", "run_ord", "filename", F.md5("body").alias("value"))
    m = c.metadata.select("crawl_target", "run_ord", "filename", "metadata.*")
    value = F.concat_ws("|", "id", "structData.title", "structData.webUrl", "structData.createdAt", "content.uri")
    return docs.unionByName(m.select(F.lit("record").alias("kind"), "crawl_target", "run_ord", "filename", value.alias("value")))


def issue_job(spark, sf):
    """Three issue queries of two targets
    (status, sprint, fix version, summary, epic link and keys) in one scan."""
    return _result(corpus.issue_queries(
        landed_issues(spark, sf), ISSUE_QUERIES, comments=landed_comments(spark, sf), steps=landed_steps(spark, sf),
        base_url=BASE_URL, bucket=BUCKET))


def epic_job(spark, sf):
    """Summaries for projects that two targets name, as
    ordered parts of at most 200 bytes and one line; done stories of
    another project than their epic's do not count."""
    c = corpus.epic_parts_for(landed_issues(spark, sf), EPIC_PROJECTS, base_url=BASE_URL, bucket=BUCKET, part_bytes=200)
    none = F.lit(None).cast("int")
    records = _result(corpus.Corpus(c.documents, c.metadata, {})).where("kind = 'record'").withColumn("part", none)
    return records.unionByName(c.documents.select(
        F.lit("document").alias("kind"), "crawl_target", "run_ord", "filename", F.col("body").alias("value"), "part"))


def wiki_job(spark, sf):
    """Crawls of spaces (one without any
    key), of a page with its descendants, and of all spaces."""
    return _result(corpus.wiki_crawls(
        *(landed_wiki(spark, sf)[x] for x in ("spaces", "pages", "attachments")), WIKI_CRAWLS,
        children=landed_wiki(spark, sf)["page_children"], base_url=BASE_URL, bucket=BUCKET))


def web_job(spark, sf):
    """Three crawls of landed pages with
    repeated copies; links that no crawl may follow, banned URLs and
    titles, and pages that were not landed."""
    c = corpus.web_crawls(landed_web(spark, sf), WEB_CRAWLS, bucket=BUCKET)
    m = c.metadata.select("crawl_target", "metadata.*")
    return (c.documents.select(F.lit("document").alias("kind"), "crawl_target", F.md5("body").alias("value"))
            .unionByName(m.select(F.lit("record").alias("kind"), "crawl_target", F.concat_ws(
                "|", "id", "structData.title", "structData.webUrl", "structData.createdAt").alias("value")))
            .unionByName(c.extra["missing"].select(F.lit("missing").alias("kind"), "crawl_target", F.concat_ws(
                "|", "id", "url", _s("hop")).alias("value"))))


RUN = {
    "team-a": {"uploadDestination": "gcp", "sources": [
        {"source": "jira", "type": "query", "items": [ISSUE_QUERIES[0]["where"]],
         "options": {"includeComments": True, "includeZephyrTestSteps": True}},
        {"source": "jira", "type": "epic-issue-summary", "items": ["P0", "P1"]},
        {"source": "confluence", "type": "spaces", "items": ["S3", "S7"]}]},
    "team-b": {"uploadDestination": "dify", "sources": [
        {"source": "jira", "type": "query", "items": [ISSUE_QUERIES[1]["where"]]},
        {"source": "jira", "type": "query", "items": [ISSUE_QUERIES[2]["where"]], "options": {"includeComments": True}},
        {"source": "jira", "type": "epic-issue-summary", "items": ["P1"]},
        {"source": "confluence", "type": "pages", "items": ["2"],
         "options": {"includeChildPages": True, "excludePages": ["9"]}}]},
}


def _run(spark, sf, config):
    tables = {**landed_wiki(spark, sf), "issues": landed_issues(spark, sf), "comments": landed_comments(spark, sf),
              "test_steps": landed_steps(spark, sf)}
    return _result(corpus.run_targets(spark, config, tables, base_url=BASE_URL, bucket=BUCKET))


def targets_job(spark, sf):
    """Every source of two targets in one run; both name the
    issue tracker, an epic project and the wiki."""
    return _run(spark, sf, RUN)


def catalog_job(spark, sf):
    """K1 K3 P20 A4: the metadata records of a run as NDJSON lines, parsed
    with the declared schema, flattened, the latest record of each file."""
    c = corpus.issue_queries(landed_issues(spark, sf), ISSUE_QUERIES, base_url=BASE_URL, bucket=BUCKET)
    log = c.metadata.select("crawl_target", "run_ord", metadata_line(F.col("metadata")).alias("line"))
    records = log.select("crawl_target", "run_ord", F.from_json("line", METADATA_SCHEMA).alias("metadata"))
    return build_catalog(flatten(records, "metadata"), ["run_ord"]).select(
        "crawl_target", "filename", "run_ord", "id", "title", F.col("webUrl").alias("web_url"), "uri")


QUERIES = {f.__name__: f for f in (issue_job, epic_job, wiki_job, web_job, targets_job, catalog_job)}
