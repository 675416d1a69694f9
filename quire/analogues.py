"""Driver queries: each operator of the inventory run on the test tables.

The test tables stand in for the landed wiki / issue / web snapshots
(which table plays which entity is noted per query). Each function takes
(spark, sf_dir) and returns a DataFrame; the equivalent DuckDB SQL for
the same rows lives in :mod:`quire.oracle` under the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import file_name, sanitize_filename
from quire.functions.urls import attachment_url, issue_url, wiki_page_url
from quire import feature_queries, job_queries
from quire.operators import issues as iss
from quire.operators import web, wiki
from quire.operators.dedupe import first_by, latest_by
from quire.operators.filters import any_match, literal_frame, none_match
from quire.operators.ordering import number_rows, ordered_concat
from quire.plans import catalog as cat
from quire.plans import publish as pub
from quire.plans.graph import bounded_crawl as _bounded_crawl
from quire.plans.graph import closure as _closure
from quire.plans.targets import dispatch, targets_frame
from quire.sources import landed
from quire.sources.tables import read_table

# Fixed values shared with the oracle SQL (analogue configuration).
BASE_URL = "https://corp.example.com"
BUCKET = "corpus-bucket"
TITLE_BAN = ["(?i).*nicht.*"]
LINK_ALLOW = r"^https?://"
LINK_BAN = [r"/the$", r"(?i)/AND$"]
URL_BAN = [r"spam-farm\.", r"(?i)cheap-PILLS"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


# ---------------------------------------------------------------- web (L3)

def url_identity(spark, sf):
    """Normalised URL and md5 id of every page."""
    return web.identify_pages(_t(spark, sf, "pages").select("page_id", "url")).select("page_id", "norm_url", "id")


def page_title(spark, sf):
    """Page titles; banned-title pages are left out."""
    p = web.with_titles(_t(spark, sf, "pages").select("page_id", "html"), banned_title_patterns=TITLE_BAN)
    return p.where(~F.col("title_banned")).select("page_id", "title")


def page_links(spark, sf):
    """Resolved anchor links per page, allow + ban filters."""
    return web.page_links(_t(spark, sf, "pages"), regex=LINK_ALLOW, banned_url_patterns=LINK_BAN)


def sanitize_filename_q(spark, sf):
    """Sanitised whole document texts and page titles."""
    docs = _t(spark, sf, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"),
                                             sanitize_filename("text").alias("name"))
    pages = web.with_titles(_t(spark, sf, "pages").select("page_id", "html"))
    titles = pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"),
                          sanitize_filename("title").alias("name"))
    return docs.unionByName(titles)


def truncate_filename_q(spark, sf):
    """File name from the whole text, cut to 255 characters,
    and the base name of its storage URI."""
    d = _t(spark, sf, "documents").select("doc_id", "text")
    fn = d.select("doc_id", file_name(F.col("text"), "html").alias("filename"))
    uri = F.concat(F.lit(f"gs://{BUCKET}/docs/"), F.col("filename"))
    return fn.select("doc_id", "filename", F.substring_index(uri, "/", -1).alias("base"))


def web_corpus(spark, sf):
    """Flagship (L3 without expansion): every landed page becomes one
    document: id, title, file name and storage URI."""
    p = web.with_titles(web.identify_pages(_t(spark, sf, "pages")), banned_title_patterns=TITLE_BAN)
    p = p.where(~F.col("title_banned"))
    fn = web.web_file_name(F.col("id"), F.col("title"))
    return p.select("page_id", "id", "title", fn.alias("filename"),
                    F.concat(F.lit(f"gs://{BUCKET}/web/"), fn).alias("uri"))


QUERIES = {
    "url_identity": url_identity,
    "page_title": page_title,
    "page_links": page_links,
    "sanitize_filename": sanitize_filename_q,
    "truncate_filename": truncate_filename_q,
}


# ---------------------------------------------------------------- wiki (L1)
# nation plays the wiki spaces, documents the pages (space = doc_id % 25)


TARGET_SPACE_KEYS = ["S3", "S7", "S11", "S4"]
MISSING_SPACE = 13
BANNED_ATTACHMENTS = ["^small ", "(?i)GEAR$"]
# analogue media types of part.p_type (three of them are allowed)
PART_MEDIA = [("ECONOMY", "application/pdf"),
              ("SMALL", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
              ("MEDIUM", "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
              ("PROMO", "image/png"), ("STANDARD", "text/plain"), ("LARGE", "application/zip")]


def _spaces(spark, sf):
    n = _t(spark, sf, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("id"),
                    F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("key"),
                    F.col("n_name").alias("name"),
                    F.when(F.col("n_regionkey") == 4, "personal").otherwise("global").alias("type"),
                    F.when(F.col("n_nationkey") % 6 == 5, "archived").otherwise("current").alias("status"))


def _wiki_pages(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select(F.col("doc_id"), F.col("doc_id").cast("string").alias("id"),
                    (F.col("doc_id") % 25).cast("string").alias("spaceId"),
                    F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("body"))


def web_url_canonical(spark, sf):
    """Page web URL rewrite, attachment and issue URLs."""
    d = _t(spark, sf, "documents").select("doc_id", "lang", "source")
    n = (F.col("doc_id") % 25).cast("string")
    sid = F.col("doc_id").cast("string")
    link = (F.when(F.col("doc_id") % 17 == 0, F.lit(None))
            .when(F.col("doc_id") % 5 == 0, F.concat(F.lit("/spaces/S"), n, F.lit("/overview")))
            .when(F.col("doc_id") % 3 == 0, F.concat(F.lit("/spaces/~S"), n, F.lit("/pages/"), sid, F.lit("/T")))
            .otherwise(F.concat(F.lit("/spaces/S"), n, F.lit("/pages/"), sid, F.lit("/"), F.col("lang"))))
    return d.select("doc_id", wiki_page_url(BASE_URL, link).alias("web_url"),
                    attachment_url(BASE_URL, F.concat(F.lit("/download/attachments/"), sid, F.lit("/"),
                                                      F.col("source"), F.lit(".pdf"))).alias("download_url"),
                    issue_url(BASE_URL, F.concat(F.lit("S"), n, F.lit("-"), sid)).alias("issue_url"))


def space_key_filter(spark, sf):
    """Pages of the listed spaces whose key is a target key."""
    keys = literal_frame(spark, [(k,) for k in TARGET_SPACE_KEYS], "key string")
    spaces = wiki.target_spaces(wiki.listed_spaces(_spaces(spark, sf)), keys)
    return wiki.pages_in_spaces(_wiki_pages(spark, sf), spaces).select("doc_id", F.col("space_key").alias("key"))


def page_space_join(spark, sf):
    """Every page with its space, or quarantined when its
    space is not listed (one nation is missing from the listing)."""
    spaces = wiki.listed_spaces(_spaces(spark, sf)).where(F.col("id") != str(MISSING_SPACE))
    pages = _wiki_pages(spark, sf)
    ok = wiki.pages_in_spaces(pages, spaces).select(
        "doc_id", "space_key", "space_name", F.lit("ok").alias("status"),
        F.md5(wiki.page_body(F.col("title"), F.col("body"))).alias("body_md5"))
    bad = wiki.pages_without_space(pages, spaces).select(
        "doc_id", F.lit(None).cast("string").alias("space_key"), F.lit(None).cast("string").alias("space_name"),
        F.lit("quarantine").alias("status"), F.md5(wiki.page_body(F.col("title"), F.col("body"))).alias("body_md5"))
    return ok.unionByName(bad)


def _part_name(k):
    return F.when(k % 10 == 0, F.concat(F.lit("part-"), k.cast("string"), F.lit(" & co.pdf"))).otherwise(
        F.concat(F.lit("part-"), k.cast("string"), F.lit(".pdf")))


def attachment_refs(spark, sf):
    """Orders are pages whose body references the parts of its
    even line numbers (escaped as in storage bodies); the order's parts
    are its attachments; referenced ones are kept."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    marker = F.concat(F.lit('<ri:attachment ri:filename="'),
                      F.replace(_part_name(F.col("l_partkey")), F.lit("&"), F.lit("&amp;")), F.lit('" />'))
    even = li.where(F.col("l_linenumber") % 2 == 0)
    bodies = ordered_concat(even, ["l_orderkey"], [("l_linenumber", True), ("l_partkey", True), ("l_suppkey", True)],
                            lambda n, g: marker, "\n", "body")
    pages = bodies.select(F.col("l_orderkey").alias("id"), "body")
    atts = li.select(F.col("l_orderkey").alias("pageId"), _part_name(F.col("l_partkey")).alias("title")).distinct()
    return wiki.referenced_attachments(atts, pages).select(F.col("pageId").alias("orderkey"),
                                                            F.col("title").alias("name"))


def _part_attachments(spark, sf):
    media = literal_frame(spark, PART_MEDIA, "p_type string, mediaType string")
    p = _t(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return p.join(media, "p_type").select("p_partkey", F.col("p_name").alias("title"), "mediaType")


def attachment_allowlist(spark, sf):
    """Allowed media types with their extension."""
    return wiki.allowed_attachments(_part_attachments(spark, sf)).select("p_partkey", "ext")


def attachment_banned(spark, sf):
    """Titles hit by any banned pattern (one case-insensitive) are dropped."""
    p = _t(spark, sf, "part").select("p_partkey", F.col("p_name").alias("title"))
    return p.where(none_match("title", BANNED_ATTACHMENTS)).select("p_partkey", F.col("title").alias("p_name"))


def attachment_sweep(spark, sf):
    """All allowed attachments (line items) of crawled pages
    (finished orders), no body test."""
    atts = _part_attachments(spark, sf).select("p_partkey", "mediaType")
    li = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pageId"), "l_partkey")
    la = li.join(atts, li["l_partkey"] == atts["p_partkey"]).select("pageId", "l_partkey", "mediaType",
                                                                    F.lit("x").alias("title"))
    pages = _t(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))
    return wiki.attachment_sweep(la, pages).select(F.col("pageId").alias("orderkey"),
                                                   F.col("l_partkey").alias("partkey"), "ext").distinct()


QUERIES.update({
    "web_url_canonical": web_url_canonical,
    "space_key_filter": space_key_filter,
    "page_space_join": page_space_join,
    "attachment_refs": attachment_refs,
    "attachment_allowlist": attachment_allowlist,
    "attachment_banned": attachment_banned,
    "attachment_sweep": attachment_sweep,
})


# ---------------------------------------------------------------- graphs


CLOSURE_SEEDS = [2, 7]
CLOSURE_EXCLUDES = [7, 9]
CRAWL_SEEDS = [0, 1]
CRAWL_DEPTH = 3


def _child_edges(spark, sf):
    p = _t(spark, sf, "pages").select(F.col("page_id").alias("i"))
    i = F.col("i")
    tree = p.where(i >= 1).select((i / 4).cast("long").alias("src"), i.alias("dst"))
    diamond = p.where((i % 6 == 0) & (i > 0)).select((i / 3).cast("long").alias("src"), i.alias("dst"))
    back = p.select(i.alias("src"), (i / 16).cast("long").alias("dst"))
    loops = p.where(i % 13 == 0).select(i.alias("src"), i.alias("dst"))
    return tree.unionByName(diamond).unionByName(back).unionByName(loops)


def child_page_closure(spark, sf):
    """All pages below the seed pages (child edges with
    diamonds, cycles and self-loops), excluded pages removed after the
    expansion so their descendants stay. Back edges leave pages of every
    depth, so the closure may return to the root."""
    seeds = literal_frame(spark, [(s,) for s in CLOSURE_SEEDS], "id long")
    excl = literal_frame(spark, [(s,) for s in CLOSURE_EXCLUDES], "id long")
    return _closure(_child_edges(spark, sf), seeds).join(excl, "id", "left_anti")


def bounded_crawl(spark, sf):
    """Pages saved by a depth-3 crawl from two seeds; pages
    with a banned URL are never visited, banned-title pages are visited
    but neither saved nor expanded. Links: i -> (7i+3) mod N, (5i+1) mod N."""
    pages = web.with_titles(web.identify_pages(_t(spark, sf, "pages").select("page_id", "url", "html")),
                            banned_title_patterns=TITLE_BAN)
    blocked = pages.where(any_match("norm_url", URL_BAN)).select(F.col("page_id").alias("id"))
    stoppers = pages.where(F.col("title_banned")).select(F.col("page_id").alias("id"))
    base = _t(spark, sf, "pages").select(F.col("page_id").alias("i"))
    n = base.select(F.count(F.lit(1))).scalar()
    edges = base.select(F.col("i").alias("src"), F.pmod(F.col("i") * 7 + 3, n).alias("dst")).unionByName(
        base.select(F.col("i").alias("src"), F.pmod(F.col("i") * 5 + 1, n).alias("dst")))
    seeds = literal_frame(spark, [(s,) for s in CRAWL_SEEDS], "id long")
    hit = _bounded_crawl(edges, seeds, CRAWL_DEPTH, blocked=blocked, stoppers=stoppers)
    return hit.join(stoppers, "id", "left_anti").select("id", "hop")


QUERIES.update({
    "child_page_closure": child_page_closure,
    "bounded_crawl": bounded_crawl,
})


# ---------------------------------------------------------------- issues (L2)
# orders play issues (key O-<orderkey>), customers epics (C-<custkey>),
# conversations comments, line items test steps.


FIELD_MAP = {"K": "k"}  # custom field display name -> key in the field map
DONE_PRIORITIES = ["1-URGENT", "2-HIGH"]
TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _key(prefix, c):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def custom_field_pick(spark, sf):
    """P5: a custom field picked from each record's field map by the
    name -> key map."""
    e = _t(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("custom"))
    return e.select("event_id", iss.pick_custom(F.col("custom"), FIELD_MAP["K"]).alias("k"))


ATTACH_PAGE = 16  # landed attachment lists come in pages of this size


def nested_attachments(spark, sf):
    """Landed nested attachment lists (conversation turns, in
    response pages of 16) reshaped and counted, then summed and listed per
    record in order."""
    c = _t(spark, sf, "conversations").select("conv_id", "turn", "role")
    landed = c.groupBy("conv_id", (F.col("turn") / ATTACH_PAGE).cast("long").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(
            "turn", F.col("role").alias("mimeType"),
            F.concat(F.lit("turn-"), F.col("turn").cast("string"), F.lit(".txt")).alias("filename"),
            F.lit(None).cast("string").alias("created"), F.lit(None).cast("string").alias("content")))).alias("att"))
    att = landed.select("conv_id", "page",
                        iss.attachment_list(F.transform("att", lambda a: a.dropFields("turn"))).alias("a"),
                        iss.count_or_zero(F.col("att")).alias("n"))
    names = att.select("conv_id", "page", "n", F.array_join(F.transform(
        "a", lambda x: F.concat(x["mimeType"], F.lit(":"), x["filename"])), ",").alias("names"))
    counts = names.groupBy("conv_id").agg(F.sum("n").alias("n"))
    listing = ordered_concat(names, ["conv_id"], [("page", True)], lambda n, g: g("names"), ",", "names")
    return counts.join(listing, "conv_id").select("conv_id", F.col("n").cast("long").alias("n"), "names")


def jql_done_stories(spark, sf):
    """Issues matching status / type / date predicates, ranked
    by update time descending (key as tie-break)."""
    o = _t(spark, sf, "orders").where(
        (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin(DONE_PRIORITIES)
        & (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))).select("o_orderkey", "o_orderdate")
    return number_rows(o, [], [("o_orderdate", False), ("o_orderkey", True)], "rank").select("o_orderkey", "rank")


def _issue_rows(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == n["n_nationkey"])
    k = F.col("o_orderkey")
    labels = (F.when(k % 7 == 0, F.lit(None).cast("array<string>"))
              .when(k % 3 == 0, F.array().cast("array<string>"))
              .when(k % 3 == 1, F.array("c_mktsegment"))
              .otherwise(F.array("c_mktsegment", "o_orderstatus")))
    desc = (F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 9 == 0, F.lit(""))
            .otherwise(F.concat(F.lit("Order of "), F.col("c_name"), F.lit(" in "), F.col("n_name"),
                                F.lit(" ("), F.col("o_orderstatus"), F.lit(")"))))
    return j.select(
        "o_orderkey", _key("O-", "o_orderkey").alias("key"), F.col("o_orderpriority").alias("issue_type"),
        F.col("c_name").alias("title"), F.col("n_name").alias("project"), labels.alias("labels"),
        F.date_format("o_orderdate", TS_FMT).alias("created"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T12:00:00")).alias("updated"),
        F.when(F.col("o_custkey") % 2 == 0, _key("C-", "o_custkey")).otherwise(F.lit("")).alias("epic"),
        ((k % 7) / 2.0).alias("points"), desc.alias("description"))


def issue_document(spark, sf):
    """One rendered document per issue."""
    r = _issue_rows(spark, sf)
    body = iss.issue_body(F.col("key"), F.col("issue_type"), F.col("title"), F.col("project"), F.col("labels"),
                          F.col("created"), F.col("updated"),
                          [("Epic", F.col("epic"), False), ("Story Points", F.col("points"), True)],
                          F.col("description"))
    return r.select("o_orderkey", iss.issue_title(F.col("key"), F.col("title")).alias("title"),
                    issue_url(BASE_URL, F.col("key")).alias("url"), body.alias("body"))


def issue_comments_block(spark, sf):
    """Documents are the issues, conversation turns their
    comments; issues without comments get an empty block."""
    issues = _t(spark, sf, "documents").select(F.col("doc_id").alias("issue_id"))
    c = _t(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("role").alias("author"), F.col("text").alias("body"),
        F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("updated"))
    blocks = iss.comments_block(c, "conv_id", [("turn", True)], "author", "updated", "body", "block")
    return iss.attach_blocks(issues, "issue_id", (blocks, "block")).select("issue_id", "block")


_STEP_ORDER = [("l_linenumber", True), ("l_partkey", True), ("l_suppkey", True), ("l_quantity", True),
               ("l_extendedprice", True), ("l_discount", True), ("l_tax", True), ("l_returnflag", True),
               ("l_linestatus", True), ("l_shipdate", True)]


def issue_steps_block(spark, sf):
    """Line items are test steps (orderId = line number,
    not unique: ties ordered by the remaining columns); some parts are
    missing and leave empty elements."""
    orders = _t(spark, sf, "orders").select("o_orderkey")
    li = _t(spark, sf, "lineitem")
    steps = li.select(
        "l_orderkey", *[c for c, _ in _STEP_ORDER],
        F.concat(F.lit("Ship part "), F.col("l_partkey").cast("string"), F.lit(" from "),
                 F.col("l_suppkey").cast("string")).alias("step"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("qty "), F.col("l_quantity").cast("long").cast("string"))).alias("data"),
        F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(
            F.concat(F.lit("status "), F.col("l_linestatus"))).alias("result"))
    blocks = iss.steps_block(steps, "l_orderkey", _STEP_ORDER, "step", "data", "result", "block")
    return iss.attach_blocks(orders, "o_orderkey", (blocks, "block")).select("o_orderkey", "block")


def epic_summary(spark, sf):
    """Customers are epics, their finished orders the
    done stories, newest first; epics without stories are dropped."""
    epics = _t(spark, sf, "customer").select("c_custkey", _key("C-", "c_custkey").alias("epic_key"), "c_name")
    stories = _t(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        _key("C-", "o_custkey").alias("epic_link"), _key("O-", "o_orderkey").alias("story_key"),
        F.col("o_orderpriority").alias("story_title"), F.date_format("o_orderdate", TS_FMT).alias("updated"),
        "o_orderdate", "o_orderkey")
    s = iss.epic_summaries(epics, stories, "epic_key", "c_name", "epic_link", "story_key", "story_title",
                           "updated", [("o_orderdate", False), ("o_orderkey", True)])
    return s.select("c_custkey", iss.epic_title(F.col("epic_key"), F.col("c_name")).alias("title"), "body")


def epic_summary_hot_keys(spark, sf):
    """A3 J5 under skew: the three order statuses are the epics and every
    order is a story, so each epic holds about a third of all rows. The
    documents come as ordered parts of at most 64 KiB and one line."""
    epics = _t(spark, sf, "orders").select("o_orderstatus").distinct().select(
        F.concat(F.lit("ST-"), F.col("o_orderstatus")).alias("epic_key"), F.col("o_orderstatus").alias("status"))
    stories = _t(spark, sf, "orders").select(
        F.concat(F.lit("ST-"), F.col("o_orderstatus")).alias("epic_link"), _key("O-", "o_orderkey").alias("story_key"),
        F.col("o_orderpriority").alias("story_title"), F.date_format("o_orderdate", TS_FMT).alias("updated"),
        "o_orderdate", "o_orderkey")
    parts = iss.epic_summary_parts(epics, stories, "epic_key", "status", "epic_link", "story_key", "story_title",
                                   "updated", [("o_orderdate", False), ("o_orderkey", True)], part_bytes=1 << 16)
    return parts.select(F.expr("substring(epic_key, 4)").alias("status"), "part", "text")


QUERIES.update({
    "epic_summary_hot_keys": epic_summary_hot_keys,
    "custom_field_pick": custom_field_pick,
    "nested_attachments": nested_attachments,
    "jql_done_stories": jql_done_stories,
    "issue_document": issue_document,
    "issue_comments_block": issue_comments_block,
    "issue_steps_block": issue_steps_block,
    "epic_summary": epic_summary,
})


# ---------------------------------------------------------------- catalog


TARGET = "docs"
TARGETS = {
    "web-a": {"uploadDestination": "store", "sources": [{"source": "web", "type": "url", "items": ["seed"]}]},
    "web-b": {"uploadDestination": "store", "sources": [{"source": "web", "type": "url", "items": ["seed"]}]},
    "wiki": {"uploadDestination": "store", "sources": [{"source": "confluence", "type": "pages", "items": ["1"]}]},
    "issues": {"uploadDestination": "dataset", "sources": [{"source": "jira", "type": "query", "items": ["q"]}]},
    "other": {"uploadDestination": "none", "sources": [{"source": "unknown", "type": "x", "items": ["y"]}]},
}


def _doc_metadata(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    fname = wiki.page_file_name(F.col("source"), F.col("doc_id").cast("string"))
    created = F.concat(F.lit("2024-01-"), F.lpad(((F.col("doc_id") % 28) + 1).cast("string"), 2, "0"),
                       F.lit("T00:00:00.000Z"))
    rec = cat.metadata_record(F.col("doc_id"), F.col("text"),
                              wiki_page_url(BASE_URL, F.concat(F.lit("/spaces/"), F.col("source"), F.lit("/pages/"),
                                                               F.col("doc_id").cast("string"), F.lit("/x"))),
                              created, F.lit("text/html"), cat.storage_uri(BUCKET, TARGET, fname),
                              space_name=F.col("lang"))
    return d.select("doc_id", "text", fname.alias("filename"), rec.alias("metadata"))


def metadata_records(spark, sf):
    """The NDJSON metadata line of every document."""
    return _doc_metadata(spark, sf).select("doc_id", cat.metadata_line(F.col("metadata")).alias("json"))


def target_union(spark, sf):
    """Source jobs dispatched to the crawl targets that name
    them (two targets share the web source, one source is unknown), then
    counted per target, source and media type."""
    tg = targets_frame(spark, TARGETS)
    pages = _t(spark, sf, "pages").select(F.lit("text/html").alias("mime"))
    docs = _t(spark, sf, "documents").select(F.lit("text/html").alias("mime"))
    atts = wiki.allowed_attachments(_part_attachments(spark, sf)).select(F.col("mediaType").alias("mime"))
    orders = _t(spark, sf, "orders").select(F.lit("text/html").alias("mime"))
    rows = dispatch(tg, {("web", "url"): pages, ("confluence", "pages"): docs.unionByName(atts),
                         ("jira", "query"): orders})
    return cat.run_counts(rows, ["crawl_target", "source", "mime"])


def catalog_upsert(spark, sf):
    """A4 P20 K3: latest record per key (user) by (ts, event_id)."""
    e = _t(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return latest_by(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


def document_overwrite(spark, sf):
    """A5: last write wins per (user, event type)."""
    e = _t(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return latest_by(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


def attachment_first_wins(spark, sf):
    """First write wins per (user, event type)."""
    e = _t(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return first_by(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


# ---------------------------------------------------------------- landed pages

PAGE_SIZE = 50


def offset_page_audit(spark, sf):
    """Orders of each status landed as search pages of 50 (every
    11th page missing); the audit reports pages, rows, total and gaps."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    ranked = number_rows(o, ["o_orderstatus"], [("o_orderkey", True)], "rn")
    paged = ranked.withColumn("page", ((F.col("rn") - 1) / PAGE_SIZE).cast("long"))
    totals = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("total"))
    resp = paged.where(F.col("page") % 11 != 10).groupBy("o_orderstatus", "page").agg(
        F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("id"))).alias("issues"))
    resp = resp.join(totals, "o_orderstatus").select(
        F.concat(F.lit("status="), F.col("o_orderstatus")).alias("request"),
        (F.col("page") * PAGE_SIZE).alias("startAt"), F.lit(PAGE_SIZE).cast("long").alias("maxResults"),
        F.col("total"), "issues")
    return landed.offset_audit(resp).select("request", "pages", "rows", "total", "has_gap")


CURSOR_PAGE = 100


def _event_pages(spark, sf):
    e = _t(spark, sf, "events").select("event_id")
    last = e.select(F.max((F.col("event_id") / CURSOR_PAGE).cast("long"))).scalar()
    return e, last


def cursor_page_audit(spark, sf):
    """S3: events landed as cursor pages of 100 with next links, every 7th
    page missing; dangling next links are reported."""
    e, last = _event_pages(spark, sf)
    p = e.withColumn("p", (F.col("event_id") / CURSOR_PAGE).cast("long"))
    resp = p.where(F.col("p") % 7 != 3).groupBy("p").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("/events?page="), F.col("p").cast("string")).alias("request_path"),
        F.when(F.col("p") < last, F.concat(F.lit("/events?page="), (F.col("p") + 1).cast("string"))).alias("next_link"))
    return landed.cursor_audit(resp)


def purge_id_list(spark, sf):
    """Document listings in numbered pages that overlap by 10 ids
    (has_more on all but the last), followed to their last page; each id
    once."""
    e, last = _event_pages(spark, sf)
    own = e.select("event_id", (F.col("event_id") / CURSOR_PAGE).cast("long").alias("page"))
    dup = own.where((F.col("event_id") % CURSOR_PAGE < 10) & (F.col("page") > 0)).select(
        "event_id", (F.col("page") - 1).alias("page"))
    resp = own.unionByName(dup).groupBy("page").agg(
        F.collect_list(F.struct(F.col("event_id").alias("id"))).alias("data")).withColumn(
        "has_more", F.col("page") < last)
    return landed.distinct_ids(landed.listing_pages(resp))


# ---------------------------------------------------------------- publish

def snapshot_diff(spark, sf):
    """K5 K4: catalog of the previous run vs this run (documents; prev
    misses doc_id % 5 = 0, new misses doc_id % 7 = 0, text edited when
    doc_id % 11 = 0): insert / update / delete / same per document."""
    d = _t(spark, sf, "documents").select("doc_id", "text")
    prev = d.where(F.col("doc_id") % 5 != 0)
    new = d.where(F.col("doc_id") % 7 != 0).withColumn(
        "text", F.when(F.col("doc_id") % 11 == 0, F.concat(F.col("text"), F.lit(" (edited)"))).otherwise(F.col("text")))
    return pub.snapshot_diff(prev, new, ["doc_id"], ["text"])


def upload_manifest(spark, sf):
    """Metadata records of targets with a store, matched to
    the written bodies by file name (every 13th body missing)."""
    m = _doc_metadata(spark, sf).select(
        "doc_id", F.concat(F.lit("wiki-"), (F.col("doc_id") % 3).cast("string")).alias("crawl_target"),
        F.col("metadata.content.uri").alias("uri"))
    bodies = _doc_metadata(spark, sf).where(F.col("doc_id") % 13 != 0).select(
        F.concat(F.lit("wiki-"), (F.col("doc_id") % 3).cast("string")).alias("crawl_target"), "filename")
    stores = literal_frame(spark, [("wiki-0", "store-0"), ("wiki-1", "store-1")], "target string, store_id string")
    man = pub.upload_manifest(pub.with_store(m, stores), bodies)
    return man.select("doc_id", "filename", "status")


QUERIES.update({
    "metadata_records": metadata_records,
    "target_union": target_union,
    "catalog_upsert": catalog_upsert,
    "document_overwrite": document_overwrite,
    "attachment_first_wins": attachment_first_wins,
    "offset_page_audit": offset_page_audit,
    "cursor_page_audit": cursor_page_audit,
    "purge_id_list": purge_id_list,
    "snapshot_diff": snapshot_diff,
    "upload_manifest": upload_manifest,
})

# the batched jobs of real runs, and the operators for deep, long and large inputs
QUERIES.update(job_queries.QUERIES)
QUERIES.update(feature_queries.QUERIES)
