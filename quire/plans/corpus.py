"""End-to-end corpus jobs (L1-L4): landed snapshots -> one document and
one metadata record per item, per crawl target.

Each job returns a :class:`Corpus` of DataFrames; no rows reach the
driver. Eager steps are limited to a bounded row count (the checked
broadcast of the space listing), the narrow page-facts checkpoint of the
web job and the per-hop counts of the graph loops. ``run_targets`` walks
the crawl-target configuration (a few rows on the driver) and unions the
jobs per target (S18, U1).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.urls import attachment_url, issue_url, normalize_url, wiki_page_url
from quire.operators import issues as iss
from quire.operators import web, wiki
from quire.operators.dedupe import latest_by
from quire.operators.filters import allow_match, any_match, checked_broadcast, js_regex, literal_frame, none_match
from quire.operators.ordering import PART_BYTES
from quire.plans.catalog import metadata_record, storage_uri
from quire.plans.graph import grouped_frontier_search, materialize
from quire.session import ensure_checkpoint_dir

HTML = "text/html"


@dataclass
class Corpus:
    documents: DataFrame          # crawl_target, filename, mime_type, body
    metadata: DataFrame           # crawl_target, filename, metadata (struct)
    extra: dict[str, DataFrame]   # downloads, quarantine, missing pages ...


def _out(docs: DataFrame, target: str) -> DataFrame:
    return docs.select(F.lit(target).alias("crawl_target"), "filename", "mime_type", "body")


def _meta(df: DataFrame, target: str, record: Column) -> DataFrame:
    return df.select(F.lit(target).alias("crawl_target"), "filename", record.alias("metadata"))


# ------------------------------------------------------------------ wiki (L1)

def wiki_pages_view(pages: DataFrame) -> DataFrame:
    """Flatten landed page items (S7/S8 projection)."""
    return pages.select("id", "title", "spaceId", "status", F.col("body.storage.value").alias("body"),
                        F.col("_links.webui").alias("link"), F.col("version.createdAt").alias("createdAt"))


def wiki_attachments_view(atts: DataFrame, base_url: str) -> DataFrame:
    """S10 projection with P2 URLs (the page's attachment listing holds
    current attachments only)."""
    if "status" in atts.columns:
        atts = atts.where(F.col("status") == "current")
    return atts.select("id", "title", "mediaType", "pageId", "fileId",
                       attachment_url(base_url, F.col("webuiLink")).alias("webUrl"),
                       attachment_url(base_url, F.col("downloadLink")).alias("downloadUrl"),
                       F.col("version.createdAt").alias("createdAt"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def wiki_crawls(spaces: DataFrame, pages: DataFrame, attachments: DataFrame, specs: Sequence[Mapping], *,
                children: DataFrame | None = None, base_url: str, bucket: str, referenced_only: bool = True,
                decode_refs: bool = False) -> Corpus:
    """L1 for many wiki crawls at once (e.g. every wiki source of every target).

    Each spec has ``target``, ``type`` (``all``: every listed space;
    ``spaces``: space keys in ``items``; ``pages``: page ids in ``items``,
    with all descendants when ``include_child_pages``, ``exclude_pages``
    removed after the expansion), optionally ``banned_attachment_patterns``
    and ``ord`` (precedence). The selections are small tagged joins, the
    child-page closures run as one grouped search over the shared edge
    table, and the attachment references are extracted once per distinct
    selected page body. Documents carry ``run_ord``."""
    spark = pages.sparkSession
    # the space listing is broadcast only when its counted size is small
    listed = checked_broadcast(wiki.listed_spaces(spaces))
    pv = wiki_pages_view(pages)
    listing = pv.where(F.col("status") == "current")  # S7 lists current pages; S8 (by id) does not filter
    sels: list[DataFrame] = []
    extra: dict[str, DataFrame] = {}
    kinds = {sp["type"] for sp in specs}
    if kinds - {"all", "spaces", "pages"}:
        raise ValueError(f"unknown wiki crawl type(s) {sorted(kinds - {'all', 'spaces', 'pages'})}")
    g_all = [k for k, sp in enumerate(specs) if sp["type"] == "all"]
    if g_all:  # every "all" crawl gets every listed page (fan-out by a literal list, no join)
        sels.append(wiki.pages_in_spaces(listing, listed).withColumn("g", F.explode(F.array(*[F.lit(k) for k in g_all]))))
    space_keys = [(k, str(key)) for k, sp in enumerate(specs) if sp["type"] == "spaces" for key in sp.get("items", ())]
    if space_keys:
        wanted = listed.join(literal_frame(spark, space_keys, "g int, key string"), "key")
        sels.append(wiki.pages_in_spaces(listing, wanted.drop("g").dropDuplicates(["id"])).join(
            wanted.select(F.col("id").alias("spaceId"), "g"), "spaceId"))
    page_specs = [(k, sp) for k, sp in enumerate(specs) if sp["type"] == "pages"]
    if page_specs:
        ids = literal_frame(spark, [(k, str(i)) for k, sp in page_specs for i in sp.get("items", ())], "g int, id string")
        if children is not None and any(sp.get("include_child_pages") for _, sp in page_specs):
            bounds = literal_frame(spark, [(k, None if sp.get("include_child_pages") else 0) for k, sp in page_specs],
                                   "g int, max_hop int")
            edges = children.select(F.col("parent_id").alias("src"), F.col("id").alias("dst"))
            ids = grouped_frontier_search(edges, ids, bounds, group="g").select("g", "id")
        excl = [(k, str(x)) for k, sp in page_specs for x in sp.get("exclude_pages", ())]
        if excl:
            ids = ids.join(literal_frame(spark, excl, "g int, id string"), ["g", "id"], "left_anti")
        chosen = pv.join(ids, "id")
        sels.append(wiki.pages_in_spaces(chosen, listed))
        extra["quarantine"] = wiki.pages_without_space(chosen, listed)
    conf = literal_frame(spark, [(k, sp["target"], int(sp.get("ord", k))) for k, sp in enumerate(specs)],
                         "g int, crawl_target string, run_ord int")
    if not sels:  # no crawl names a space or a page
        sels.append(wiki.pages_in_spaces(listing, listed).withColumn("g", F.lit(0)).where(F.lit(False)))
    sel = _union(sels).join(conf, "g")
    if "quarantine" in extra:
        extra["quarantine"] = extra["quarantine"].join(conf, "g").drop("g", "run_ord")

    fname = wiki.page_file_name(F.col("space_key"), F.col("id"), "html")
    docs = sel.select("crawl_target", "run_ord", fname.alias("filename"), F.lit(HTML).alias("mime_type"),
                      wiki.page_body(F.col("title"), F.col("body")).alias("body"), "id", "title", "space_name",
                      "link", "createdAt")
    rec = metadata_record(F.col("id"), F.col("title"), wiki_page_url(base_url, F.col("link")), F.col("createdAt"),
                          F.lit(HTML), storage_uri(bucket, F.col("crawl_target"), F.col("filename")),
                          space_name=F.col("space_name"))
    page_meta = docs.select("crawl_target", "filename", rec.alias("metadata"), "run_ord")

    # attachments: references extracted once per selected page body, then fanned out to the crawls
    page_ids = sel.select("id").distinct()
    av = wiki_attachments_view(attachments, base_url)
    if referenced_only:
        bodies = pv.join(page_ids, "id", "left_semi").select("id", "body")
        av = wiki.referenced_attachments(av, bodies, "id", "body", decode_refs)
    else:
        av = av.join(page_ids.withColumnRenamed("id", "_p"), F.col("pageId") == F.col("_p"), "left_semi")
    allowed = wiki.allowed_attachments(av)
    owners = sel.select(F.col("id").alias("_owner"), "g", "crawl_target", "run_ord", "space_key", "space_name")
    a = allowed.join(owners, allowed["pageId"] == owners["_owner"]).drop("_owner")
    banned = F.lit(False)
    for k, sp in enumerate(specs):  # per-crawl banned titles (C3), one literal pattern per crawl
        pats = list(sp.get("banned_attachment_patterns", ()))
        if pats:
            banned = F.when(F.col("g") == k, any_match("title", pats)).otherwise(banned)
    a = a.where(~F.coalesce(banned, F.lit(False)))
    a = a.withColumn("filename", wiki.page_file_name(F.col("space_key"), F.col("fileId"), F.col("ext")))
    arec = metadata_record(F.col("id"), F.col("title"), F.col("webUrl"), F.col("createdAt"), F.col("mediaType"),
                           storage_uri(bucket, F.col("crawl_target"), F.col("filename")), space_name=F.col("space_name"))
    extra["downloads"] = a.select("crawl_target", "filename", "downloadUrl", "run_ord")
    return Corpus(docs.select("crawl_target", "filename", "mime_type", "body", "run_ord"),
                  page_meta.unionByName(a.select("crawl_target", "filename", arec.alias("metadata"), "run_ord")), extra)


def wiki_corpus(spaces: DataFrame, pages: DataFrame, attachments: DataFrame, *, target: str, type: str,
                items: Sequence[str] = (), children: DataFrame | None = None, include_child_pages: bool = False,
                exclude_pages: Sequence[str] = (), banned_attachment_patterns: Sequence[str] = (),
                base_url: str, bucket: str, referenced_only: bool = True, decode_refs: bool = False) -> Corpus:
    """L1 for one wiki crawl (see :func:`wiki_crawls`)."""
    c = wiki_crawls(spaces, pages, attachments,
                    [dict(target=target, type=type, items=list(items), include_child_pages=include_child_pages,
                          exclude_pages=list(exclude_pages), banned_attachment_patterns=list(banned_attachment_patterns))],
                    children=children, base_url=base_url, bucket=bucket, referenced_only=referenced_only,
                    decode_refs=decode_refs)
    extra = {k: (v.drop("run_ord") if "run_ord" in v.columns else v) for k, v in c.extra.items()}
    return Corpus(c.documents.drop("run_ord"), c.metadata.drop("run_ord"), extra)


# ------------------------------------------------------------------ issues (L2)

def issues_view(issues: DataFrame, base_url: str, custom_fields=iss.CUSTOM_FIELDS) -> DataFrame:
    """S11/S12 + P3 + P5-P7 projection of landed issues."""
    def f(path: str) -> Column:
        return F.col(f"fields.{path}")
    cols = [F.col("id"), F.col("key"), f("issuetype.name").alias("issue_type"), f("summary").alias("title"),
            F.col("renderedFields.description").alias("description"), f("project.name").alias("project_name"),
            f("project.id").alias("project_id"), f("project.key").alias("project_key"),
            F.coalesce(f("labels"), F.array().cast("array<string>")).alias("labels"),
            f("created").alias("created"), f("updated").alias("updated"),
            iss.count_or_zero(f("comment.comments")).alias("comments_count"),
            iss.attachment_list(f("attachment")).alias("attachments"), f("status.name").alias("status"),
            f("sprint_open").alias("sprint_open"), f("epic_link").alias("epic_link"),
            f("fix_versions").alias("fix_versions"), issue_url(base_url, F.col("key")).alias("web_url")]
    cols += [iss.pick_custom(F.col("custom"), k).alias(name) for name, k in custom_fields]
    return issues.select(*cols)


def issues_by_key(view: DataFrame, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Issues looked up by key (left semi join with the key table)."""
    return view.join(keys.select(F.col(key_col).alias("_k")), F.col("key") == F.col("_k"), "left_semi")


def _predicate(where: Column | str | None) -> Column:
    if where is None:
        return F.lit(True)
    return F.expr(where) if isinstance(where, str) else where


def issue_queries(issues: DataFrame, specs: Sequence[Mapping], *, comments: DataFrame | None = None,
                  steps: DataFrame | None = None, base_url: str, bucket: str,
                  custom_fields=iss.CUSTOM_FIELDS) -> Corpus:
    """L2 for many issue queries at once (e.g. every query of every target).

    Each spec has ``target``, ``where`` (C9 as a Spark predicate or SQL
    string), optionally ``include_comments``, ``include_steps`` and ``ord``
    (precedence, default: position). One scan of the issues tags each issue
    with every query it matches; the comment and test-step blocks (A1, A2)
    are aggregated once, only for issues matched by a query that asks for
    them, and joined once (J3, J4). Documents carry ``run_ord``."""
    spark = issues.sparkSession
    v = issues_view(issues, base_url, custom_fields)
    tags = F.array(*[F.when(_predicate(sp.get("where")), F.lit(k)) for k, sp in enumerate(specs)])
    v = v.withColumn("_q", F.explode(F.filter(tags, lambda x: x.isNotNull())))
    conf = literal_frame(spark, [(k, sp["target"], bool(sp.get("include_steps")), bool(sp.get("include_comments")),
                                  int(sp.get("ord", k))) for k, sp in enumerate(specs)],
                         "_q int, crawl_target string, _with_steps boolean, _with_comments boolean, run_ord int")
    v = v.join(conf, "_q")
    custom = []
    for name, _ in custom_fields:
        numeric = name == "Story Points"
        # landed values are text: a non-number must not fail the job (ANSI mode)
        value = F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)) if numeric else F.col(name)
        custom.append((name, value, numeric))
    body = iss.issue_body(F.col("key"), F.col("issue_type"), F.col("title"), F.col("project_name"), F.col("labels"),
                          F.col("created"), F.col("updated"), custom, F.col("description"))
    v = v.withColumn("body", body)
    blocks, parts = [], [F.col("body")]
    if steps is not None and any(sp.get("include_steps") for sp in specs):
        wanted = v.where("_with_steps").select(F.col("key").alias("issue_key")).distinct()
        st = steps.join(wanted, "issue_key", "left_semi").select("issue_key", F.posexplode("testSteps").alias("arrival", "s")).select(
            "issue_key", "arrival", "s.orderId", "s.step", "s.data", "s.result")
        blocks.append((iss.steps_block(st, "issue_key", [("orderId", True), ("arrival", True)],
                                       "step", "data", "result"), "steps_block"))
        parts.append(F.when(F.col("_with_steps"), F.col("steps_block")).otherwise(F.lit("")))
    if comments is not None and any(sp.get("include_comments") for sp in specs):
        wanted = v.where("_with_comments").select(F.col("key").alias("issue_key")).distinct()
        cm = comments.join(wanted, "issue_key", "left_semi").select("issue_key", "startAt", F.posexplode("comments").alias("pos", "c")).select(
            "issue_key", (F.coalesce(F.col("startAt"), F.lit(0)) + F.col("pos")).alias("seq"),
            F.col("c.author.displayName").alias("author"), F.col("c.updated").alias("updated_c"),
            F.col("c.renderedBody").alias("content"))
        blocks.append((iss.comments_block(cm, "issue_key", [("seq", True)], "author", "updated_c", "content"),
                       "comments_block"))
        parts.append(F.when(F.col("_with_comments"), F.col("comments_block")).otherwise(F.lit("")))
    filename = iss.issue_file_name(F.col("key")).alias("filename")
    docs = iss.attach_blocks(v, "key", *blocks).select("crawl_target", filename, F.lit(HTML).alias("mime_type"),
                                                       F.concat(*parts).alias("body"), "run_ord")
    # a block is at most one row an issue and no part of a record, so records need none of their joins
    named = v.select("crawl_target", filename, "run_ord", "key", "title", "web_url", "created", "updated")
    rec = metadata_record(F.col("key"), iss.issue_title(F.col("key"), F.col("title")), F.col("web_url"),
                          F.col("created"), F.lit(HTML), storage_uri(bucket, F.col("crawl_target"), F.col("filename")),
                          updated_at=F.col("updated"))
    return Corpus(docs, named.select("crawl_target", "filename", rec.alias("metadata"), "run_ord"), {})


def issue_corpus(issues: DataFrame, *, target: str, where: Column | str | None = None,
                 comments: DataFrame | None = None, steps: DataFrame | None = None,
                 include_comments: bool = False, include_steps: bool = False,
                 base_url: str, bucket: str, custom_fields=iss.CUSTOM_FIELDS) -> Corpus:
    """L2 for one issue query (see :func:`issue_queries`)."""
    c = issue_queries(issues, [dict(target=target, where=where, include_comments=include_comments,
                                    include_steps=include_steps)], comments=comments, steps=steps,
                      base_url=base_url, bucket=bucket, custom_fields=custom_fields)
    return Corpus(c.documents.drop("run_ord"), c.metadata.drop("run_ord"), c.extra)


_EPIC_ORDER = [("updated_ts", False), ("story_updated", False), ("story_key", True)]


def _epics_and_stories(issues: DataFrame, conf: DataFrame, base_url: str) -> tuple[DataFrame, DataFrame]:
    """The epics of the configured projects and their done stories."""
    projects = conf.select("project_key").distinct()
    v = issues_view(issues, base_url).join(projects, "project_key", "left_semi").withColumn(
        "updated_ts", F.try_to_timestamp(F.col("updated")))
    epics = v.where(F.col("issue_type") == "Epic").select(
        "project_key", F.col("key").alias("epic_key"), F.col("title").alias("epic_title"), "web_url", "created", "updated")
    # a story counts for an epic of its own project only, whatever other targets name
    done = v.where((F.col("status") == "Done") & F.col("epic_link").isNotNull())
    own = epics.select("project_key", F.col("epic_key").alias("epic_link"))
    stories = done.join(own, ["project_key", "epic_link"], "left_semi").select(
        "epic_link", F.col("key").alias("story_key"), F.col("title").alias("story_title"),
        F.col("updated").alias("story_updated"), "updated_ts")
    return epics, stories


def _epic_conf(issues: DataFrame, specs: Sequence[Mapping]) -> DataFrame:
    return literal_frame(issues.sparkSession, [(sp["target"], sp["project"], int(sp.get("ord", k))) for k, sp in enumerate(specs)],
                         "crawl_target string, project_key string, run_ord int")


def _epic_records(epics: DataFrame, bucket: str) -> DataFrame:
    rec = metadata_record(F.col("epic_key"), iss.epic_title(F.col("epic_key"), F.col("epic_title")), F.col("web_url"),
                          F.col("created"), F.lit(HTML), storage_uri(bucket, F.col("crawl_target"), F.col("filename")),
                          updated_at=F.col("updated"))
    return epics.select("crawl_target", "filename", rec.alias("metadata"), "run_ord")


def epic_parts_for(issues: DataFrame, specs: Sequence[Mapping], *, base_url: str, bucket: str,
                   part_bytes: int = PART_BYTES) -> Corpus:
    """:func:`epic_summaries_for` for epics of any size: a document is its
    rows (part, body) in part order, each of bounded size."""
    conf = _epic_conf(issues, specs)
    epics, stories = _epics_and_stories(issues, conf, base_url)
    parts = iss.epic_summary_parts(epics, stories, "epic_key", "epic_title", "epic_link", "story_key", "story_title",
                                   "story_updated", _EPIC_ORDER, part_bytes)
    named = epics.join(conf, "project_key").withColumn("filename", iss.issue_file_name(F.col("epic_key")))
    listed = named.join(stories.select(F.col("epic_link").alias("epic_key")).distinct(), "epic_key", "left_semi")
    docs = parts.join(named.select("epic_key", "crawl_target", "run_ord", "filename"), "epic_key").select(
        "crawl_target", "filename", F.lit(HTML).alias("mime_type"), "part", F.col("text").alias("body"), "run_ord")
    return Corpus(docs, _epic_records(listed, bucket), {})


def epic_summaries_for(issues: DataFrame, specs: Sequence[Mapping], *, base_url: str, bucket: str) -> Corpus:
    """L2 sibling for many (target, project) specs at once: one summary per
    epic of each project listing its done stories, newest update first
    (S14, S15, C10, J5, A3). Epic keys are unique across projects, so one
    ordered aggregation serves every spec; a small table maps each project
    to its target(s). Documents carry ``run_ord``."""
    conf = _epic_conf(issues, specs)
    epics, stories = _epics_and_stories(issues, conf, base_url)
    s = iss.epic_summaries(epics, stories, "epic_key", "epic_title", "epic_link", "story_key", "story_title",
                           "story_updated", _EPIC_ORDER)
    s = s.join(conf, "project_key")
    docs = s.select("crawl_target", "run_ord", iss.issue_file_name(F.col("epic_key")).alias("filename"),
                    F.lit(HTML).alias("mime_type"), "body", "epic_key", "epic_title", "web_url", "created", "updated")
    return Corpus(docs.select("crawl_target", "filename", "mime_type", "body", "run_ord"), _epic_records(docs, bucket), {})


def epic_summary_corpus(issues: DataFrame, *, target: str, project: str, base_url: str, bucket: str) -> Corpus:
    """L2 sibling for one project (see :func:`epic_summaries_for`)."""
    c = epic_summaries_for(issues, [dict(target=target, project=project)], base_url=base_url, bucket=bucket)
    return Corpus(c.documents.drop("run_ord"), c.metadata.drop("run_ord"), c.extra)


# ------------------------------------------------------------------ web (L3)

def web_crawls(web_pages: DataFrame, crawls: Sequence[Mapping], *, bucket: str) -> Corpus:
    """L3 for many crawls at once (e.g. every web source of every target).

    Each crawl is a mapping with ``target``, ``seeds`` and optionally
    ``include_links``, ``regex``, ``banned_url_patterns``,
    ``banned_title_patterns`` and ``depth``. The HTML is read twice in all,
    whatever the number of crawls: once to extract titles and hrefs into a
    narrow checkpointed table, once to read the bodies of saved pages. The
    crawls run as one breadth-first search keyed by crawl (visited set,
    depth, bans and link filters per crawl; minimum hop, §Q1); pages not
    landed are reported as missing (§Q3)."""
    spark = web_pages.sparkSession
    ensure_checkpoint_dir(spark)
    print_ = F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256)
    landed = web_pages.select("url", "fetched_at", "html", print_.alias("_print"))
    # titles and hrefs are extracted where a page is read; only narrow rows are shuffled
    read = web.page_facts(web.identify_pages(landed).drop("norm_url")).drop("title_banned")
    # one landed copy per normalised URL: latest fetch, ties by content, so title and body come from one row
    facts = materialize(latest_by(read, ["id"], ["fetched_at", "url", "_print"]))

    def crawls_of(conditions: Mapping[int, Column]) -> Column:
        """The crawls whose condition a row meets."""
        tags = F.array(F.lit(None).cast("int"), *[F.when(cond, F.lit(k)) for k, cond in conditions.items()])
        return F.filter(tags, lambda x: x.isNotNull())

    seeds, start_if, bounds, stop_if, link_if = [], F.lit(False), [], {}, {}
    for k, c in enumerate(crawls):
        depth = int(c.get("depth", 1))
        links = bool(c.get("include_links", False)) and depth > 1
        banned_url = list(c.get("banned_url_patterns", ()))
        bounds.append((k, depth - 1 if links else 0))
        if depth <= 0:
            continue  # a crawl of depth <= 0 visits nothing
        seeds += [(k, u) for u in c.get("seeds", ())]
        start_if = start_if | ((F.col("g") == k) & none_match("norm_url", banned_url))
        stop_if[k] = any_match("title", list(c.get("banned_title_patterns", ())))
        if links:
            link_if[k] = (allow_match("link", c.get("regex")) & none_match("link", banned_url)
                          & none_match("dst_norm", banned_url))

    seed_df = (materialize(literal_frame(spark, seeds, "g int, url string").withColumn("norm_url", normalize_url("url")))
               .where(start_if).select("g", F.md5("norm_url").alias("id"), "url").where("id is not null"))
    stop_df = facts.select(F.explode(crawls_of(stop_if)).alias("g"), "id")
    # every link is resolved and stored once, with the list of the crawls that may follow it
    lk = web.links_from_hrefs(facts, "id", "url", "hrefs").withColumnRenamed("norm", "dst_norm")
    lk = materialize(lk.select(crawls_of(link_if).alias("groups"), F.col("id").alias("src"), F.md5("dst_norm").alias("dst"), "link")
                     .where(F.size("groups") > 0))
    targets = literal_frame(spark, [(k, c["target"]) for k, c in enumerate(crawls)], "g int, crawl_target string")
    visited = grouped_frontier_search(lk.select("groups", "src", "dst"), seed_df.select("g", "id"),
                                      literal_frame(spark, bounds, "g int, max_hop int"), group="g", stoppers=stop_df)
    saved = facts.drop("hrefs").join(visited, "id").join(stop_df, ["g", "id"], "left_anti")
    # bodies are read only for saved pages; a repeated landed row gives its body once
    chosen = facts.join(saved.select("id").distinct(), "id", "left_semi").select(
        "id", F.col("url").alias("_url"), F.col("fetched_at").alias("_at"), F.col("_print").alias("_p"))
    same = ((landed["url"] == F.col("_url")) & landed["fetched_at"].eqNullSafe(F.col("_at")) & (landed["_print"] == F.col("_p")))
    body = landed.join(chosen, same).select("id", F.col("html").alias("body")).dropDuplicates(["id"])
    bodies = saved.drop("_print").join(body, "id").join(targets, "g")
    fname = web.web_file_name(F.col("id"), F.col("title"))
    docs = bodies.select("crawl_target", fname.alias("filename"), F.lit(HTML).alias("mime_type"), "body", "id",
                         "title", "url", "fetched_at")
    rec = metadata_record(F.col("id"), F.col("title"), F.col("url"), F.col("fetched_at").cast("string"), F.lit(HTML),
                          storage_uri(bucket, F.col("crawl_target"), F.col("filename")))
    absent = visited.join(facts.select("id"), "id", "left_anti")
    named = lk.join(absent.select(F.col("id").alias("dst")).distinct(), "dst", "left_semi").select(
        F.explode("groups").alias("g"), F.col("dst").alias("id"), F.col("link").alias("url"))
    known = seed_df.unionByName(named).groupBy("g", "id").agg(F.min("url").alias("url"))
    missing = (absent.join(known, ["g", "id"], "left").join(targets, "g")
               .select("crawl_target", "id", "hop", "url", F.lit("missing").alias("status")))
    return Corpus(docs.select("crawl_target", "filename", "mime_type", "body"),
                  docs.select("crawl_target", "filename", rec.alias("metadata")), {"missing": missing})


def web_corpus(web_pages: DataFrame, seeds: Sequence[str], *, target: str, include_links: bool = False,
               regex: str | None = None, banned_url_patterns: Sequence[str] = (),
               banned_title_patterns: Sequence[str] = (), depth: int = 1, bucket: str) -> Corpus:
    """L3 for one crawl target (see :func:`web_crawls`)."""
    return web_crawls(web_pages, [dict(target=target, seeds=list(seeds), include_links=include_links, regex=regex,
                                       banned_url_patterns=list(banned_url_patterns),
                                       banned_title_patterns=list(banned_title_patterns), depth=depth)],
                      bucket=bucket)


# ------------------------------------------------------------------ targets

# Options each source accepts (anything else is rejected, so a misplaced key is not silently ignored)
SOURCE_KEYS = {"source", "type", "items", "options"}
OPTION_KEYS = {
    "confluence": {"includeChildPages", "excludePages", "bannedAttachmentPatterns"},
    "jira": {"includeComments", "includeZephyrTestSteps"},
    "web": {"includeLinks", "regex", "bannedUrlPatterns", "bannedTitlePatterns", "depth"},
}


def _check_source(target: str, src: Mapping) -> None:
    extra = set(src) - SOURCE_KEYS
    if extra:
        raise ValueError(f"crawl target {target!r}: unknown source keys {sorted(extra)}")
    known = OPTION_KEYS.get(src.get("source"))
    bad = set(src.get("options") or {}) - known if known is not None else set()
    if bad:
        raise ValueError(f"crawl target {target!r}: unknown {src.get('source')} options {sorted(bad)}")


def run_targets(spark, config: Mapping[str, Mapping], tables: Mapping[str, DataFrame], *,
                base_url: str, bucket: str, custom_fields=iss.CUSTOM_FIELDS) -> Corpus:
    """S18 + U1: run every configured source of every crawl target and
    union the results; an unknown (source, type) is skipped. Each kind of
    source runs once for all targets (wiki crawls, epic summaries, issue
    queries, web crawls), keyed by target inside; ``run_ord`` keeps the
    configuration order for latest-wins."""
    docs, metas = [], []
    extra: dict[str, DataFrame] = {}
    web_specs: list[dict] = []
    issue_specs: list[dict] = []
    wiki_specs: list[dict] = []
    epic_specs: list[dict] = []

    counter = [0]

    def next_ord() -> int:
        # run order = precedence for latest-wins (configuration order, then item order)
        counter[0] += 1
        return counter[0]

    def add(part: Corpus, extras: bool = False) -> None:
        if "run_ord" in part.documents.columns:  # batched parts carry their own order
            docs.append(part.documents)
            metas.append(part.metadata)
            n = F.lit(counter[0]).cast("int").alias("run_ord")
        else:
            n = F.lit(next_ord()).cast("int").alias("run_ord")
            docs.append(part.documents.select("*", n))
            metas.append(part.metadata.select("*", n))
        if extras:
            for k, v in part.extra.items():
                v = v if "run_ord" in v.columns else v.select("*", n)
                extra[k] = v if k not in extra else extra[k].unionByName(v, allowMissingColumns=True)
    for target, spec in config.items():
        if not isinstance(spec, Mapping) or "sources" not in spec:
            raise ValueError(f"crawl target {target!r}: expected {{'uploadDestination': ..., 'sources': [...]}}")
        for src in spec["sources"]:
            _check_source(target, src)
            kind, typ, items = src.get("source"), src.get("type"), list(src.get("items") or [])
            opt = dict(src.get("options") or {})
            for k in ("bannedAttachmentPatterns", "bannedUrlPatterns", "bannedTitlePatterns"):
                if k in opt:
                    opt[k] = [js_regex(x) for x in opt[k]]
            if opt.get("regex") is not None:
                opt["regex"] = js_regex(opt["regex"])
            if kind == "confluence":
                # all wiki crawls of all targets run together below (one closure loop, one reference pass)
                wiki_specs.append(dict(target=target, type=typ, items=items, ord=next_ord(),
                                       include_child_pages=opt.get("includeChildPages", False),
                                       exclude_pages=opt.get("excludePages", []),
                                       banned_attachment_patterns=opt.get("bannedAttachmentPatterns", [])))
            elif kind == "jira" and typ == "query":
                # all issue queries of all targets run together below (one scan, blocks aggregated once)
                for q in items:
                    issue_specs.append(dict(target=target, where=q, ord=next_ord(),
                                            include_comments=opt.get("includeComments", False),
                                            include_steps=opt.get("includeZephyrTestSteps", False)))
            elif kind == "jira" and typ == "epic-issue-summary":
                for project in items:
                    epic_specs.append(dict(target=target, project=str(project), ord=next_ord()))
            elif kind == "web" and typ == "url":
                # all web crawls of all targets run together below (one HTML pass, one search)
                web_specs.append(dict(target=target, seeds=items, include_links=opt.get("includeLinks", False),
                                      regex=opt.get("regex"), banned_url_patterns=opt.get("bannedUrlPatterns", []),
                                      banned_title_patterns=opt.get("bannedTitlePatterns", []),
                                      depth=opt.get("depth", 1)))
    if epic_specs:
        add(epic_summaries_for(tables["issues"], epic_specs, base_url=base_url, bucket=bucket))
    if wiki_specs:
        add(wiki_crawls(tables["spaces"], tables["pages"], tables["attachments"], wiki_specs,
                        children=tables.get("page_children"), base_url=base_url, bucket=bucket), extras=True)
    if issue_specs:
        add(issue_queries(tables["issues"], issue_specs, comments=tables.get("comments"),
                          steps=tables.get("test_steps"), base_url=base_url, bucket=bucket, custom_fields=custom_fields))
    if web_specs:
        add(web_crawls(tables["web_pages"], web_specs, bucket=bucket), extras=True)
    if not docs:
        empty = spark.createDataFrame([], "crawl_target string, filename string, mime_type string, body string, run_ord int")
        return Corpus(empty, spark.createDataFrame(
            [], "crawl_target string, filename string, metadata string, run_ord int"), extra)
    d, m = docs[0], metas[0]
    for x in docs[1:]:
        d = d.unionByName(x)
    for x in metas[1:]:
        m = m.unionByName(x, allowMissingColumns=True)
    return Corpus(d, m, extra)
