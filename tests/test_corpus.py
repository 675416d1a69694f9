"""End-to-end corpus jobs over literal landed snapshots."""

import tempfile

from pyspark.sql import functions as F

from quire import schemas
from quire.plans.corpus import run_targets, web_corpus
from quire.plans.publish import publish_snapshot

PDF = "application/pdf"
BASE, BUCKET = "https://w.example.com", "bkt"


def _tables(spark):
    spaces = spark.createDataFrame([
        ("10", "AB", "Alpha", "h", "global", "current"), ("20", "CD", "Gamma", "h", "global", "current"),
        ("30", "~me", "Mine", "h", "personal", "current")], schemas.SPACE)
    def page(i, space, title, body, link):
        return (i, title, space, "current", {"storage": {"value": body}}, {"createdAt": "2024-01-0" + i[-1]}, {"webui": link})
    pages = spark.createDataFrame([
        page("1", "10", "Home", '<p>x</p><ri:attachment ri:filename="a.pdf" /><ri:attachment ri:filename="A &amp; B.pdf" />',
             "/spaces/AB/pages/1/Home"),
        page("2", "10", "Child", "<p>c</p>", "/spaces/AB/pages/2/Child"),
        page("3", "20", "Grand", '<ri:attachment ri:filename="img.png" />', "/spaces/CD/pages/3/G"),
        page("4", "99", "Lost", "<p>?</p>", "/spaces/ZZ/pages/4/L"),
        page("5", "20", "Other", "<p>o</p>", "/x")], schemas.PAGE)
    children = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", "1"), ("2", "4")], schemas.CHILD)
    atts = spark.createDataFrame([
        ("a1", "a.pdf", PDF, "1", "f1", "/a1", "/d/a1", {"createdAt": "t"}, "current"),
        ("a2", "A & B.pdf", PDF, "1", "f2", "/a2", "/d/a2", {"createdAt": "t"}, "current"),
        ("a3", "img.png", "image/png", "3", "f3", "/a3", "/d/a3", {"createdAt": "t"}, "current"),
        ("a4", "unref.pdf", PDF, "2", "f4", "/a4", "/d/a4", {"createdAt": "t"}, "current")], schemas.ATTACHMENT)

    def issue(k, typ, status, epic=None, upd="2024-02-01T00:00:00", desc="<p>d</p>", sp=None):
        return (k, k, {"issuetype": {"name": typ}, "project": {"id": "p1", "name": "Proj", "key": "PRJ"},
                       "labels": ["l1"], "summary": "S " + k, "created": "2024-01-01T00:00:00", "updated": upd,
                       "attachment": None, "comment": None, "status": {"name": status}, "sprint_open": True,
                       "epic_link": epic, "fix_versions": []},
                {"customfield_10036": sp} if sp else {}, {"description": desc})
    issues = spark.createDataFrame([
        issue("PRJ-1", "Story", "Done", "PRJ-9", "2024-02-03T00:00:00", sp="2.0"),
        issue("PRJ-2", "Story", "Done", "PRJ-9", "2024-02-04T00:00:00"),
        issue("PRJ-3", "Bug", "Open", sp="n/a"), issue("PRJ-9", "Epic", "Open"), issue("PRJ-8", "Epic", "Open")],
        schemas.ISSUE)
    comments = spark.createDataFrame([("PRJ-1", 0, 2, 2, [({"displayName": "Ann"}, "<p>hi</p>", "c", "u1"),
                                                         ({"displayName": "Bob"}, "<p>yo</p>", "c", "u2")])],
                                     schemas.COMMENTS_RESPONSE)
    steps = spark.createDataFrame([("PRJ-1", [(2, "s2", None, "r2"), (1, "s1", "d1", None)])], schemas.TEST_STEPS_RESPONSE)
    web = spark.createDataFrame([
        ("https://a.example.com/", '<title>A</title><a href="/b">b</a><a href="/c?x=1">c</a><a href="/spam">s</a>', "t1"),
        ("https://a.example.com/b", "<title>B</title><a href='/d'>d</a>", "t1"),
        ("https://a.example.com/c", "<title>Verboten</title><a href='/e'>e</a>", "t1"),
        ("https://a.example.com/e", "<title>E</title>", "t1")], schemas.WEB_PAGE)
    return {"spaces": spaces, "pages": pages, "page_children": children, "attachments": atts, "issues": issues,
            "comments": comments, "test_steps": steps, "web_pages": web}


CONFIG = {
    "wiki": {"uploadDestination": "gcp", "sources": [
        {"source": "confluence", "type": "pages", "items": ["1"],
         "options": {"includeChildPages": True, "excludePages": ["2"], "bannedAttachmentPatterns": ["(?i)^IMG"]}},
        {"source": "confluence", "type": "spaces", "items": ["CD"]}]},
    "issues": {"uploadDestination": "dify", "sources": [
        {"source": "jira", "type": "query", "items": ["project_key = 'PRJ' AND status = 'Done'"],
         "options": {"includeComments": True, "includeZephyrTestSteps": True}},
        {"source": "jira", "type": "epic-issue-summary", "items": ["PRJ"]},
        {"source": "nowhere", "type": "x", "items": ["y"]}]},
}


def test_run_targets_end_to_end(spark):
    t = _tables(spark)
    c = run_targets(spark, CONFIG, t, base_url=BASE, bucket=BUCKET)
    rows = c.documents.collect()
    docs = {(r.crawl_target, r.filename): r.body for r in rows}
    wiki = sorted(r.filename for r in rows if r.crawl_target == "wiki")
    # pages 1, 3 (child of 2, which is excluded after expansion) and 4 (quarantined: unknown space);
    # space CD adds pages 3 and 5
    assert wiki == ["confluence-cloud AB 1.html", "confluence-cloud CD 3.html", "confluence-cloud CD 3.html",
                    "confluence-cloud CD 5.html"]
    assert docs[("wiki", "confluence-cloud AB 1.html")].startswith("Home\n\n<p>x</p>")
    assert [r.id for r in c.extra["quarantine"].collect()] == ["4"]
    # only the referenced, allowed and not banned attachment (escaped name never matches)
    assert [r.filename for r in c.extra["downloads"].collect()] == ["confluence-cloud AB f1.pdf"]
    body = docs[("issues", "jira-cloud PRJ-1.html")]
    assert "Story Points: 2\n\nDescription: \n<p>d</p>" in body
    assert "Zephyr Tests Scenarios:\n=====\nTest Number: 1\n\nTest Step: \ns1\n\nTest Data: \nd1\n\n\n===\n" in body
    assert body.endswith("Comment Number: 2\n\nComment Author: Bob\n\nComment Updated Time: u2\n\nComment Body: \n<p>yo</p>\n=====\n")
    epic = docs[("issues", "jira-cloud PRJ-9.html")]
    assert epic == ("Epic ID: PRJ-9\nEpic Title: S PRJ-9\n=====\nListing of User Stories:\n\n"
                    "PRJ-2: S PRJ-2 [Last Updated On: 2024-02-04T00:00:00]\n"
                    "PRJ-1: S PRJ-1 [Last Updated On: 2024-02-03T00:00:00]\n")
    assert ("issues", "jira-cloud PRJ-8.html") not in docs
    # a non-numeric story-point value gives no line instead of failing the job
    from quire.plans.corpus import issue_corpus
    bug = issue_corpus(t["issues"], target="x", where="key = 'PRJ-3'", base_url=BASE, bucket=BUCKET)
    assert "Story Points" not in bug.documents.first().body
    meta = {r.filename: r.metadata for r in c.metadata.where("crawl_target = 'wiki'").collect()}
    m = meta["confluence-cloud AB 1.html"]
    assert m.structData.webUrl == BASE + "/wiki/spaces/AB/pages/1" and m.structData.spaceName == "Alpha"
    assert m.content.uri == "gs://bkt/wiki/confluence-cloud AB 1.html"

    out = tempfile.mkdtemp(prefix="quire-pub-", dir="/tmp")
    res = publish_snapshot(c.documents, c.metadata, out)
    cat = {(r.crawl_target, r.filename) for r in res["catalog"].collect()}
    assert ("wiki", "confluence-cloud CD 3.html") in cat and cat == set(docs) | {("wiki", "confluence-cloud AB f1.pdf")}
    assert {r.status for r in res["manifest"].collect()} == {"ready", "missing_body"}  # attachment body not landed


def test_web_crawl_depth_titles_and_missing(spark):
    t = _tables(spark)
    c = web_corpus(t["web_pages"], ["https://a.example.com/?utm=1"], target="web", include_links=True,
                   banned_url_patterns=["/spam"], banned_title_patterns=["(?i)verboten"], depth=3, bucket=BUCKET)
    titles = sorted(r.filename.split(" ", 2)[2] for r in c.documents.collect())
    # A (hop 0), B (hop 1), D is not landed (hop 2 -> missing), C banned by title (not saved, not expanded)
    assert titles == ["A.html", "B.html"]
    missing = [(r.url, r.hop) for r in c.extra["missing"].collect()]
    assert missing == [("https://a.example.com/d", 2)]
    one = web_corpus(t["web_pages"], ["https://a.example.com/"], target="web", include_links=False, depth=5,
                     bucket=BUCKET)
    assert one.documents.count() == 1


def test_command_line_run(spark):
    import os

    from quire.__main__ import execute
    base = tempfile.mkdtemp(prefix="quire-cli-", dir="/tmp")
    landed = {}
    for name, df in _tables(spark).items():
        path = os.path.join(base, "landed", name)
        df.write.json(path)
        landed[name] = path
    run = {"crawlTargets": CONFIG, "landed": landed, "baseUrl": BASE, "bucket": BUCKET,
           "out": os.path.join(base, "out"), "stores": {"wiki": "s-1"}}
    execute(spark, run)
    docs = spark.read.parquet(os.path.join(base, "out", "documents"))
    assert docs.where("crawl_target = 'issues'").count() == 3
    summary = {(r.crawl_target, r.mime_type): (r.documents, r.metadata_records)
               for r in spark.read.parquet(os.path.join(base, "out", "summary")).collect()}
    assert summary[("wiki", "application/pdf")] == (0, 1) and summary[("issues", "text/html")] == (3, 3)
    dl = spark.read.parquet(os.path.join(base, "out", "downloads")).collect()
    assert [(r.filename, r.run_ord) for r in dl] == [("confluence-cloud AB f1.pdf", 1)]
    man = spark.read.parquet(os.path.join(base, "out", "manifest"))
    assert {r.crawl_target for r in man.collect()} == {"wiki"}
    run2 = dict(run, out=os.path.join(base, "out2"), previousCatalog=os.path.join(base, "out", "catalog"))
    execute(spark, run2)
    diff = spark.read.parquet(os.path.join(base, "out2", "diff"))
    assert {r.action for r in diff.collect()} == {"same"}


def test_web_latest_fetch_wins_per_normalised_url(spark):
    t = _tables(spark)
    again = spark.createDataFrame([("https://A.example.com/b?x=2#f", "<title>B2</title>", "t2")], schemas.WEB_PAGE)
    c = web_corpus(t["web_pages"].unionByName(again), ["https://a.example.com/"], target="web", include_links=True,
                   banned_url_patterns=["/spam"], banned_title_patterns=["(?i)verboten"], depth=2, bucket=BUCKET)
    got = sorted((r.filename.split(" ", 2)[2], r.body) for r in c.documents.collect())
    assert [g[0] for g in got] == ["A.html", "B2.html"] and got[1][1] == "<title>B2</title>"


def test_issue_query_predicates(spark):
    from quire.plans.corpus import issues_view
    v = issues_view(_tables(spark)["issues"], BASE)
    cases = {
        "project_key = 'PRJ' AND status = 'Done'": {"PRJ-1", "PRJ-2"},
        "issue_type IN ('Epic')": {"PRJ-8", "PRJ-9"},
        "coalesce(description, '') <> '' AND key IN ('PRJ-1', 'PRJ-3')": {"PRJ-1", "PRJ-3"},
        "sprint_open AND epic_link = 'PRJ-9'": {"PRJ-1", "PRJ-2"},
        "lower(title) LIKE '%prj-3%'": {"PRJ-3"},
        "array_contains(fix_versions, '2.1')": set(),
    }
    for where, want in cases.items():
        assert {r.key for r in v.where(where).collect()} == want, where


def test_wiki_all_and_web_depth_zero(spark):
    from quire.plans.corpus import wiki_corpus
    t = _tables(spark)
    c = wiki_corpus(t["spaces"], t["pages"], t["attachments"], target="w", type="all", base_url=BASE, bucket=BUCKET)
    assert sorted(r.filename for r in c.documents.collect()) == [
        "confluence-cloud AB 1.html", "confluence-cloud AB 2.html", "confluence-cloud CD 3.html",
        "confluence-cloud CD 5.html"]
    none = web_corpus(t["web_pages"], ["https://a.example.com/"], target="web", include_links=True, depth=0,
                      bucket=BUCKET)
    assert none.documents.count() == 0


def test_landed_list_responses_from_json(spark, tmp_path):
    import json

    from quire import schemas
    from quire.sources import landed
    pages = [{"request_path": "/spaces?cursor=0", "_links": {"next": "/spaces?cursor=1"},
              "results": [{"id": "1", "key": "AB", "name": "A", "type": "global", "status": "current"}]},
             {"request_path": "/spaces?cursor=1", "_links": {"next": "/spaces?cursor=2"}, "results": []},
             {"request_path": "/spaces?cursor=9"}]
    path = tmp_path / "spaces.json"
    path.write_text("\n".join(json.dumps(p) for p in pages))
    items = landed.read_list_responses(spark, str(path), schemas.SPACE)
    assert [(r.request_path, r.key) for r in items.collect()] == [("/spaces?cursor=0", "AB")]
    raw = landed.read_json(spark, str(path), schemas.WIKI_LIST_RESPONSE.format(schemas.SPACE)).select(
        "request_path", F.col("_links.next").alias("next_link"))
    assert [(r.request_path, r.next_link) for r in landed.cursor_audit(raw).collect()] == [
        ("/spaces?cursor=1", "/spaces?cursor=2")]


def test_wiki_attachment_options(spark):
    from quire.plans.corpus import wiki_corpus
    t = _tables(spark)
    def names(**kw):
        c = wiki_corpus(t["spaces"], t["pages"], t["attachments"], target="w", type="all", base_url=BASE,
                        bucket=BUCKET, **kw)
        return sorted(r.filename for r in c.extra["downloads"].collect())
    assert names() == ["confluence-cloud AB f1.pdf"]
    assert names(decode_refs=True) == ["confluence-cloud AB f1.pdf", "confluence-cloud AB f2.pdf"]
    assert names(referenced_only=False) == ["confluence-cloud AB f1.pdf", "confluence-cloud AB f2.pdf",
                                            "confluence-cloud AB f4.pdf"]


def test_checked_broadcast_falls_back(spark):
    from quire.operators.filters import checked_broadcast
    df = spark.range(10)
    assert "ResolvedHint" in checked_broadcast(df, 20)._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in checked_broadcast(df, 20)._jdf.queryExecution().logical().toString().lower()
    assert checked_broadcast(df, 5) is df


def test_unknown_configuration_keys_are_rejected(spark):
    import pytest
    t = _tables(spark)
    bad = {"t": {"sources": [{"source": "web", "type": "url", "items": ["https://a.example.com/"],
                              "settings": {}, "options": {"depth": 2}}]}}
    with pytest.raises(ValueError, match="unknown source keys"):
        run_targets(spark, bad, t, base_url=BASE, bucket=BUCKET)
    bad2 = {"t": {"sources": [{"source": "web", "type": "url", "items": ["x"], "options": {"includeComments": True}}]}}
    with pytest.raises(ValueError, match="unknown web options"):
        run_targets(spark, bad2, t, base_url=BASE, bucket=BUCKET)


def test_old_configuration_shape_is_rejected(spark):
    import pytest

    from quire.__main__ import execute
    old = {"crawlTargets": {"t": [{"source": "web", "type": "url", "items": ["https://a.example.com/"]}]},
           "landed": {}, "baseUrl": BASE, "bucket": BUCKET, "out": "/tmp/unused"}
    with pytest.raises(ValueError, match="expected"):
        execute(spark, old)


def test_web_targets_batched_equal_separate_runs(spark):
    t = _tables(spark)
    a = {"source": "web", "type": "url", "items": ["https://a.example.com/"],
         "options": {"includeLinks": True, "depth": 3, "bannedTitlePatterns": ["(?i)verboten"]}}
    b = {"source": "web", "type": "url", "items": ["https://a.example.com/b"], "options": {"depth": 1}}
    both = run_targets(spark, {"ta": {"sources": [a]}, "tb": {"sources": [b]}}, t, base_url=BASE, bucket=BUCKET)
    got = sorted((r.crawl_target, r.filename) for r in both.documents.collect())
    one = sorted((r.crawl_target, r.filename) for r in
                 run_targets(spark, {"ta": {"sources": [a]}}, t, base_url=BASE, bucket=BUCKET).documents.collect())
    two = sorted((r.crawl_target, r.filename) for r in
                 run_targets(spark, {"tb": {"sources": [b]}}, t, base_url=BASE, bucket=BUCKET).documents.collect())
    assert got == sorted(one + two) and len(one) == 2 and len(two) == 1


def test_issue_queries_batched_and_precedence(spark):
    t = _tables(spark)
    q1 = {"source": "jira", "type": "query", "items": ["status = 'Done'"], "options": {"includeComments": True}}
    q2 = {"source": "jira", "type": "query", "items": ["issue_type = 'Bug'"], "options": {"includeZephyrTestSteps": True}}
    both = run_targets(spark, {"a": {"sources": [q1]}, "b": {"sources": [q2]}}, t, base_url=BASE, bucket=BUCKET)
    sep = [run_targets(spark, {"a": {"sources": [q1]}}, t, base_url=BASE, bucket=BUCKET),
           run_targets(spark, {"b": {"sources": [q2]}}, t, base_url=BASE, bucket=BUCKET)]
    rows = lambda c: sorted((r.crawl_target, r.filename, r.body) for r in c.documents.collect())
    assert rows(both) == sorted(rows(sep[0]) + rows(sep[1]))
    # one target, the same issue from two queries: the later query (with comments) wins after publishing
    plain = {"source": "jira", "type": "query", "items": ["key = 'PRJ-1'"]}
    out = tempfile.mkdtemp(prefix="quire-prec-", dir="/tmp")
    c = run_targets(spark, {"x": {"sources": [plain, q1]}}, t, base_url=BASE, bucket=BUCKET)
    publish_snapshot(c.documents, c.metadata, out)
    body = spark.read.parquet(f"{out}/documents").where("filename = 'jira-cloud PRJ-1.html'").first().body
    assert "Comments:" in body


def test_wiki_crawls_batched_equal_separate_runs(spark):
    t = _tables(spark)
    a = {"source": "confluence", "type": "all", "items": [], "options": {"bannedAttachmentPatterns": ["^a\\."]}}
    b = {"source": "confluence", "type": "spaces", "items": ["CD", "AB"]}
    c = {"source": "confluence", "type": "pages", "items": ["2"], "options": {"includeChildPages": True}}
    conf = {"ta": {"sources": [a]}, "tb": {"sources": [b]}, "tc": {"sources": [c]}}
    rows = lambda x: sorted((r.crawl_target, r.filename, r.body) for r in x.documents.collect())
    dl = lambda x: sorted((r.crawl_target, r.filename) for r in x.extra["downloads"].collect())
    both = run_targets(spark, conf, t, base_url=BASE, bucket=BUCKET)
    seps = [run_targets(spark, {k: v}, t, base_url=BASE, bucket=BUCKET) for k, v in conf.items()]
    assert rows(both) == sorted(sum((rows(x) for x in seps), []))
    assert dl(both) == sorted(sum((dl(x) for x in seps), []))
    assert ("ta", "confluence-cloud AB f1.pdf") not in dl(both) and ("tb", "confluence-cloud AB f1.pdf") in dl(both)


def test_epic_summaries_for_several_targets(spark):
    from quire.plans.corpus import epic_summaries_for
    t = _tables(spark)
    c = epic_summaries_for(t["issues"], [dict(target="a", project="PRJ", ord=1), dict(target="b", project="PRJ", ord=2),
                                         dict(target="c", project="NONE", ord=3)], base_url=BASE, bucket=BUCKET)
    got = sorted((r.crawl_target, r.filename, r.run_ord) for r in c.documents.collect())
    assert got == [("a", "jira-cloud PRJ-9.html", 1), ("b", "jira-cloud PRJ-9.html", 2)]


def test_issue_records_read_no_blocks(spark):
    from quire.plans.corpus import issue_queries
    t = _tables(spark)
    c = issue_queries(t["issues"], [dict(target="a", include_comments=True, include_steps=True)], comments=t["comments"],
                      steps=t["test_steps"], base_url=BASE, bucket=BUCKET)
    assert "issue_key" not in c.metadata._jdf.queryExecution().optimizedPlan().toString()
    assert "issue_key" in c.documents._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.filename for r in c.metadata.collect()) == sorted(r.filename for r in c.documents.collect()) != []
