"""DuckDB SQL of the queries in :mod:`quire.job_queries`, written from the
expected behaviour; nothing is imported from the engine."""

from __future__ import annotations

_NL2 = "chr(10) || chr(10)"

_STORY = """
SELECT o_orderkey AS k, 'O-' || o_orderkey AS key, 'Story' AS kind, o_orderpriority || ' order' AS title,
  'P' || ((o_custkey + CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END) % 5) AS project, o_custkey AS cust,
  o_orderstatus = 'F' AS done, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS made,
  o_orderkey % 4 = 0 AS sprint, 'C-' || o_custkey AS link, 'v' || (o_orderkey % 3) AS version,
  CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE 'C-' || o_custkey END AS epic,
  CASE o_orderkey % 7 WHEN 3 THEN '12000000' WHEN 4 THEN '2.5' WHEN 6 THEN '3' END AS points,
  CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN '0'
       ELSE 'Order ' || o_orderkey END AS description
FROM orders
"""
_EPIC = """
SELECT NULL AS k, 'C-' || c_custkey AS key, 'Epic' AS kind, c_name AS title, 'P' || (c_custkey % 5) AS project,
  c_custkey AS cust, false AS done, '2024-01-01T00:00:00' AS made, false AS sprint, NULL AS link, NULL AS version,
  NULL AS epic, NULL AS points, NULL AS description
FROM customer
"""
_COMMENTS = f"""
SELECT conv_id AS k, {_NL2} || 'Comments:' || chr(10) || '=====' || chr(10)
  || string_agg('Comment Number: ' || n || {_NL2} || 'Comment Author: ' || coalesce(role, '') || {_NL2}
       || 'Comment Updated Time: turn ' || turn || {_NL2} || 'Comment Body: ' || chr(10) || coalesce(text, ''),
       chr(10) || '=====' || chr(10) ORDER BY n) || chr(10) || '=====' || chr(10) AS comments
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) GROUP BY conv_id
"""
_STEPS = f"""
SELECT k, {_NL2} || 'Zephyr Tests Scenarios:' || chr(10) || '=====' || chr(10)
  || string_agg('Test Number: ' || n || {_NL2} || 'Test Step: ' || chr(10) || step || {_NL2}
       || CASE WHEN data IS NULL THEN '' ELSE 'Test Data: ' || chr(10) || data END || {_NL2},
       chr(10) || '===' || chr(10) ORDER BY n) || chr(10) || '=====' || chr(10) AS steps
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, step, data NULLS FIRST) AS n FROM (
  SELECT l_orderkey AS k, l_linenumber, 'Ship part ' || l_partkey || ' from ' || l_suppkey AS step,
    CASE WHEN l_returnflag <> 'R' THEN 'qty ' || CAST(l_quantity AS BIGINT) END AS data FROM lineitem)) GROUP BY k
"""
_WHERE = ["project = 'P1' AND done", "sprint AND version = 'v1' AND title LIKE '%URGENT%'",
          "link = 'C-7' OR key IN ('O-1', 'O-2', 'C-5')"]


def _issues(queries: list[tuple[str, int, int]], parts: bool = True) -> str:
    """Rows of the issue queries (target, run_ord, query number)."""
    one = " UNION ALL ".join(
        f"SELECT '{t}' AS crawl_target, {r} AS run_ord, {q} AS q, * FROM i WHERE {_WHERE[q]}" for t, r, q in queries)
    return f"""
SELECT m.*, 'jira-cloud ' || key || '.html' AS filename,
  'gs://corpus-bucket/' || crawl_target || '/jira-cloud ' || key || '.html' AS uri,
  'https://corp.example.com/browse/' || key AS web_url, '[' || key || '] ' || title AS shown,
  concat_ws({_NL2}, 'Issue Key: ' || key, 'Issue Type: ' || kind, 'Title: ' || title, 'Project Name: Project ' || project,
    'Created Time: ' || made, 'Updated Time: ' || made, 'Epic: ' || epic, 'Story Points: ' || points,
    'Description: ' || chr(10) || description)
  || CASE WHEN q = 0 THEN coalesce(steps, '') ELSE '' END || CASE WHEN q <> 1 THEN coalesce(comments, '') ELSE '' END AS body
FROM (WITH i AS ({_STORY} UNION ALL {_EPIC}) {one}) m
LEFT JOIN ({_COMMENTS}) c ON m.k = c.k LEFT JOIN ({_STEPS}) s ON m.k = s.k
"""


def _epics(projects: list[tuple[str, int, str]]) -> str:
    conf = ", ".join(f"('{t}', {r}, '{p}')" for t, r, p in projects)
    return f"""
SELECT t.crawl_target, t.run_ord, e.key, e.made, 'jira-cloud ' || e.key || '.html' AS filename,
  'gs://corpus-bucket/' || t.crawl_target || '/jira-cloud ' || e.key || '.html' AS uri,
  'https://corp.example.com/browse/' || e.key AS web_url, '[' || e.key || '] Epic: ' || e.title AS shown,
  'Epic ID: ' || e.key || chr(10) || 'Epic Title: ' || e.title || chr(10) || '=====' || chr(10)
  || 'Listing of User Stories:' || chr(10) || chr(10) || l.listing AS body
FROM (VALUES {conf}) t(crawl_target, run_ord, project) JOIN ({_EPIC}) e ON e.project = t.project
JOIN (SELECT link, project, string_agg(key || ': ' || title || ' [Last Updated On: ' || made || ']' || chr(10), ''
        ORDER BY made DESC, key) AS listing FROM ({_STORY}) WHERE done GROUP BY link, project) l
  ON l.link = e.key AND l.project = e.project
"""


def _epic_parts(projects: list[tuple[str, int, str]], part_bytes: int) -> str:
    """Records of the epics, and their documents cut by byte offsets."""
    whole = _epics(projects)
    line = "key || ': ' || title || ' [Last Updated On: ' || made || ']' || chr(10)"
    return f"""
WITH e AS ({whole}),
s AS (SELECT link, project, made, key, {line} AS line FROM ({_STORY}) WHERE done),
o AS (SELECT *, coalesce(sum(strlen(line)) OVER (PARTITION BY link, project ORDER BY made DESC, key
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {part_bytes} AS cell FROM s),
p AS (SELECT o.link, CAST(1 + cell AS INTEGER) AS part, string_agg(line, '' ORDER BY o.made DESC, o.key) AS text
      FROM o JOIN ({_EPIC}) x ON x.key = o.link AND x.project = o.project GROUP BY o.link, cell)
SELECT 'record' AS kind, crawl_target, CAST(run_ord AS INTEGER) AS run_ord, filename, concat_ws('|', key, shown, web_url, made, uri) AS value,
  CAST(NULL AS INTEGER) AS part FROM e
UNION ALL SELECT 'document', crawl_target, CAST(run_ord AS INTEGER), filename, p.text, p.part FROM e JOIN p ON p.link = e.key
UNION ALL SELECT 'document', crawl_target, CAST(run_ord AS INTEGER), filename,
  substr(body, 1, position('Stories:' IN body) + 9), 0 FROM e
"""


_PAGES = """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, lang AS title, doc_id % 19 <> 0 AS current, s.key AS space, s.name AS space_name,
  coalesce(text, '') || CASE WHEN doc_id % 2 = 0 THEN '<ri:attachment ri:filename="part-' || doc_id || '.pdf" />' ELSE '' END AS body
FROM documents JOIN (SELECT n_nationkey, 'S' || n_nationkey AS key, n_name AS name FROM nation
  WHERE n_regionkey <> 4 AND n_nationkey % 6 <> 5) s ON doc_id % 25 = n_nationkey
"""
_BELOW = """
WITH RECURSIVE r(id) AS (SELECT 2::BIGINT UNION SELECT d.doc_id FROM r JOIN documents d ON d.doc_id > 0 AND d.doc_id // 4 = r.id)
SELECT id FROM r WHERE id <> 9
"""
_CRAWLS = {"spaces": "current AND space IN ('S3', 'S7')", "pages": f"doc_id IN ({_BELOW})", "all": "current"}


def _wiki(crawls: list[tuple[str, int, str]]) -> tuple[str, str]:
    """(pages, attachments) of the crawls."""
    chosen = " UNION ALL ".join(
        f"SELECT '{t}' AS crawl_target, {r} AS run_ord, '{c}' AS crawl, * FROM p WHERE {_CRAWLS[c]}" for t, r, c in crawls)
    pages = f"SELECT *, 'confluence-cloud ' || space || ' ' || id || '.html' AS filename FROM (WITH p AS ({_PAGES}) {chosen})"
    atts = f"""
SELECT c.crawl_target, c.run_ord, p_partkey AS part, 'confluence-cloud ' || space || ' f' || p_partkey || '.pdf' AS filename
FROM ({pages}) c JOIN part ON p_partkey = doc_id
WHERE doc_id % 2 = 0 AND p_partkey % 3 <> 0 AND p_partkey % 14 <> 0
  AND NOT (crawl = 'all' AND starts_with(CAST(p_partkey AS VARCHAR), '1'))
"""
    return pages, atts


def _rows(issues: str | None = None, epics: str | None = None, wiki: tuple[str, str] | None = None) -> str:
    parts = []
    for x in (issues, epics):
        if x:
            parts += [f"SELECT 'document' AS kind, crawl_target, run_ord, filename, md5(body) AS value FROM ({x})",
                      f"SELECT 'record' AS kind, crawl_target, run_ord, filename, concat_ws('|', key, shown, web_url, made, uri) AS value FROM ({x})"]
    if wiki:
        pages, atts = wiki
        parts += [
            f"SELECT 'document' AS kind, crawl_target, run_ord, filename, md5(coalesce(title, '') || {_NL2} || body) AS value FROM ({pages})",
            f"""SELECT 'record' AS kind, crawl_target, run_ord, filename, concat_ws('|', id, title,
  'https://corp.example.com/wiki/spaces/' || space || '/pages/' || id, '2024-02-02',
  'gs://corpus-bucket/' || crawl_target || '/' || filename) AS value FROM ({pages})""",
            f"""SELECT 'record' AS kind, crawl_target, run_ord, filename, concat_ws('|', 'a' || part, 'part-' || part || '.pdf',
  'https://corp.example.com/wiki/pages/' || part, '2024-03-03',
  'gs://corpus-bucket/' || crawl_target || '/' || filename) AS value FROM ({atts})"""]
    return "SELECT kind, crawl_target, CAST(run_ord AS INTEGER) AS run_ord, filename, value FROM (" + " UNION ALL ".join(parts) + ")"


_DECODED = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
for _name, _char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
    _DECODED = f"replace({_DECODED}, '{_name}', '{_char}')"

_WEB = f"""
WITH RECURSIVE p AS (SELECT page_id AS id, {_DECODED} AS title, html || '<a href=''../a/./../p/' || (4 * page_id + 1)
    || '''>x</a><a href=''/p/' || (4 * page_id + 2) || '?q=/a/../b''>x</a><a href=''HTTPS://W.example.com:443/p/'
    || (4 * page_id + 3) || '''>x</a>' AS body FROM pages),
c AS (SELECT * FROM (VALUES ('team-a', 3, true), ('team-b', 0, false), ('team-c', 2, false)) c(crawl_target, hops, bans)),
r(crawl_target, id, hop) AS (
  SELECT * FROM (VALUES ('team-a', 0::BIGINT, 0), ('team-a', 2, 0), ('team-a', 5, 0), ('team-b', 0, 0), ('team-b', 7, 0),
                        ('team-b', -1, 0), ('team-c', 1, 0)) s(crawl_target, id, hop)
  UNION
  SELECT r.crawl_target, 4 * r.id + n, r.hop + 1 FROM r JOIN c USING (crawl_target) JOIN p ON p.id = r.id,
    (VALUES (1), (2), (3)) k(n)
  -- a link with a query does not end in 9, but its page does
  WHERE r.hop < c.hops AND NOT (c.bans AND (lower(p.title) LIKE '%nicht%' OR (4 * r.id + n) % 10 = 9))),
v AS (SELECT crawl_target, id, min(hop) AS hop FROM r GROUP BY ALL),
u AS (SELECT *, 'https://w.example.com/p/' || CASE WHEN id < 0 THEN 'x' ELSE CAST(id AS VARCHAR) END AS url FROM v),
d AS (SELECT u.*, p.title, p.body FROM u JOIN p USING (id) JOIN c USING (crawl_target)
      WHERE NOT (c.bans AND lower(p.title) LIKE '%nicht%'))
SELECT 'document' AS kind, crawl_target, md5(body) AS value FROM d
UNION ALL SELECT 'record', crawl_target,
  concat_ws('|', md5(url), title, url || CASE WHEN id % 7 = 0 THEN '#z' ELSE '' END, '2024-05-05') FROM d
UNION ALL SELECT 'missing', crawl_target, concat_ws('|', md5(url),
  CASE WHEN id % 4 = 2 AND hop > 0 THEN url || '?q=/a/../b' ELSE url END, CAST(hop AS VARCHAR))
FROM u WHERE id NOT IN (SELECT id FROM p)
"""

_THREE = [("team-a", 0, 0), ("team-b", 1, 1), ("team-b", 2, 2)]

SQL: dict[str, str] = {
    "issue_job": _rows(issues=_issues(_THREE)),
    "epic_job": _epic_parts([("team-a", 0, "P0"), ("team-a", 1, "P1"), ("team-b", 2, "P1")], 200),
    "wiki_job": _rows(wiki=_wiki([("team-a", 0, "spaces"), ("team-b", 2, "pages"), ("team-c", 3, "all")])),
    "web_job": _WEB,
    # precedence counts from 1 in the order of the configuration
    "targets_job": _rows(
        issues=_issues([("team-a", 1, 0), ("team-b", 5, 1), ("team-b", 6, 2)]),
        epics=_epics([("team-a", 2, "P0"), ("team-a", 3, "P1"), ("team-b", 7, "P1")]),
        wiki=_wiki([("team-a", 4, "spaces"), ("team-b", 8, "pages")])),
    "catalog_job": f"""
SELECT crawl_target, filename, CAST(max(run_ord) AS INTEGER) AS run_ord, any_value(key) AS id, any_value(shown) AS title,
  any_value(web_url) AS web_url, any_value(uri) AS uri FROM ({_issues(_THREE)}) GROUP BY crawl_target, filename
""",
}
