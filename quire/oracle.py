"""DuckDB SQL for every driver query of :mod:`quire.analogues` (same
rows, same column names). Tables are the pre-registered test views."""

from __future__ import annotations

from quire import feature_oracle, job_oracle

# the configuration of the queries, and what the SQL expects of the test tables' pages, written again
BASE_URL, BUCKET = "https://corp.example.com", "corpus-bucket"
TITLE_BAN = ["(?i).*nicht.*"]
LINK_BAN = [r"/the$", r"(?i)/AND$"]
URL_BAN = [r"spam-farm\.", r"(?i)cheap-PILLS"]
_URL = r"^(?i)(https?)://([^/?#:@]*)(?::([0-9]*))?(/[^?#]*)?"
_WIKI = r"/spaces/[A-Za-z0-9_]+/pages/[0-9]+"


def _any(patterns) -> str:
    """The OR-ed pattern of quire.operators.filters.any_match, as a SQL literal."""
    return "'" + "|".join(f"(?:{p})" for p in patterns).replace("'", "''") + "'"

# JavaScript white space, RE2 syntax (same class as quire.functions.text)
_WS = r"[\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _sanitize(x: str) -> str:
    s1 = f"""regexp_replace({x}, '[<>:"/\\\\|?*\\x00-\\x1f]', ' ', 'g')"""
    s2 = f"regexp_replace({s1}, '\\A\\.+|\\.+\\z', ' ', 'g')"
    s3 = f"regexp_replace({s2}, '[ \\xA0]+', ' ', 'g')"
    return f"regexp_replace({s3}, '\\A{_WS}+|{_WS}+\\z', '', 'g')"


def _truncate(full: str) -> str:
    ext = f"split_part({full}, '.', -1)"
    return (f"CASE WHEN length({full}) > 255 THEN substr({full}, 1, 255 - length({ext}) - 1) || '.' || {ext} "
            f"ELSE {full} END")




def _origin(u: str) -> str:
    sch = f"lower(regexp_extract({u}, '{_URL}', 1))"
    host = f"lower(regexp_extract({u}, '{_URL}', 2))"
    port = f"regexp_extract({u}, '{_URL}', 3)"
    return (f"({sch} || '://' || {host} || CASE WHEN {port} = '' OR ({sch} = 'http' AND {port} = '80') "
            f"OR ({sch} = 'https' AND {port} = '443') THEN '' ELSE ':' || {port} END)")


def _encoded(x: str, kept: str) -> str:
    """Characters outside ``kept`` as %XX, one by one."""
    return (f"CASE WHEN regexp_matches({x}, '[^{kept}]') THEN array_to_string(list_transform(string_split({x}, ''), "
            f"lambda ch: CASE WHEN regexp_matches(ch, '^[{kept}]$') THEN ch ELSE url_encode(ch) END), '') ELSE {x} END")


_PATH_CHARS = r"A-Za-z0-9._~!$&''()*+,;=:@/%|\[\]^-"
_REST_CHARS = r"A-Za-z0-9._~!$&()*+,;=:@/%|\[\]^?{}`\\#-"


def _path(u: str) -> str:
    raw = f"regexp_extract({u}, '{_URL}', 4)"
    return f"(CASE WHEN {raw} = '' THEN '/' ELSE {_encoded(raw, _PATH_CHARS)} END)"


def _norm(u: str) -> str:
    return f"({_origin(u)} || {_path(u)})"


# the references that the test pages hold; &amp; is decoded last
_ENT = [("&quot;", '"'), ("&apos;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&middot;", "·"), ("&copy;", "©")]


def _decode(x: str) -> str:
    for e, c in _ENT:
        x = f"replace({x}, '{e}', '{c}')"
    return f"replace({x}, '&amp;', '&')"


def _title(h: str) -> str:
    found = f"regexp_extract({h}, '(?s)<title>(.*?)</title>', 1)"
    return f"CASE WHEN contains({h}, '<title>') THEN {_decode(found)} ELSE 'No title' END"




SQL: dict[str, str] = {}

SQL["url_identity"] = f"""
SELECT page_id, {_norm('url')} AS norm_url, md5({_norm('url')}) AS id FROM pages
"""

SQL["page_title"] = f"""
SELECT page_id, title FROM (SELECT page_id, {_title('html')} AS title FROM pages)
WHERE NOT coalesce(regexp_matches(title, {_any(TITLE_BAN)}), false)
"""



def _dots(x: str) -> str:
    """Dot-segment removal, same passes as quire.functions.urls."""
    x = f"regexp_replace({x}, '/(\\./)+', '/', 'g')"
    for _ in range(4):
        x = f"regexp_replace({x}, '/[^/?#]+/\\.\\.(/|$)', '/')"
    return f"regexp_replace({x}, '^/\\.\\.(/|$)', '/')"


_PAGE = "regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>', '', 'g')"
_QUOTED = """(?i)<a\\s+href=("[^"]*"|''[^'']*''|[^\\s>"'']+)"""
_HREFS = (f"list_transform(regexp_extract_all({_PAGE}, '{_QUOTED}', 1), "
          "lambda v: CASE WHEN v[1] IN (chr(34), chr(39)) THEN v[2:-2] ELSE v END)")


def _links(hrefs: str = _HREFS) -> str:
    """(page_id, pos, link) of the hrefs of a page."""
    rest = "regexp_extract(href, '([?#].*)?$', 1)"
    path = "regexp_extract(href, '^[^?#]*', 0)"
    of = lambda p: f"{_dots(_encoded(p, _PATH_CHARS))} || {_encoded(rest, _REST_CHARS)}"
    return f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, CASE
    WHEN href = '' OR starts_with(href, '#') THEN NULL
    WHEN regexp_matches(href, '(?i)^https?://') THEN {_norm('href')} || {_encoded(rest, _REST_CHARS)}
    WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN NULL
    WHEN starts_with(href, '//') THEN {_norm(f"(lower(regexp_extract(url, '{_URL}', 1)) || ':' || href)")} || {_encoded(rest, _REST_CHARS)}
    WHEN starts_with(href, '/') THEN {_origin('url')} || {of(path)}
    WHEN starts_with(href, '?') THEN {_norm('url')} || {_encoded('href', _REST_CHARS)}
    ELSE {_origin('url')} || {of(f"(regexp_extract({_path('url')}, '^(.*/)', 1) || {path})")} END AS link
FROM (SELECT page_id, url, trim({_decode('h')}) AS href, pos FROM (
  SELECT page_id, url, unnest({hrefs}) AS h, unnest(range(len({hrefs}))) AS pos FROM pages))
"""


SQL["page_links"] = f"""
SELECT page_id, pos, link FROM ({_links()})
WHERE link IS NOT NULL AND regexp_matches(link, '^https?://')
  AND NOT regexp_matches(link, {_any(LINK_BAN)})
"""

SQL["sanitize_filename"] = f"""
SELECT 'doc' AS kind, doc_id AS id, {_sanitize('text')} AS name FROM documents
UNION ALL
SELECT 'page' AS kind, page_id AS id, {_sanitize(_title('html'))} AS name FROM pages
"""

SQL["truncate_filename"] = f"""
WITH f AS (SELECT doc_id, {_truncate(f"({_sanitize('text')} || '.html')")} AS filename FROM documents)
SELECT doc_id, filename, split_part('gs://{BUCKET}/docs/' || filename, '/', -1) AS base FROM f
"""


SQL["web_url_canonical"] = f"""
WITH d AS (
  SELECT doc_id, CAST(doc_id % 25 AS VARCHAR) AS n, CAST(doc_id AS VARCHAR) AS sid, lang, source,
    CASE WHEN doc_id % 17 = 0 THEN NULL
         WHEN doc_id % 5 = 0 THEN '/spaces/S' || CAST(doc_id % 25 AS VARCHAR) || '/overview'
         WHEN doc_id % 3 = 0 THEN '/spaces/~S' || CAST(doc_id % 25 AS VARCHAR) || '/pages/' || CAST(doc_id AS VARCHAR) || '/T'
         ELSE '/spaces/S' || CAST(doc_id % 25 AS VARCHAR) || '/pages/' || CAST(doc_id AS VARCHAR) || '/' || lang END AS link
  FROM documents
)
SELECT doc_id,
  '{BASE_URL}' || CASE WHEN contains(coalesce(link, ''), '/pages/') AND regexp_matches(coalesce(link, ''), '{_WIKI}')
       THEN '/wiki' || regexp_extract(link, '{_WIKI}', 0) ELSE coalesce(link, '') END AS web_url,
  '{BASE_URL}/wiki/download/attachments/' || sid || '/' || source || '.pdf' AS download_url,
  '{BASE_URL}/browse/S' || n || '-' || sid AS issue_url
FROM d
"""

_SPACES = """
  SELECT CAST(n_nationkey AS VARCHAR) AS id, 'S' || CAST(n_nationkey AS VARCHAR) AS key, n_name AS name,
    CASE WHEN n_regionkey = 4 THEN 'personal' ELSE 'global' END AS type,
    CASE WHEN n_nationkey % 6 = 5 THEN 'archived' ELSE 'current' END AS status
  FROM nation
"""

SQL["space_key_filter"] = f"""
WITH s AS ({_SPACES})
SELECT d.doc_id, s.key FROM documents d JOIN s ON CAST(d.doc_id % 25 AS VARCHAR) = s.id
WHERE s.type = 'global' AND s.status = 'current' AND s.key IN ('S3', 'S7', 'S11', 'S4')
"""

SQL["page_space_join"] = f"""
WITH s AS (SELECT * FROM ({_SPACES}) WHERE type = 'global' AND status = 'current' AND id <> '13'),
p AS (SELECT doc_id, CAST(doc_id % 25 AS VARCHAR) AS space_id,
        md5(split_part(text, chr(10), 1) || chr(10) || chr(10) || text) AS body_md5 FROM documents)
SELECT p.doc_id, s.key AS space_key, s.name AS space_name,
  CASE WHEN s.id IS NULL THEN 'quarantine' ELSE 'ok' END AS status, p.body_md5
FROM p LEFT JOIN s ON p.space_id = s.id
"""

SQL["attachment_refs"] = """
WITH li AS (SELECT l_orderkey, l_partkey, l_linenumber,
  CASE WHEN l_partkey % 10 = 0 THEN 'part-' || CAST(l_partkey AS VARCHAR) || ' & co.pdf'
       ELSE 'part-' || CAST(l_partkey AS VARCHAR) || '.pdf' END AS title FROM lineitem),
refs AS (SELECT DISTINCT l_orderkey, replace(title, '&', '&amp;') AS name FROM li WHERE l_linenumber % 2 = 0)
SELECT DISTINCT li.l_orderkey AS orderkey, li.title AS name
FROM li JOIN refs ON li.l_orderkey = refs.l_orderkey AND li.title = refs.name
"""

_PART_MEDIA = """
  SELECT p_partkey, p_name, CASE p_type
    WHEN 'ECONOMY' THEN 'application/pdf'
    WHEN 'SMALL' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
    WHEN 'MEDIUM' THEN 'application/vnd.openxmlformats-officedocument.presentationml.presentation'
    WHEN 'PROMO' THEN 'image/png' WHEN 'STANDARD' THEN 'text/plain' WHEN 'LARGE' THEN 'application/zip' END AS media
  FROM part
"""
_ALLOW = """
  SELECT * FROM (VALUES ('pdf', 'application/pdf'),
    ('docx', 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'),
    ('pptx', 'application/vnd.openxmlformats-officedocument.presentationml.presentation')) t(ext, media)
"""

SQL["attachment_allowlist"] = f"""
SELECT p.p_partkey, a.ext FROM ({_PART_MEDIA}) p JOIN ({_ALLOW}) a ON p.media = a.media
"""

SQL["attachment_banned"] = """
SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, '(?:^small )|(?:(?i)GEAR$)')
"""

SQL["attachment_sweep"] = f"""
SELECT DISTINCT l.l_orderkey AS orderkey, l.l_partkey AS partkey, a.ext
FROM lineitem l JOIN ({_PART_MEDIA}) p ON l.l_partkey = p.p_partkey JOIN ({_ALLOW}) a ON p.media = a.media
WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
"""

SQL["child_page_closure"] = """
WITH RECURSIVE e AS (
  SELECT page_id // 4 AS src, page_id AS dst FROM pages WHERE page_id >= 1
  UNION ALL SELECT page_id // 3, page_id FROM pages WHERE page_id % 6 = 0 AND page_id > 0
  UNION ALL SELECT page_id, page_id // 16 FROM pages
  UNION ALL SELECT page_id, page_id FROM pages WHERE page_id % 13 = 0),
r(id) AS (SELECT * FROM (VALUES (2::BIGINT), (7::BIGINT)) s(id) UNION SELECT e.dst FROM r JOIN e ON e.src = r.id)
SELECT id FROM r WHERE id NOT IN (7, 9)
"""

SQL["bounded_crawl"] = f"""
WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages),
t AS (SELECT page_id, {_norm('url')} AS norm_url, {_title('html')} AS title FROM pages),
blocked AS (SELECT page_id FROM t WHERE regexp_matches(norm_url, {_any(URL_BAN)})),
stop AS (SELECT page_id FROM t WHERE coalesce(regexp_matches(title, {_any(TITLE_BAN)}), false)),
e AS (SELECT page_id AS src, (7 * page_id + 3) % n.n AS dst FROM pages, n
      UNION ALL SELECT page_id, (5 * page_id + 1) % n.n FROM pages, n),
r(id, hop) AS (
  SELECT s.id, 0 FROM (VALUES (0::BIGINT), (1::BIGINT)) s(id) WHERE s.id NOT IN (SELECT page_id FROM blocked)
  UNION
  SELECT e.dst, r.hop + 1 FROM r JOIN e ON e.src = r.id
  WHERE r.hop < 2 AND r.id NOT IN (SELECT page_id FROM stop) AND e.dst NOT IN (SELECT page_id FROM blocked))
SELECT id, CAST(min(hop) AS INTEGER) AS hop FROM r WHERE id NOT IN (SELECT page_id FROM stop) GROUP BY id
"""

SQL["custom_field_pick"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events
"""

SQL["nested_attachments"] = """
SELECT conv_id, count(*) AS n, string_agg(role || ':turn-' || CAST(turn AS VARCHAR) || '.txt', ',' ORDER BY turn) AS names
FROM conversations GROUP BY conv_id
"""

SQL["jql_done_stories"] = """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS rank
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_orderdate >= TIMESTAMP '1995-01-01'
"""

_NL2 = "chr(10) || chr(10)"

SQL["issue_document"] = f"""
WITH j AS (
  SELECT o.o_orderkey, 'O-' || CAST(o.o_orderkey AS VARCHAR) AS key, o.o_orderpriority AS issue_type,
    c.c_name AS title, n.n_name AS project,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 3 = 0 THEN []::VARCHAR[]
         WHEN o.o_orderkey % 3 = 1 THEN [c.c_mktsegment] ELSE [c.c_mktsegment, o.o_orderstatus] END AS labels,
    strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS created,
    strftime(o.o_orderdate, '%Y-%m-%d') || 'T12:00:00' AS updated,
    CASE WHEN o.o_custkey % 2 = 0 THEN 'C-' || CAST(o.o_custkey AS VARCHAR) ELSE '' END AS epic,
    (o.o_orderkey % 7) / 2.0 AS points,
    CASE WHEN o.o_orderkey % 4 = 0 THEN NULL WHEN o.o_orderkey % 9 = 0 THEN ''
         ELSE 'Order of ' || c.c_name || ' in ' || n.n_name || ' (' || o.o_orderstatus || ')' END AS description
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)
SELECT o_orderkey, '[' || key || '] ' || title AS title, '{BASE_URL}/browse/' || key AS url,
  concat_ws({_NL2},
    'Issue Key: ' || key, 'Issue Type: ' || issue_type, 'Title: ' || title, 'Project Name: ' || project,
    CASE WHEN len(labels) > 0 THEN 'Labels: ' || array_to_string(labels, ', ') END,
    'Created Time: ' || created, 'Updated Time: ' || updated,
    CASE WHEN epic <> '' THEN 'Epic: ' || epic END,
    CASE WHEN points <> 0 THEN 'Story Points: ' || regexp_replace(CAST(CAST(points AS DOUBLE) AS VARCHAR), '\\.0$', '') END,
    CASE WHEN coalesce(description, '') <> '' THEN 'Description: ' || chr(10) || description END) AS body
FROM j
"""

SQL["issue_comments_block"] = f"""
WITH c AS (
  SELECT conv_id, turn, 'Comment Number: ' || CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS VARCHAR)
    || {_NL2} || 'Comment Author: ' || coalesce(role, '') || {_NL2} || 'Comment Updated Time: turn ' || CAST(turn AS VARCHAR)
    || {_NL2} || 'Comment Body: ' || chr(10) || coalesce(text, '') AS elem
  FROM conversations
), b AS (
  SELECT conv_id, {_NL2} || 'Comments:' || chr(10) || '=====' || chr(10)
    || string_agg(elem, chr(10) || '=====' || chr(10) ORDER BY turn) || chr(10) || '=====' || chr(10) AS block
  FROM c GROUP BY conv_id
)
SELECT d.doc_id AS issue_id, coalesce(b.block, '') AS block FROM documents d LEFT JOIN b ON d.doc_id = b.conv_id
"""

_STEP_ORDER_SQL = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
                   "l_returnflag, l_linestatus, l_shipdate")

SQL["issue_steps_block"] = f"""
WITH s AS (
  SELECT l_orderkey, {_STEP_ORDER_SQL},
    'Ship part ' || CAST(l_partkey AS VARCHAR) || ' from ' || CAST(l_suppkey AS VARCHAR) AS step,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'qty ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS data,
    CASE WHEN l_linestatus = 'O' THEN '' ELSE 'status ' || l_linestatus END AS result
  FROM lineitem
), e AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_STEP_ORDER_SQL}) AS n, step, data, result
  FROM s
), x AS (
  SELECT l_orderkey, n, 'Test Number: ' || CAST(n AS VARCHAR) || {_NL2}
    || CASE WHEN coalesce(step, '') <> '' THEN 'Test Step: ' || chr(10) || step ELSE '' END || {_NL2}
    || CASE WHEN coalesce(data, '') <> '' THEN 'Test Data: ' || chr(10) || data ELSE '' END || {_NL2}
    || CASE WHEN coalesce(result, '') <> '' THEN 'Test Result: ' || chr(10) || result ELSE '' END AS elem
  FROM e
), b AS (
  SELECT l_orderkey, {_NL2} || 'Zephyr Tests Scenarios:' || chr(10) || '=====' || chr(10)
    || string_agg(elem, chr(10) || '===' || chr(10) ORDER BY n) || chr(10) || '=====' || chr(10) AS block
  FROM x GROUP BY l_orderkey
)
SELECT o.o_orderkey, coalesce(b.block, '') AS block FROM orders o LEFT JOIN b ON o.o_orderkey = b.l_orderkey
"""

SQL["epic_summary"] = """
WITH s AS (
  SELECT o_custkey, string_agg('O-' || CAST(o_orderkey AS VARCHAR) || ': ' || o_orderpriority
    || ' [Last Updated On: ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ']' || chr(10), ''
    ORDER BY o_orderdate DESC, o_orderkey) AS listing
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
)
SELECT c.c_custkey, '[C-' || CAST(c.c_custkey AS VARCHAR) || '] Epic: ' || c.c_name AS title,
  'Epic ID: C-' || CAST(c.c_custkey AS VARCHAR) || chr(10) || 'Epic Title: ' || c.c_name || chr(10) || '=====' || chr(10)
  || 'Listing of User Stories:' || chr(10) || chr(10) || s.listing AS body
FROM customer c JOIN s ON c.c_custkey = s.o_custkey
"""

_DOC_STEM = _sanitize("'confluence-cloud ' || source || ' ' || CAST(doc_id AS VARCHAR)")
_DOC_FILE = _truncate(f"({_DOC_STEM} || '.html')")

SQL["metadata_records"] = f"""
SELECT doc_id, CAST(to_json({{
  'id': CAST(doc_id AS VARCHAR),
  'structData': {{'title': text, 'spaceName': lang,
     'webUrl': '{BASE_URL}' || CASE WHEN regexp_matches('/spaces/' || source || '/pages/' || CAST(doc_id AS VARCHAR) || '/x', '{_WIKI}')
          THEN '/wiki' || regexp_extract('/spaces/' || source || '/pages/' || CAST(doc_id AS VARCHAR) || '/x', '{_WIKI}', 0)
          ELSE '/spaces/' || source || '/pages/' || CAST(doc_id AS VARCHAR) || '/x' END,
     'createdAt': '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00.000Z'}},
  'content': {{'mimeType': 'text/html', 'uri': 'gs://{BUCKET}/docs/' || {_DOC_FILE}}}
}}) AS VARCHAR) AS json
FROM documents
"""

SQL["target_union"] = f"""
WITH r AS (
  SELECT 'web' AS source, 'text/html' AS mime FROM pages
  UNION ALL SELECT 'confluence', 'text/html' FROM documents
  UNION ALL SELECT 'confluence', p.media FROM ({_PART_MEDIA}) p JOIN ({_ALLOW}) a ON p.media = a.media
  UNION ALL SELECT 'jira', 'text/html' FROM orders
), t AS (SELECT * FROM (VALUES ('web-a', 'web'), ('web-b', 'web'), ('wiki', 'confluence'), ('issues', 'jira'),
                               ('other', 'unknown')) t(crawl_target, source))
SELECT t.crawl_target, r.source, r.mime, count(*) AS n FROM r JOIN t ON r.source = t.source
GROUP BY t.crawl_target, r.source, r.mime
"""

SQL["catalog_upsert"] = """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY user_id
"""

SQL["document_overwrite"] = """
SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type
"""

SQL["attachment_first_wins"] = """
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type
"""

SQL["offset_page_audit"] = """
WITH r AS (SELECT o_orderkey, o_orderstatus,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM orders),
p AS (SELECT o_orderstatus, (rn - 1) // 50 AS page, count(*) AS n FROM r GROUP BY 1, 2),
t AS (SELECT o_orderstatus, count(*) AS total FROM orders GROUP BY 1),
l AS (SELECT p.o_orderstatus, p.page * 50 AS start_at, p.n, t.total FROM p JOIN t USING (o_orderstatus)
      WHERE p.page % 11 <> 10),
g AS (SELECT DISTINCT a.o_orderstatus FROM l a
      WHERE a.start_at + 50 < a.total
        AND NOT EXISTS (SELECT 1 FROM l b WHERE b.o_orderstatus = a.o_orderstatus AND b.start_at = a.start_at + 50)
      UNION SELECT o_orderstatus FROM l GROUP BY 1 HAVING min(start_at) > 0)
SELECT 'status=' || l.o_orderstatus AS request, count(*) AS pages, CAST(sum(l.n) AS BIGINT) AS rows, max(l.total) AS total,
  bool_or(g.o_orderstatus IS NOT NULL) AS has_gap
FROM l LEFT JOIN g USING (o_orderstatus) GROUP BY l.o_orderstatus
"""

SQL["cursor_page_audit"] = """
WITH m AS (SELECT max(event_id // 100) AS last FROM events),
p AS (SELECT DISTINCT event_id // 100 AS p FROM events),
l AS (SELECT '/events?page=' || CAST(p AS VARCHAR) AS request_path,
        CASE WHEN p < m.last THEN '/events?page=' || CAST(p + 1 AS VARCHAR) END AS next_link
      FROM p, m WHERE p % 7 <> 3)
SELECT request_path, next_link FROM l
WHERE next_link IS NOT NULL AND next_link NOT IN (SELECT request_path FROM l)
"""

SQL["purge_id_list"] = """
SELECT DISTINCT event_id AS id FROM events
"""

SQL["snapshot_diff"] = """
WITH p AS (SELECT doc_id, text FROM documents WHERE doc_id % 5 <> 0),
n AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN text || ' (edited)' ELSE text END AS text
      FROM documents WHERE doc_id % 7 <> 0)
SELECT coalesce(p.doc_id, n.doc_id) AS doc_id,
  CASE WHEN p.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete'
       WHEN p.text = n.text THEN 'same' ELSE 'update' END AS action
FROM p FULL OUTER JOIN n ON p.doc_id = n.doc_id
"""

SQL["upload_manifest"] = f"""
WITH m AS (SELECT doc_id, 'wiki-' || CAST(doc_id % 3 AS VARCHAR) AS crawl_target, {_DOC_FILE} AS filename FROM documents),
b AS (SELECT DISTINCT crawl_target, filename FROM m WHERE doc_id % 13 <> 0)
SELECT m.doc_id, m.filename, CASE WHEN b.filename IS NULL THEN 'missing_body' ELSE 'ready' END AS status
FROM m LEFT JOIN b ON m.crawl_target = b.crawl_target AND m.filename = b.filename
WHERE m.crawl_target IN ('wiki-0', 'wiki-1')
"""

SQL["epic_summary_hot_keys"] = """
WITH s AS (
  SELECT o_orderstatus AS status, o_orderdate, o_orderkey, 'O-' || CAST(o_orderkey AS VARCHAR) || ': ' || o_orderpriority
    || ' [Last Updated On: ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ']' || chr(10) AS line FROM orders
), o AS (
  SELECT *, coalesce(sum(strlen(line)) OVER (PARTITION BY status ORDER BY o_orderdate DESC, o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s
)
SELECT status, CAST(1 + before // 65536 AS INTEGER) AS part, string_agg(line, '' ORDER BY o_orderdate DESC, o_orderkey) AS text
FROM o GROUP BY status, before // 65536
UNION ALL
SELECT DISTINCT status, 0 AS part, 'Epic ID: ST-' || status || chr(10) || 'Epic Title: ' || status
  || chr(10) || '=====' || chr(10) || 'Listing of User Stories:' || chr(10) || chr(10) AS text FROM s
"""

SQL.update(job_oracle.SQL)
SQL.update(feature_oracle.sql(_links(), _PATH_CHARS))
