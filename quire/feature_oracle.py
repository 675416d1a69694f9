"""DuckDB SQL of the queries in :mod:`quire.feature_queries`, written from
the expected behaviour; nothing is imported from the engine."""

from __future__ import annotations

_CLOSURE = """
WITH RECURSIVE c AS (
  SELECT doc_id AS src, lead(doc_id) OVER (ORDER BY lang NULLS FIRST, doc_id) AS dst FROM documents WHERE doc_id IS NOT NULL),
e AS (SELECT src, dst FROM c WHERE dst IS NOT NULL UNION
  SELECT a.doc_id, b.doc_id FROM documents a JOIN documents b ON b.doc_id = 40 * a.doc_id + 1),
r(id) AS (
  SELECT id FROM (SELECT min(doc_id) AS id FROM documents WHERE lang = 'fr' UNION SELECT 3 WHERE 3 IN (SELECT doc_id FROM documents)) WHERE id IS NOT NULL
  UNION SELECT e.dst FROM r JOIN e ON e.src = r.id)
SELECT id FROM r
"""

_CHAIN = """
WITH c AS (SELECT DISTINCT conv_id, turn, lpad(CAST(conv_id AS VARCHAR), 12, '0') AS name FROM conversations),
o AS (SELECT *, lag((conv_id, turn)) OVER w AS before, lead((conv_id, turn)) OVER w AS after,
             turn = max(turn) OVER (PARTITION BY conv_id) AS ends FROM c WINDOW w AS (ORDER BY conv_id, turn)),
l AS (SELECT *, coalesce(CASE WHEN ends THEN after = (conv_id + 1, 0) ELSE after = (conv_id, turn + 1) END, false) AS goes FROM o),
h AS (SELECT *, CASE WHEN coalesce(lag(goes) OVER (ORDER BY conv_id, turn), false) THEN 0 ELSE 1 END AS starts FROM l),
g AS (SELECT *, sum(starts) OVER (ORDER BY conv_id, turn) AS grp FROM h),
p AS (SELECT '/c/' || name || '?cursor=' || turn AS request_path, grp, goes, conv_id, turn FROM g)
SELECT request_path, first_value(request_path) OVER (PARTITION BY grp ORDER BY conv_id, turn) AS chain,
  CAST(row_number() OVER (PARTITION BY grp ORDER BY conv_id, turn) - 1 AS BIGINT) AS position,
  CASE WHEN goes THEN 'ok' ELSE 'broken' END AS state FROM p
"""

_COVERAGE = """
WITH r AS (
  SELECT 'conversation ' || conv_id AS request, CAST(turn AS BIGINT) AS pos FROM conversations
  UNION ALL SELECT 'order ' || l_orderkey, CAST(l_linenumber AS BIGINT) - 1 FROM lineitem),
a AS (SELECT request, unnest(range(0, max(pos) + 1)) AS pos FROM r GROUP BY request),
n AS (SELECT request, pos, count(*) AS times FROM r GROUP BY request, pos),
t AS (SELECT a.request, a.pos, coalesce(n.times, 0) AS times FROM a LEFT JOIN n ON n.request = a.request AND n.pos = a.pos),
i AS (SELECT *, pos - row_number() OVER (PARTITION BY request, times ORDER BY pos) AS island FROM t)
SELECT request, CAST(min(pos) AS BIGINT) AS first, CAST(max(pos) + 1 AS BIGINT) AS stop, CAST(times AS BIGINT) AS times,
  CASE WHEN times = 0 THEN 'missing' ELSE 'repeated' END AS kind
FROM i WHERE times <> 1 GROUP BY request, times, island
"""

_PATTERNS = r"""
WITH p AS (
  SELECT DISTINCT unnest(string_split(p_name, ' ')) AS pattern_id, '(?i)' || pattern_id AS pattern FROM part
  UNION ALL SELECT x, x FROM (VALUES ('^(?:The|Die) '), ('(?i)r[io]n?g '), ('x{3}'), ('\bgear\b|zzz')) v(x))
SELECT doc_id, pattern_id FROM documents, p WHERE regexp_matches(text, pattern)
"""

_QUERIES = """
SELECT c_custkey AS query_id, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey
WHERE o_totalprice BETWEEN c_acctbal AND c_acctbal + 200000
  AND coalesce(CASE c_mktsegment WHEN 'BUILDING' THEN o_orderstatus = 'F' WHEN 'MACHINERY' THEN o_orderstatus = 'O'
                 WHEN 'FURNITURE' THEN o_orderstatus = 'P' ELSE true END, false)
"""


def _counts(links: str) -> str:
    grains = {"target": 1, "source": 2, "space": 3, "issue": 4, "page": 5}
    out = []
    for grain, last in grains.items():
        cols = ["crawl_target", "source", "space", "issue", "page"]
        kept = [c for i, c in enumerate(cols, 1) if i <= min(last, 2) or i == last]
        shown = ", ".join(c if c in kept else f"CAST(NULL AS VARCHAR) AS {c}" for c in cols)
        out.append(f"SELECT '{grain}' AS grain, {shown}, what, count(*) AS n FROM s WHERE {cols[last - 1]} IS NOT NULL GROUP BY {', '.join(kept)}, what")
    return f"""
WITH s AS (
  SELECT 'docs' AS crawl_target, 'wiki' AS source, lang AS space, NULL AS issue, CAST(doc_id AS VARCHAR) AS page, 'page' AS what FROM documents
  UNION ALL SELECT 'docs', 'web', NULL, NULL, CAST(page_id AS VARCHAR), 'link' FROM ({links}) WHERE link IS NOT NULL
  UNION ALL SELECT 'issues', 'tracker', NULL, 'O-' || conv_id, NULL, 'comment' FROM conversations
  UNION ALL SELECT 'issues', 'tracker', NULL, 'O-' || l_orderkey, NULL, 'step' FROM lineitem)
{" UNION ALL ".join(out)}
"""


# what the hosts of the query are in ASCII, in its order
_HOSTS = ["xn--bcher-kva.de", "xn--mnchen-3ya.example", "xn--wgv71a.jp", "127.0.0.1", "192.168.1.1", "xn--bcher-kva.de", "xn--fa-hia.de:443",
          "h.example", None]


def _url_class(kept: str) -> str:
    hosts = "[" + ", ".join("NULL" if h is None else f"'{h}'" for h in _HOSTS) + "]"
    title = "regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '[?#/\\\\\\t\\n\\r]', '', 'g')"
    part = (f"array_to_string(list_transform(string_split({title}, ''), lambda ch: CASE WHEN regexp_matches(ch, '^[{kept}]$') THEN ch "
            "ELSE url_encode(ch) END), '')")
    return f"""
SELECT page_id, norm_url, md5(norm_url) AS id FROM (
  SELECT page_id, 'http://' || list_extract({hosts}, page_id % {len(_HOSTS)} + 1) || '/' || {part} || '/x/%C3%A9' AS norm_url FROM pages)
"""


_LINKS = """
SELECT page_id, CAST(pos AS INTEGER) AS pos, 'http://h.example' || path || rest AS link, md5('http://h.example' || path) AS id FROM (
  SELECT page_id, unnest([0, 1, 2, 3]) AS pos,
    unnest(['/x' || page_id, '/y' || page_id, '/z' || page_id, '/%C3%A9%20b' || page_id || '/%C3%A9']) AS path,
    unnest(['', '', '?copy=1&copy=2&lt=3&notit;&ltx', '']) AS rest FROM pages)
"""

_TITLES = """
SELECT page_id, 'A & B ✓ ¬it; ¬in <xAB≂̸&bogus;&' || page_id AS title, 'a&copy=1©&copyx&' AS value FROM pages
"""


_SNAPSHOT = """
WITH p AS (SELECT doc_id, text FROM documents WHERE doc_id % 5 <> 0),
n AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN text || ' (edited)' ELSE text END AS text FROM documents WHERE doc_id % 7 <> 0)
SELECT coalesce(p.doc_id, n.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete'
  WHEN p.text IS NOT DISTINCT FROM n.text THEN 'same' ELSE 'update' END AS action
FROM p FULL JOIN n ON n.doc_id = p.doc_id
"""

_LISTS = """
SELECT '/c/' || conv_id || '?page=' || (turn // 16) AS request_path, CAST(turn AS BIGINT) AS turn, role, md5(text) AS text_md5 FROM conversations
"""

_DOCUMENTS = """
SELECT lang AS crawl_target, doc_id || '.html' AS filename, CAST(length(body) AS INTEGER) AS size, md5(body) AS body_md5
FROM (SELECT *, CASE WHEN lang = 'en' THEN text || '!' ELSE text END AS body FROM documents) WHERE lang IS NOT NULL AND (lang <> 'en' OR length(text) > 1000)
"""

_BY_KEY = """
SELECT 'O-' || o_orderkey AS key, o_orderpriority || ' order' AS title, CASE WHEN o_orderstatus = 'F' THEN 'Done' ELSE 'Open' END AS status,
  'https://corp.example.com/browse/O-' || o_orderkey AS web_url
FROM orders WHERE o_orderkey IN (SELECT conv_id FROM conversations)
"""

_STREAM = """
SELECT user_id, event_id, event_type FROM (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
WHERE event_type <> 'error'
"""

_UPLOADS = """
WITH d AS (SELECT doc_id, 'docs-' || lang AS crawl_target, lang, doc_id || '.html' AS filename, coalesce(length(text), 0) > 300 AS body FROM documents),
l AS (SELECT d.*, row_number() OVER (PARTITION BY lang ORDER BY n * 1000000000 - doc_id) AS seq FROM d, (VALUES (0), (1)) v(n) WHERE lang = 'en')
SELECT crawl_target, 'gcp' AS destination, CASE lang WHEN 'de' THEN 'store-de' END AS store_id,
  CAST(row_number() OVER (PARTITION BY lang ORDER BY filename) AS BIGINT) AS seq, filename, CAST(NULL AS VARCHAR) AS title, 'ready' AS status
FROM d WHERE body AND lang IN ('de', 'fr')
UNION ALL SELECT crawl_target, 'dify', 'store-en', CAST(seq AS BIGINT), filename, 'Title ' || doc_id,
  CASE WHEN body THEN 'ready' ELSE 'missing_body' END FROM l
"""


def sql(links: str, path_chars: str) -> dict[str, str]:
    """``links``: SQL of all resolved links of the pages; ``path_chars``:
    the characters that stay in a path."""
    return {"document_snapshot": _DOCUMENTS, "landed_lists": _LISTS, "issue_by_key": _BY_KEY, "snapshot_tree": _SNAPSHOT, "catalog_stream": _STREAM, "upload_order": _UPLOADS, "deep_closure": _CLOSURE, "cursor_chain": _CHAIN, "offset_coverage": _COVERAGE, "pattern_table": _PATTERNS, "query_index": _QUERIES,
            "run_counts": _counts(links), "url_class": _url_class(path_chars), "link_lexer": _LINKS, "title_decode": _TITLES}
