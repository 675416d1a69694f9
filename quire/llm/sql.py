"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

MIXING = r"""
WITH h AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
n AS (
  SELECT *, row_number() OVER (PARTITION BY source, doc_id, substr(digest, 1, 23)) - 1 AS nth FROM h),
d AS (
  SELECT doc_id, source, size,
         CAST('0x' || substr(CASE WHEN nth = 0 THEN digest ELSE
           md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS VARCHAR) || '|'
               || CAST(CAST('0x' || substr(digest, 9, 15) AS BIGINT) AS VARCHAR) || '|' || CAST(nth AS VARCHAR)) END, 1, 8) AS BIGINT) >> 16 AS bin
  FROM n),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
  FROM d GROUP BY source),
p AS (
  SELECT 3 * CAST(source_size AS DOUBLE) / weight AS ratio,
         (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY 3 * CAST(source_size AS DOUBLE) / weight, source
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 3 * CAST(source_size AS DOUBLE) / weight, source
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit
  FROM s),
t AS (
  SELECT source, source_size, least(weight * (SELECT coalesce(arg_min(unit, ratio), 0) FROM p WHERE unit <= ratio),
                                    3 * CAST(source_size AS DOUBLE)) AS target FROM s),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
m AS (
  SELECT b.source, b.bin, abs(b.past - (g.target - g.whole * g.source_size)) AS off, g.target - g.whole * g.source_size AS want
  FROM (SELECT source, bin, sum(sum(size)) OVER (PARTITION BY source ORDER BY bin) AS past FROM d GROUP BY source, bin) b
  JOIN g ON b.source IS NOT DISTINCT FROM g.source),
c AS (
  SELECT source, bin + 1 AS cut FROM m WHERE off < want
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, bin) = 1)
SELECT d.doc_id, d.size, g.source_size, g.target,
       d.size * (g.whole + CASE WHEN d.bin < coalesce(c.cut, 0) THEN 1 ELSE 0 END) AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN c ON c.source IS NOT DISTINCT FROM d.source
"""


def _crc32(codes: str) -> str:
    """The unsigned CRC-32 of a list of byte values, four bits a step."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    step = lambda x: f"xor(({x}) >> 4, list_extract({table}, (({x}) & 15) + 1))"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {step(step('xor(c, b)'))}), 4294967295)"


_ASCII = "list_transform(string_split({0}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
_LATIN1 = ("flatten(list_transform(string_split({0}, ''), lambda ch: CASE WHEN ord(ch) < 128 THEN [CAST(ord(ch) AS BIGINT)] "
           "ELSE [CAST(192 + (ord(ch) >> 6) AS BIGINT), CAST(128 + (ord(ch) & 63) AS BIGINT)] END))")


def _tree(name: str, leaves: str, height: int) -> str:
    """CTEs of a tree over ``leaves`` (tree, pos, digest): its levels, its
    tops, and for every node the siblings before and behind it on each
    level below the top."""
    out = [f"{name}0 AS MATERIALIZED (SELECT tree, pos, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(height):
        out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT tree, pos // 3 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(digest) "
                   f"ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest, (any_value(n) + 2) // 3 AS n "
                   f"FROM {name}{k} GROUP BY tree, pos // 3)")
        out.append(f"{name}r{k} AS MATERIALIZED (SELECT tree, pos // 3 AS run, list(digest ORDER BY pos) AS d FROM {name}{k} GROUP BY ALL)")
    return ",\n".join(out)


def _fold(name: str, rows: str, place: str, height: int) -> str:
    """CTEs that carry ``rows`` (tree, place, folded, proof) up a tree."""
    out, last = [], rows
    for k in range(height):
        at = f"x.{place} // {3 ** k}"
        before = f"array_to_string(list_slice(r.d, 1, ({at}) % 3), '')"
        after = f"array_to_string(list_slice(r.d, ({at}) % 3 + 2, 3), '')"
        out.append(f"{name}{k} AS MATERIALIZED (SELECT x.* EXCLUDE (folded, proof), x.proof || {before} || {after} AS proof, "
                   f"CASE WHEN l.n = 1 THEN x.folded ELSE sha256({before} || x.folded || {after}) END AS folded "
                   f"FROM {last} x JOIN {name[:1]}r{k} r ON r.tree = x.tree AND r.run = x.{place} // {3 ** (k + 1)} "
                   f"JOIN (SELECT DISTINCT tree, n FROM {name[:1]}{k}) l ON l.tree = x.tree)")
        last = f"{name}{k}"
    return ",\n".join(out)


def _merkle(leaf_levels: int = 13, source_levels: int = 6) -> str:
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    return f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({head} || {field('text')}) AS leaf,
         CASE WHEN {_crc32(_ASCII.format('CAST(doc_id AS VARCHAR)'))} % 2 = 0 THEN sha256({head} || {field("replace(text, chr(10), '')")}) END AS changed
  FROM documents),
i AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
{_tree('a', '(SELECT tree, pos, leaf AS digest FROM i)', leaf_levels)},
s AS MATERIALIZED (SELECT tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS place FROM a{leaf_levels}),
{_tree('b', "(SELECT '' AS tree, place AS pos, digest FROM s)", source_levels)},
x AS (SELECT doc_id, tree, pos, leaf, coalesce(changed, leaf) AS folded, '' AS proof FROM i),
{_fold('aup', 'x', 'pos', leaf_levels)},
y AS (SELECT u.doc_id, u.leaf, u.folded, u.proof, '' AS tree, s.place, s.digest AS subroot
      FROM aup{leaf_levels - 1} u JOIN s ON s.name = u.tree),
{_fold('bup', 'y', 'place', source_levels)}
SELECT z.doc_id, z.leaf, z.subroot, b.digest AS root, sha256(z.proof) AS proof_sha256, z.folded AS folded_root, z.folded = b.digest AS verified
FROM bup{source_levels - 1} z, b{source_levels} b
"""


REPEATS = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS MATERIALIZED (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
g AS MATERIALIZED (SELECT k.r, k.i, md5(array_to_string(list_slice(d.w, k.i, k.i + 34), ' ')) AS h FROM k JOIN d ON d.r = k.r),
c AS MATERIALIZED (SELECT DISTINCT r, unnest(range(i, i + 35)) AS at FROM g SEMI JOIN (SELECT h FROM g GROUP BY h HAVING count(*) > 1) USING (h)),
o AS (SELECT d.r, u.at, u.word FROM d, (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM d) u WHERE u.r = d.r),
t AS (SELECT o.r, string_agg(o.word, ' ' ORDER BY o.at) AS kept, count(*) AS n FROM o ANTI JOIN c ON c.r = o.r AND c.at = o.at GROUP BY o.r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(t.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM d LEFT JOIN t ON t.r = d.r
"""

SPELLING = rf"""
WITH RECURSIVE o AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
e AS (SELECT id, run, count(*) AS n FROM o WHERE length(run) >= 5 GROUP BY id, run),
h AS (SELECT run, n, {_crc32(_LATIN1.format("id || ':' || run"))} AS h FROM e),
v AS MATERIALIZED (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM h GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
x AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM x a JOIN v b ON a.less = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM x a JOIN v b ON a.less = b.word),
f AS MATERIALIZED (
  SELECT word, any_value(n) AS n, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS best, max(other_n) AS best_n FROM p GROUP BY word),
l AS MATERIALIZED (SELECT word, best AS form, best_n AS form_n FROM f WHERE best_n >= 2 * n),
c AS (SELECT word, form AS root, 1 AS depth FROM l UNION ALL SELECT c.word, l.form, c.depth + 1 FROM c JOIN l ON l.word = c.root)
SELECT v.word, l.form, coalesce(r.root, v.word) AS root, v.n, coalesce(f.n_near, 0) AS n_near, l.form_n
FROM v LEFT JOIN f ON f.word = v.word LEFT JOIN l ON l.word = v.word
LEFT JOIN (SELECT word, last(root ORDER BY depth) AS root FROM c GROUP BY word) r ON r.word = v.word
"""

SQL = {"op9_mixing": MIXING, "op11_merkle": _merkle(), "op12_repeats": REPEATS, "op13_spelling": SPELLING}
