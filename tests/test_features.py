"""Pointer jumping, cursor chains, offset coverage, pattern tables and
query indexes against plain Python."""

import random
import re

import pytest

from quire.operators import patterns, predicates
from quire.plans import graph, pointers
from quire.sources import landed


def counted_tables(monkeypatch, module):
    calls = []
    real = module.shared_table
    monkeypatch.setattr(module, "shared_table", lambda spark, df: calls.append(1) or real(spark, df))
    return calls


def test_long_chain_in_few_rounds(spark, monkeypatch):
    n = 3000
    order = list(range(n))
    random.Random(3).shuffle(order)
    calls = counted_tables(monkeypatch, pointers)
    df = spark.createDataFrame([(order[i], order[i - 1] if i else None) for i in range(n)], "id long, before long")
    got = {r.id: (r.head, r.position) for r in pointers.rank_chains(df).collect()}
    assert got == {x: (order[0], i) for i, x in enumerate(order)} and len(calls) <= 14
    calls.clear()
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "src long, dst long")
    seeds = spark.createDataFrame([(order[1000],)], "id long")
    assert {r.id for r in pointers.below(edges, seeds).collect()} == set(order[1000:]) and len(calls) <= 20


def test_below_equals_closure(spark):
    rng = random.Random(8)
    for n, m in ((12, 14), (40, 44)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(None, 1), (1, None), (3, 3)]
        e = spark.createDataFrame(edges, "src long, dst long")
        s = spark.createDataFrame([(rng.randrange(n),), (n + 5,), (None,)], "id long")
        assert sorted(r.id for r in pointers.below(e, s).collect()) == sorted(r.id for r in graph.closure(e, s).collect())
    assert pointers.below(e.limit(0), s.limit(0)).count() == 0


def test_cursor_chains(spark):
    rows = [("a1", "a2"), ("a2", "a3"), ("a3", None), ("b1", "b2"), ("b2", "gone"), ("c1", "c2"), ("c2", "c3"), ("c3", "c1"),
            ("d1", "d1"), ("m1", "t"), ("m2", "t"), ("t", None), ("a2", "a3"), (None, "x"), ("s", None), ("u", "a1x")]
    got = {r.p: (r.chain, r.position, r.state) for r in landed.cursor_chains(
        spark.createDataFrame(rows, "p string, n string"), "p", "n").collect()}
    assert got == {"a1": ("a1", 0, "ok"), "a2": ("a1", 1, "ok"), "a3": ("a1", 2, "ok"), "b1": ("b1", 0, "ok"), "b2": ("b1", 1, "broken"),
                   "c1": (None, None, "cycle"), "c2": (None, None, "cycle"), "c3": (None, None, "cycle"), "d1": (None, None, "cycle"),
                   "m1": ("m1", 0, "ok"), "m2": ("m2", 0, "ok"), "t": ("m1", 1, "merged"), "s": ("s", 0, "ok"), "u": ("u", 0, "broken")}


def plain_coverage(rows):
    out = []
    for q in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == q]
        total = max((r[3] for r in own if r[3] is not None), default=0)
        own = [r for r in own if r[1] is not None and r[2] is not None and r[1] < r[2]]
        last = None
        for at in range(min([0, *(r[1] for r in own)]), max([total, *(r[2] for r in own)])):
            times, due = sum(r[1] <= at < r[2] for r in own), 0 <= at < total
            kind = "missing" if due and not times else "beyond" if times and not due else "repeated" if times > 1 else None
            if kind and last and last[4] == kind and last[3] == times and last[2] == at:
                last[2] = at + 1
            elif kind:
                last = [q, at, at + 1, times, kind]
                out.append(last)
            else:
                last = None
    return sorted(map(tuple, out), key=str)


def test_offset_coverage(spark):
    rng = random.Random(2)
    rows = []
    for q in ("hot", "hot", "a", "b", None):
        for _ in range(60 if q == "hot" else 8):
            a = rng.randrange(400 if q == "hot" else 60)
            rows.append((q, a, a + rng.choice([0, 1, 5, 10, 50]), rng.choice([50, 300])))
    rows += [("null", None, 3, 7), ("none", 0, 0, 0), ("whole", 0, 9, 9), ("x", 2, 4, None)]
    df = spark.createDataFrame(rows, "request string, start long, stop long, total long")
    got = landed.offset_coverage(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_coverage(rows)
    assert landed.offset_coverage(df.limit(0)).count() == 0


PATTERNS = ["alpha", "(?i)ALPHA", "al.*ga", "be+ta", "gam?ma", "delta{2}", "[xyz]silon", r"zeta\d+", "eta|theta", "(iota)+", "ka", "^lambda$", "mu{0,2}nu xi",
            r"\Qa.b\E", "", "omi\\.cron", "pi rho", ".", "(?s)sig.ma", "x*yz w", "(?x) a l p h a", "a{3}bc", "tau?upsilon phi"]


def test_required_literals(spark):
    df = spark.createDataFrame([(p,) for p in PATTERNS], "p string")
    got = {r.p: r.l for r in df.select("p", patterns.required_literal("p").alias("l")).collect()}
    assert got["al.*ga"] is None and got["(?i)ALPHA"] == "alpha" and got["mu{0,2}nu xi"] == "nu xi" and got["omi\\.cron"] == "cron"
    assert got["eta|theta"] is None and got[r"\Qa.b\E"] is None and got["(?x) a l p h a"] is None and got["[xyz]silon"] == "silon"
    assert got["tau?upsilon phi"] == "upsilon phi" and got["a{3}bc"] is None


def test_pattern_table(spark):
    rng = random.Random(1)
    words = "alpha ALPHA beta beeta gama gamma deltaa xsilon zeta12 theta iota lambda munu xi nu muunu omi.cron pi rho sigXma yz w aaabc a.b upsilon phi".split()
    texts = [(i, rng.choice([None, "", "lambda", " ".join(rng.choices(words, k=rng.randint(1, 8)))])) for i in range(120)]
    df = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc long, body string, p int")
    pats = spark.createDataFrame([(i, p) for i, p in enumerate(PATTERNS)] + [(99, None)], "pid long, re string")
    py = {p: p.replace(r"\Qa.b\E", r"a\.b").replace("(?x) a l p h a", "alpha") for p in PATTERNS}
    want = {(i, k) for i, t in texts if t is not None for k, p in enumerate(PATTERNS) if re.search(py[p], t)}
    found = patterns.matches(df, "doc", "body", pats, "pid", "re")
    got = [(r.doc, r.pid) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()


def test_query_index(spark):
    from pyspark.sql import functions as F
    rng = random.Random(5)
    rows = [(i, rng.choice([None, "F", "O", "P"]), rng.choice(["a", "b", None]), rng.choice([None, 1.0, 5.0, 9.0])) for i in range(200)]
    queries = [(k, [("status", rng.choice(["F", "O", "Z"])), *([("kind", rng.choice(["a", "b"]))] if k % 2 else [])] * (1 + k % 3 // 2),
                None if k % 4 else [("price", rng.choice([None, 2.0]), rng.choice([None, 6.0]))]) for k in range(30)]
    queries += [(50, [], None), (51, [("status", None)], None), (52, [("other", "F")], None), (53, [("status", "F")], [("nothing", 0.0, 1.0)]), (54, None, None)]
    want = set()
    for k, equal, within in queries:
        for i, status, kind, price in rows:
            have = {"status": status, "kind": kind}
            if equal and all(v is not None and have.get(f) == v for f, v in equal) and all(
                    f == "price" and price is not None and (lo is None or lo <= price) and (hi is None or price <= hi) for f, lo, hi in within or ()):
                want.add((k, i))
    df = spark.createDataFrame(rows, "id long, status string, kind string, price double")
    found = predicates.answers(df, "id", {"status": F.col("status"), "kind": F.col("kind")}, {"price": F.col("price")},
                               spark.createDataFrame(queries, predicates.QUERY))
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)


def test_query_index_with_frequent_values(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(predicates, "SLICE_ROWS", 10, raising=False)
    rows = [(i, "F" if i % 3 else "O", f"c{i % 90}", float(i % 7)) for i in range(300)]
    queries = [(1, [("status", "F")], None), (2, [("status", "F")], [("price", 2.0, None)]), (3, [("status", "O"), ("customer", "c3")], None),
               (4, [("status", "O"), ("status", "F")], None), (5, [("customer", "c4")], [("price", None, 3.0)])]
    want = {(q, i) for q, equal, within in queries for i, st, c, p in rows
            if all({"status": st, "customer": c}[f] == v for f, v in equal) and all((lo is None or lo <= p) and (hi is None or p <= hi) for _, lo, hi in within or ())}
    df = spark.createDataFrame(rows, "id long, status string, customer string, price double")
    found = predicates.answers(df, "id", {"status": F.col("status"), "customer": F.col("customer")}, {"price": F.col("price")},
                               spark.createDataFrame(queries, predicates.QUERY))
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    # the 200 rows of F meet their queries in slices, and no group holds them all
    assert "slice" in found._jdf.queryExecution().optimizedPlan().toString()


def test_counts_at_every_grain(spark):
    from quire.plans.catalog import counts_at
    rows = [("t", "s", sp, pg, w) for sp in ("A", "B", None) for pg in ("1", None) for w in ("page", "link") for _ in range(3)] + [(None, "s", "A", "1", "page")]
    df = spark.createDataFrame(rows, "target string, source string, space string, page string, what string")
    grains = {"target": ["target"], "source": ["target", "source"], "space": ["target", "source", "space"], "page": ["target", "source", "page"]}
    got = {(r.grain, r.target, r.source, r.space, r.page, r.what): r.n for r in counts_at(df, "what", grains).collect()}
    want = {}
    for r in rows:
        have = dict(zip(("target", "source", "space", "page"), r))
        for g, cols in grains.items():
            if have[cols[-1]] is not None:
                k = (g, *(have[c] if c in cols else None for c in have), r[4])
                want[k] = want.get(k, 0) + 1
    assert got == want


def test_lexer_stays_linear(spark):
    from quire.functions.html import decode_entities, href_list, page_title
    pages = ["<a " * 100_000, "<" * 300_000, '<a href="' * 50_000, "<!--" * 100_000, "<script>" * 60_000, "<title" * 80_000, "<p x='" + "<a href=/no>" * 40_000,
             "<b c=d>" * 60_000 + "<title>t</title><a href=/y>" + "&amp" * 60_000, "&" * 300_000, "<a " + "x=y " * 100_000 + "href=/z>"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = {r.i: (r.t, r.l) for r in df.select("i", page_title("h").alias("t"), href_list("h").alias("l")).collect()}
    assert got[7] == ("t", ["/y"]) and got[9] == ("No title", ["/z"]) and got[6] == got[0] == ("No title", [])
    assert df.select(decode_entities("h").alias("d")).where("i = 8").first().d == pages[8]


@pytest.mark.parametrize("attribute", [False, True])
def test_references_against_the_library(spark, attribute):
    import html
    from html.entities import html5

    from quire.functions.html import decode_entities
    rng = random.Random(4)
    names = rng.sample(sorted(html5), 400)
    cases = [f"a&{n}{rng.choice(['', ';', ' ', '1', 'x;', '&'])}b" for n in names] + ["&#65", "&#x41;&#x41g", "&#;", "&#x;", "&;", "&amp;amp;"]
    got = {r.t: r.d for r in spark.createDataFrame([(c,) for c in cases], "t string").select("t", decode_entities("t", attribute).alias("d")).collect()}
    if not attribute:
        assert got == {c: html.unescape(c) for c in cases}
    else:
        assert got["&#x41;&#x41g"] == "AAg" and all(got[c] == html.unescape(c) for c in cases if re.fullmatch(r"a&\w+;b", c) and c[2:-2] + ";" in html5)
        assert [decoded for c, decoded in got.items() if re.fullmatch(r"a&\w+b", c)] == [c for c in got if re.fullmatch(r"a&\w+b", c)]
