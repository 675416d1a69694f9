"""URLs as a browser's URL class reads them, against literals and the
Punycode of the standard library."""

import random

from pyspark.sql import functions as F

from quire.functions.urls import normalize_url, punycode, resolve_href, url_id

# (url, origin + pathname); None: refused
URLS = [
    ("http://h/a b/é", "http://h/a%20b/%C3%A9"), ("http://h/a/%2e%2e/x", "http://h/x"), ("http://h/a/.%2E/x/%2e", "http://h/x/"),
    ("http://BÜCHER.de/", "http://xn--bcher-kva.de/"), ("http://h:080/p", "http://h/p"), ("https://h:00443/p", "https://h/p"),
    ("https://h:0080/p", "https://h:80/p"), ("http://h:65536/", None), ("http://h:8a/", None), ("http://h:/x", "http://h/x"),
    ("  http://h/a\tb\nc \x01", "http://h/abc"), ("http:\\\\h\\a\\..\\b", "http://h/b"), ("http:h/x", "http://h/x"), ("http:////h/x", "http://h/x"),
    ("http://u:p@q@h/x", "http://h/x"), ("http://0x7f.1/", "http://127.0.0.1/"), ("http://3232235777/", "http://192.168.1.1/"),
    ("http://010.0.0.1/", "http://8.0.0.1/"), ("http://1.2.3.4.5/", None), ("http://1.2.3.256/", None), ("http://256/", "http://0.0.1.0/"),
    ("http://4294967296/", None), ("http://a.08/", None), ("http://1.2.3./", "http://1.2.0.3/"), ("http://h.1a/", "http://h.1a/"),
    ("http://%41.com/", "http://a.com/"), ("http://b%C3%BCcher.de/", "http://xn--bcher-kva.de/"), ("http://%ff.de/", None),
    ("http://a b/", None), ("http:///", None), ("http://a%23b/", None), ("http://日本。jp/x", "http://xn--wgv71a.jp/x"),
    ("http://faß.de/", "http://xn--fa-hia.de/"), ("http://[::1]:8080/x", "http://[::1]:8080/x"), ("http://h/%zz%", "http://h/%zz%"),
    ("http://h/\"<>`{}|'~!$&()*+,;=:@", "http://h/%22%3C%3E%60%7B%7D|'~!$&()*+,;=:@"), ("http://h/🦊", "http://h/%F0%9F%A6%8A"),
    ("http://h?q", "http://h/"), ("http://h#f", "http://h/"), ("HTTPS://H.Example:443", "https://h.example/"), ("mailto:a@b", None), ("no url", None),
    ("http://h/..", "http://h/"), ("http://h/a/../../b/./c/", "http://h/b/c/"), ("http://h/..a/.b", "http://h/..a/.b"), ("http://h//a//../b", "http://h//a/b"),
]
BASE = "http://Ex.com:080/d\u00efr/sub/page.html?q=1#top"
HREFS = [
    ("/a b?c d'#é \"", "http://ex.com/a%20b?c%20d%27#%C3%A9%20%22"), ("x/%2E%2e/y", "http://ex.com/d%C3%AFr/sub/y"), ("\\\\Ö.de\\z", "http://xn--nda.de/z"),
    ("http:rel", "http://ex.com/d%C3%AFr/sub/rel"), ("https:other.org/x", "https://other.org/x"), ("?é", "http://ex.com/d%C3%AFr/sub/page.html?%C3%A9"),
    ("../../../up", "http://ex.com/up"), ("//cdn.ex.com", "http://cdn.ex.com/"), ("javascript:void(0)", None), ("#x", None), (" \n", None),
    ("http://h:99999/", None), ("/x?", "http://ex.com/x?"), ("a:b", None), ("./a:b", "http://ex.com/d%C3%AFr/sub/a:b"), ("/%", "http://ex.com/%"),
]


def test_identity(spark):
    df = spark.createDataFrame([(u,) for u, _ in URLS] + [(None,)], "u string")
    got = df.select(normalize_url("u").alias("n"), url_id("u").alias("i")).collect()
    assert [r.n for r in got] == [n for _, n in URLS] + [None]
    assert all((r.i is None) == (r.n is None) for r in got)


def test_hrefs(spark):
    df = spark.createDataFrame([(h, BASE) for h, _ in HREFS], "h string, b string")
    assert [r[0] for r in df.select(resolve_href("h", "b")).collect()] == [x for _, x in HREFS]
    nulls = spark.createDataFrame([(None, BASE), ("/x", None), ("/x", "no url")], "h string, b string")
    assert [r[0] for r in nulls.select(resolve_href("h", "b")).collect()] == [None, None, None]


def test_punycode_against_the_library(spark):
    rng = random.Random(5)
    alphabet = "abcz09-éüßñ\u0430\u4e2d\u65e5\u3042\U0001f98a\u07ff\ufb00"
    labels = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 18))) for _ in range(400)]
    labels = [x for x in labels if not x.isascii()] + ["é" * 60, "ü" + "a" * 60, "a" * 60 + "\U0010ffff"]
    got = spark.createDataFrame([(x,) for x in labels], "x string").select("x", punycode(F.col("x")).alias("p")).collect()
    assert {r.x: r.p for r in got} == {x: x.encode("punycode").decode() for x in labels}


def test_long_urls_stay_linear(spark):
    long = ["http://h/" + "a/../" * 20_000 + "x", "http://h/" + "é" * 50_000, "http://h" + "/" * 100_000, "http://" + "a@" * 50_000 + "h/", "h" * 200_000]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in long], "u string").select(normalize_url("u")).collect()]
    assert got == ["http://h/x", "http://h/" + "%C3%A9" * 50_000, long[2], "http://h/", None]
