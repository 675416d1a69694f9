"""Randomised checks against direct models of the reference semantics."""

import random
import re

from pyspark.sql import functions as F

from quire.functions.text import JS_WS_CHARS, sanitize_filename, truncate_filename
from quire.plans.graph import closure

JS_WS = set(JS_WS_CHARS)


def js_sanitize(s: str) -> str:
    """The reference steps, evaluated as JavaScript would."""
    s = re.sub(r'[<>:"/\\|?*\x00-\x1f]', " ", s)
    lead = len(s) - len(s.lstrip("."))           # ^(?:\.*|\s*): \.* is tried first and always matches
    s = " " + s[lead:]
    for p in range(len(s) + 1):                  # (?:\.*|\s*)$: leftmost position, first match only
        rest = s[p:]
        if all(c == "." for c in rest) or all(c in JS_WS for c in rest):
            s = s[:p] + " "
            break
    s = re.sub("[ \xa0]+", " ", s)
    return s.strip(JS_WS_CHARS)


def js_truncate(full: str) -> str:
    if len(full) <= 255:
        return full
    ext = full.split(".")[-1]
    return full[: 255 - len(ext) - 1] + "." + ext


ALPHABET = ["a", "b", "Z", ".", ".", " ", " ", "\xa0", "\t", "\n", " ", "﻿", "　", "<", "?", "/",
            "\\", "|", "*", "\x01", "\x1f", "é", "😀", "-", ":"]


def test_sanitize_matches_model_on_random_strings(spark):
    rnd = random.Random(11)
    vals = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = {r.i: r.o for r in df.select("i", sanitize_filename("s").alias("o")).collect()}
    bad = [(vals[i], got[i], js_sanitize(vals[i])) for i in range(len(vals)) if got[i] != js_sanitize(vals[i])]
    assert not bad, bad[:5]


def test_truncate_matches_model(spark):
    rnd = random.Random(5)
    vals = ["".join(rnd.choice("ab.😀") for _ in range(rnd.randint(240, 270))) + ".html" for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = {r.i: r.o for r in df.select("i", truncate_filename(F.col("s")).alias("o")).collect()}
    assert all(got[i] == js_truncate(v) for i, v in enumerate(vals))


def test_closure_is_idempotent(spark):
    rnd = random.Random(9)
    pairs = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(120)]
    e = spark.createDataFrame(pairs, "src long, dst long")
    seeds = spark.createDataFrame([(1,), (2,)], "id long")
    once = closure(e, seeds)
    twice = closure(e, once)
    assert sorted(r.id for r in once.collect()) == sorted(r.id for r in twice.collect())


def _py_norm(u: str) -> str:
    from urllib.parse import urlsplit
    p = urlsplit(u)
    scheme, host = p.scheme.lower(), (p.hostname or "")
    port = p.port
    default = {"http": 80, "https": 443}.get(scheme)
    origin = f"{scheme}://{host}" + (f":{port}" if port is not None and port != default else "")
    return origin + (p.path or "/")


def test_normalize_url_matches_model_on_random_urls(spark):
    from quire.functions.urls import normalize_url
    rnd = random.Random(17)
    def one():
        scheme = rnd.choice(["http", "https", "HTTP", "Https"])
        cred = rnd.choice(["", "user@", "u:p@"])
        host = rnd.choice(["Example.COM", "a.b.example.org", "X.io"])
        port = rnd.choice(["", ":80", ":443", ":8080"])
        path = rnd.choice(["", "/", "/a/b", "/A%20b/c.html", "/x/"])
        query = rnd.choice(["", "?q=1", "?a=b&c=d"])
        frag = rnd.choice(["", "#top", "#a?b"])
        return f"{scheme}://{cred}{host}{port}{path}{query}{frag}"
    urls = [one() for _ in range(500)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    got = {r.i: r.n for r in df.select("i", normalize_url("u").alias("n")).collect()}
    bad = [(u, got[i], _py_norm(u)) for i, u in enumerate(urls) if got[i] != _py_norm(u)]
    assert not bad, bad[:5]
