"""Texts on which a careless pattern nests, or scans again and again."""

import time

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import pages, secrets


def test_secret_segments(spark):
    long = "a1b2c3d4e5f6g7h8i9." * 55_000
    short = "x a1b2c3d4e5f6g7h8i9.a1b2c3d4e5f6g7h8i9== y"
    df = spark.createDataFrame([(1, long), (2, "p1" * 500_000), (3, short), (4, "-----BEGIN PRIVATE KEY-----" + "Ab1+/\n" * 150_000)],
                               "doc_id long, text string")
    found = {(r.doc_id, r.start): r.value for r in secrets.scan(spark, df).select("doc_id", "start", "value").collect()}
    assert found[1, 0] == long[:-1] and found[2, 0] == "p1" * 500_000
    assert found[3, 2] == "a1b2c3d4e5f6g7h8i9.a1b2c3d4e5f6g7h8i9==" and len(found[4, 0]) > 800_000
    masked = {r.doc_id: r.text for r in secrets.redact(spark, df).collect()}
    assert masked.keys() == {1, 2, 3, 4} and masked[1] in (long, "[SECRET].")


def test_unclosed_markup():
    started = time.monotonic()
    cases = {"<" + "a" * 1_000_000: None, "<a " * 300_000: None, '<a "' * 200_000: None, "<" * 1_000_000: None,
             "<div class=x>" * 30_000 + "</span></b>" * 50_000 + "end": "end", "<!--" * 250_000: "", "<p title='" + "<p>" * 300_000: None,
             '<a "' * 200_000 + ">x": "x", "<script>" * 100_000: "", "&" * 1_000_000: "&" * 1_000_000}
    for page, text in cases.items():
        got = " ".join(t for _, t in pages.blocks(page))
        assert text is None or got == text
    assert time.monotonic() - started < 20


def test_quotes_that_stay_open():
    text = lambda page: [t for _, t in pages.blocks(page)]
    assert text("<p title='a > b'>x</p><i title=\"<p>\">y</i>") == ["x", "y"]
    assert text("<p>a</p><a href=\"x>z</a> more") == ["a", "z more"]
    assert text("<p>a</p><b") == ["a", "<b"]
