"""Whole texts of pages whose containers, articles and copies are unusual."""

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import pages


def extracted(spark, rows):
    got = pages.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in got}


def test_articles_inside_containers(spark):
    boxes = ["<div class='site has-sidebar'>", "<div class='container no-sidebar'>", "<div class='content-sidebar-wrap'>",
             "<div id='search-result-page'>", "<div class='elementor-widget'>", "<form action='x.aspx'>", "<div class='widget'>"]
    text = "the text of the article is here"
    rows = [(i, f"http://{i}.com/", f"<body>{b}<article><div class='entry-header'><h1>Head</h1></div><p>{text}</p>"
             "<div class='share'>tweet</div></article></body>") for i, b in enumerate(boxes)]
    teaser = "<body><article><p>teaser</p></article><div><p>a body of many more words than the teaser has</p></div><nav><p>menu</p></nav></body>"
    menu = "<body><nav><article>menu item</article></nav><main>" + text + "<div class='related'><article>other</article></div></main></body>"
    by = extracted(spark, [*rows, (50, "http://t.com/", teaser), (51, "http://m.com/", menu)])
    assert [by[i] for i in range(len(boxes))] == [f"Head {text}"] * len(boxes)
    assert by[50] == "teaser a body of many more words than the teaser has"
    assert by[51] == text


def test_boilerplate_of_a_host(spark):
    line = " ".join(f"w{i}" for i in range(12))
    quote = " ".join(f"q{i}" for i in range(12))
    rows = [(i, "http://b.com/x", f"<body><p>{line}</p><p>own text number {i} stays here</p><p>about us</p></body>") for i in range(6)]
    rows += [(10 + i, "http://b.com/y", f"<body><p>first {i} says {quote}</p></body>") for i in range(2)]
    rows += [(20 + i, "http://c.com/", f"<body><p>{line}</p></body>") for i in range(6)] + [(30, "http://c.com/z", "<p>another page</p>")]
    body = " ".join(f"c{i}" for i in range(60))
    rows += [(40 + i, "http://n.com/", f"<body><p>{body} n{i}</p></body>") for i in range(5)]
    rows += [(60 + i, "http://t.com/", f"<body><article>{line}</article><p>{body} t{i}</p></body>") for i in range(4)]
    by = extracted(spark, rows)
    assert [by[i] for i in range(6)] == [f"own text number {i} stays here" for i in range(6)]
    assert [by[10 + i] for i in range(2)] == [f"first {i} says {quote}" for i in range(2)]
    assert {by[20 + i] for i in range(6)} == {line} and by[30] == "another page"          # copies count once
    assert [by[40 + i] for i in range(5)] == [f"{body} n{i}" for i in range(5)]           # near copies stay
    assert [by[60 + i] for i in range(4)] == [f"{line} t{i}" for i in range(4)]           # an article's own text stays
