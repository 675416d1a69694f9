"""Every registered driver query against its DuckDB SQL on sf0.001 (the
driver repeats this at sf0.01)."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck

from quire.analogues import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql()
    assert name in sql
    info = compare(spark, con, name, entry.queries()[name], sql[name], SF)
    assert info["ok"], info


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_id", "id", "title", "filename", "uri"]
    assert df.count() > 0


def test_link_resolution_parity_on_relative_links(spark, tmp_path):
    import pandas as pd

    from quire import analogues

    html = ('<a href="rel/x">a</a><a href="../up">b</a><a href="./same">c</a><a href="?k=2">d</a>'
            '<a href="/a/./b/../c">e</a><a href="//cdn.x/j">f</a><a href="#f">g</a><a href="mailto:x@y">h</a>'
            "<a href='/the'>i</a><A HREF=/q?x=1&amp;y=2>j</A>")
    pdf = pd.DataFrame({"page_id": [1, 2], "url": ["https://Ex.com:443/dir/page.html?q=1#t", "http://h.org"],
                        "html": [html, '<a href="x/../y">k</a>']})
    pdf.to_parquet(tmp_path / "pages.parquet")
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet')")
    info = compare(spark, con, "page_links", analogues.page_links, entry.oracle_sql()["page_links"], str(tmp_path))
    assert info["ok"] and info["spark_rows"] == 8, info
