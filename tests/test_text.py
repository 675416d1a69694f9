from pyspark.sql import functions as F

from quire.functions.text import file_name, js_number, sanitize_filename, truncate_filename


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_sanitize_edge_rows(spark):
    vals = ["..a?b..", " ..a.. ", "a .. ", "...", "a   b", "name ", "a\x01b\x1fc",
            'x<y>z:"/\\|?*', "  lead", "trail.  ", ".", "end\u2028", "\xa0\xa0nb\xa0 sp\xa0"]
    got = _one(spark, sanitize_filename, vals)
    assert got == ["a b", "..a..", "a ..", "", "a b", "name", "a b c", "x y z", "lead", "trail.", "", "end", "nb sp"]


def test_truncate_lengths(spark):
    s255 = "a" * 250 + ".html"
    s256 = "a" * 251 + ".html"
    emoji = "\U0001F600" * 300 + ".pdf"
    got = _one(spark, truncate_filename, [s255, s256, emoji])
    assert got[0] == s255
    assert got[1] == "a" * 250 + ".html" and len(got[1]) == 255
    assert got[2] == "\U0001F600" * 251 + ".pdf"


def test_file_name_composes(spark):
    got = _one(spark, lambda c: file_name(c, "html"), ["jira-cloud PRJ-1", "web ab/cd ..x.."])
    assert got == ["jira-cloud PRJ-1.html", "web ab cd ..x.html"]


def test_js_number(spark):
    assert _one(spark, js_number, [3.0, 2.5, 0.0], "double") == ["3", "2.5", "0"]


def test_js_regex_literals():
    from quire.operators.filters import js_regex
    assert js_regex("/.*office 20.*/i") == "(?i).*office 20.*"
    assert js_regex("/.*TIMES.*(\\.pdf)/") == ".*TIMES.*(\\.pdf)"
    assert js_regex("https://support\\.example\\.com/.*") == "https://support\\.example\\.com/.*"
    assert js_regex("/a/gmi") == "(?mi)a"
