from pyspark.sql import functions as F

from quire.functions.html import attachment_refs, href_list, page_title
from quire.functions.urls import normalize_url, resolve_href, url_id, wiki_page_url


def test_wiki_page_url(spark):
    df = spark.createDataFrame([("/spaces/AB/pages/12/Title",), ("/spaces/~me/pages/12/T",), ("/spaces/AB/overview",),
                                (None,)], "l string")
    got = [r[0] for r in df.select(wiki_page_url("https://b", "l")).collect()]
    assert got == ["https://b/wiki/spaces/AB/pages/12", "https://b/spaces/~me/pages/12/T",
                   "https://b/spaces/AB/overview", "https://b"]


def test_normalize_url_variants_share_id(spark):
    df = spark.createDataFrame([("https://Ex.com/a?x=1",), ("https://ex.com:443/a#f",), ("https://u:p@ex.com/a",),
                                ("http://ex.com",)], "u string")
    rows = df.select(normalize_url("u").alias("n"), url_id("u").alias("i")).collect()
    assert [r.n for r in rows] == ["https://ex.com/a"] * 3 + ["http://ex.com/"]
    assert len({r.i for r in rows[:3]}) == 1


def test_resolve_href(spark):
    base = "https://ex.com/dir/page.html?q=1#top"
    hrefs = ["/abs", "rel/x", "../up", "./same", "?k=2", "#frag", "//cdn.ex.com/j", "http://o.org/p", "mailto:a@b",
             ""]
    df = spark.createDataFrame([(h, base) for h in hrefs], "h string, b string")
    got = [r[0] for r in df.select(resolve_href("h", "b")).collect()]
    assert got == ["https://ex.com/abs", "https://ex.com/dir/rel/x", "https://ex.com/up", "https://ex.com/dir/same",
                   "https://ex.com/dir/page.html?k=2", None, "https://cdn.ex.com/j", "http://o.org/p", None, None]


def test_page_title_edge_rows(spark):
    pages = ["<html><p>no title</p></html>", "<title></title>", "<TITLE>A &amp; B &quot;c&quot;</TITLE>",
             "<script>var s='<title>x</title>'</script><title>real</title>",
             "<!-- <title>old</title> --><title>new</title>", "<title lang=en> sp </title><title>2nd</title>"]
    df = spark.createDataFrame([(h,) for h in pages], "h string")
    got = [r[0] for r in df.select(page_title("h")).collect()]
    assert got == ["No title", "", 'A & B "c"', "real", "new", " sp "]


def test_href_list_order_and_duplicates(spark):
    html = ('<a href="/a">1</a><A HREF=\'/b\'>2</A><a class=x href=/a>3</a>'
            '<script>document.write("<a href=/no>")</script><a name=x>no href</a><a href="/p?x=1&amp;y=2">')
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(href_list("h")).first()[0] == ["/a", "/b", "/a", "/p?x=1&y=2"]


def test_attachment_refs_keep_escaping(spark):
    body = '<ri:attachment ri:filename="A &amp; B.pdf" /><ri:attachment ri:filename="c.docx" />'
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(attachment_refs(F.col("b"))).first()[0] == ["A &amp; B.pdf", "c.docx"]


def test_unclosed_elements_run_to_the_end(spark):
    pages = ["<title>open title", "<!-- open comment <title>hidden</title>", "<script>x<title>no</title>",
             "<title>a</title><!-- x"]
    df = spark.createDataFrame([(h,) for h in pages], "h string")
    got = [r[0] for r in df.select(page_title("h")).collect()]
    assert got == ["open title", "No title", "No title", "a"]


def test_attachment_filters_case_and_media_type(spark):
    from quire.operators import wiki
    rows = [("1", "Report.PDF", "application/pdf"), ("2", "report draft.pdf", "application/pdf"),
            ("3", "SECRET plan.docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
            ("4", "Secret plan.docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
            ("5", "photo.png", "image/png"),
            ("6", "deck.pptx", "application/vnd.openxmlformats-officedocument.presentationml.presentation")]
    df = spark.createDataFrame(rows, "id string, title string, mediaType string")
    got = {r.id: r.ext for r in wiki.allowed_attachments(df, ["SECRET", "(?i)draft"]).collect()}
    # "SECRET" is case-sensitive (4 stays), "(?i)draft" is not; png is not an allowed media type
    assert got == {"1": "pdf", "4": "docx", "6": "pptx"}


def test_numeric_entities_out_of_range_do_not_fail(spark):
    from quire.functions.html import decode_entities
    vals = ["&#65;&#x263A;", "&#0;", "&#55296;", "&#1114112;", "&#x110000;", "&#xD800;", "a&amp;#39;b"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(decode_entities(F.col("x"))).collect()]
    assert got == ["A☺", "�", "�", "�", "�", "�", "a&#39;b"]


def test_dot_segments_and_references(spark):
    from quire.functions.html import decode_entities
    from quire.functions.urls import normalize_url, resolve_href
    base = "http://h/a/b/c/d/e"
    want = {"../../../../x": "http://h/x", "../../../../../../x": "http://h/x", "/x?u=/a/../b": "http://h/x?u=/a/../b",
            "/x/.": "http://h/x/", "/a/b/..": "http://h/a/", "./y": "http://h/a/b/c/d/y", "HTTP://EX.com": "http://ex.com/",
            "https://Ex.com:443/a/../b?q#f": "https://ex.com/b?q#f", "/..x/.y": "http://h/..x/.y"}
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(h, base) for h in want], "h string, b string")
    assert {r.h: r.x for r in rows.select("h", resolve_href(F.col("h"), F.col("b")).alias("x")).collect()} == want
    one = spark.createDataFrame([("http://h/a/../b",)], "u string").select(normalize_url(F.col("u")).alias("x")).first().x
    assert one == "http://h/b"
    refs = {"&#99999999;": "�", "&#00000065;": "A", "&#38;amp;": "&amp;", "&#150;": "–", "&eacute;&Auml;": "éÄ",
            "&bogus; &": "&bogus; &", "&#x1F98A;": "🦊", "&amp;lt;": "&lt;", "&#0;": "�"}
    got = spark.createDataFrame([(k,) for k in refs], "t string").select("t", decode_entities(F.col("t")).alias("x")).collect()
    assert {r.t: r.x for r in got} == refs
