"""Web pages (L3): identity, title, links and the page document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.html import href_list, page_title
from quire.functions.text import file_name
from quire.functions.urls import normalize_url, resolve_hrefs
from quire.operators.filters import allow_match, any_match, none_match

# File-name prefix of web pages.
SOURCE_PREFIX = "web"


def identify_pages(pages: DataFrame, url: str = "url") -> DataFrame:
    """P14 + P15: normalised URL and md5 document id of each landed page."""
    return pages.withColumn("norm_url", normalize_url(url)).withColumn("id", F.md5(F.col("norm_url")))


def with_titles(pages: DataFrame, html: str = "html", banned_title_patterns: Sequence[str] = ()) -> DataFrame:
    """P16 + C7 flag: page title and whether it hits a banned pattern."""
    t = pages.withColumn("title", page_title(html))
    return t.withColumn("title_banned", F.coalesce(any_match("title", banned_title_patterns), F.lit(False)))


def page_facts(pages: DataFrame, html: str = "html", banned_title_patterns: Sequence[str] = ()) -> DataFrame:
    """One pass over the HTML: title, banned-title flag and the href list
    (P16, C7, P17) next to the other columns; the HTML itself is dropped,
    so what follows (the crawl) works on narrow rows."""
    facts = pages.select(*[c for c in pages.columns if c != html], page_title(html).alias("title"), href_list(html).alias("hrefs"))
    return facts.withColumn("title_banned", F.coalesce(any_match("title", banned_title_patterns), F.lit(False)))


def links_from_hrefs(df: DataFrame, key: str, url: str, hrefs: str, regex: str | None = None,
                     banned_url_patterns: Sequence[str] = ()) -> DataFrame:
    """P17 + C8 + C6 over an href list: one row per anchor (key, pos,
    link, norm) in document order, duplicates kept; ``pos`` is the 0-based
    anchor position, ``norm`` the link's normalised URL. Links must match
    ``regex`` and none of the banned patterns (tested on the full URL).
    Links are resolved inside the generator: filters behind it read them
    and never compute them again."""
    exploded = df.select(key, F.posexplode_outer(resolve_hrefs(hrefs, url)).alias("pos", "_l"))
    links = exploded.select(key, F.col("pos").cast("int").alias("pos"), "_l.link", "_l.norm")
    return links.where(F.col("link").isNotNull() & allow_match("link", regex)
                       & none_match("link", banned_url_patterns))


def page_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
               regex: str | None = None, banned_url_patterns: Sequence[str] = ()) -> DataFrame:
    """P17 + C8 + C6 straight from the HTML of each page."""
    return links_from_hrefs(pages.select(key, url, href_list(html).alias("_hrefs")), key, url, "_hrefs",
                            regex, banned_url_patterns).drop("norm")


def web_file_name(doc_id, title) -> F.Column:
    """P12 for web pages: ``web <md5> <title>.html``."""
    return file_name(F.concat_ws(" ", F.lit(SOURCE_PREFIX), doc_id, title), "html")
