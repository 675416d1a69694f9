"""Wiki spaces, pages and attachments (L1): S6-S10, C1-C5, J1, J2, J6, P21."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.html import attachment_refs, decode_entities
from quire.functions.text import file_name
from quire.operators.filters import literal_frame, none_match

# File-name prefix of wiki items, attachment media types that
# become documents (extension, media type), page document = title + blank line + body.
SOURCE_PREFIX = "confluence-cloud"
ALLOWED_MEDIA_TYPES = [
    ("pdf", "application/pdf"),
    ("docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    ("pptx", "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
]
PAGE_TITLE_SEP = "\n\n"


def listed_spaces(spaces: DataFrame) -> DataFrame:
    """The space listing keeps global spaces in status current."""
    return spaces.where((F.col("type") == "global") & (F.col("status") == "current"))


def target_spaces(spaces: DataFrame, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Spaces whose key is one of the crawl target's keys."""
    return spaces.join(keys, spaces["key"] == keys[key_col], "left_semi")


def pages_in_spaces(pages: DataFrame, spaces: DataFrame) -> DataFrame:
    """S7 + J1: pages (status current) with the key and name of their space.
    ``spaces`` is a listing (small by nature); the join strategy is left to
    the planner / AQE, which broadcasts it only when its size is known small."""
    s = spaces.select(F.col("id").alias("_space_id"), F.col("key").alias("space_key"),
                      F.col("name").alias("space_name"))
    return pages.join(s, pages["spaceId"] == s["_space_id"], "inner").drop("_space_id")


def pages_without_space(pages: DataFrame, spaces: DataFrame) -> DataFrame:
    """J1 quarantine: pages whose space is not in the listing."""
    return pages.join(spaces.select(F.col("id").alias("_space_id")),
                      pages["spaceId"] == F.col("_space_id"), "left_anti")


def page_body(title, body) -> F.Column:
    """The page document = title, blank line, storage body."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(PAGE_TITLE_SEP), F.coalesce(body, F.lit("")))


def page_file_name(space_key, item_id, ext: str = "html") -> F.Column:
    """P12 for wiki pages and attachments: ``confluence-cloud <space> <id>``."""
    return file_name(F.concat_ws(" ", F.lit(SOURCE_PREFIX), space_key, item_id), ext)


def referenced_names(pages: DataFrame, page_id: str = "id", body: str = "body",
                     decode_refs: bool = False) -> DataFrame:
    """(page id, referenced attachment file name), distinct. Names are
    compared still HTML-escaped unless ``decode_refs``."""
    refs = pages.select(F.col(page_id).alias("_page"), F.explode(attachment_refs(body)).alias("_name"))
    if decode_refs:
        refs = refs.withColumn("_name", decode_entities("_name"))
    return refs.distinct()


def referenced_attachments(attachments: DataFrame, pages: DataFrame, page_id: str = "id",
                           body: str = "body", decode_refs: bool = False) -> DataFrame:
    """C5 + J2: attachments of crawled pages whose title is referenced in
    the page body (left semi join on page id and name)."""
    refs = referenced_names(pages, page_id, body, decode_refs)
    cond = (attachments["pageId"] == refs["_page"]) & (attachments["title"] == refs["_name"])
    return attachments.join(refs, cond, "left_semi")


def allowed_attachments(attachments: DataFrame, banned_patterns: Sequence[str] = ()) -> DataFrame:
    """C3 + C4 + P8: drop banned titles, keep allowed media types and add
    their extension (inner join with the broadcast allow-list)."""
    spark = attachments.sparkSession
    allow = literal_frame(spark, ALLOWED_MEDIA_TYPES, "ext string, _media string")
    kept = attachments.where(none_match("title", banned_patterns))
    return kept.join(allow, kept["mediaType"] == allow["_media"], "inner").drop("_media")


def attachment_sweep(attachments: DataFrame, pages: DataFrame, page_id: str = "id") -> DataFrame:
    """Every allowed attachment of a crawled page, without the body
    reference test."""
    on_pages = attachments.join(pages.select(F.col(page_id).alias("_page")),
                                attachments["pageId"] == F.col("_page"), "left_semi")
    return allowed_attachments(on_pages)
