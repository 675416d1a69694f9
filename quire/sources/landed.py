"""Landed API responses (S1-S5): envelope unpacking and pagination
coverage audits. Responses are read with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.ordering import prefix_sums
from quire.plans.pointers import rank_chains
from quire.session import shared_table


def unpack(responses: DataFrame, results: str = "results", keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the response's result list; a missing
    or empty list gives no rows."""
    return responses.select(*keep, F.explode(F.col(results)).alias("item")).select(*keep, "item.*")


def offset_pages(responses: DataFrame) -> DataFrame:
    """has_next = startAt + maxResults < total; next start = that sum,
    else total."""
    nxt = F.col("startAt") + F.col("maxResults")
    has_next = nxt < F.col("total")
    return responses.withColumn("has_next", has_next).withColumn(
        "next_start_at", F.when(has_next, nxt).otherwise(F.col("total")))


def offset_audit(responses: DataFrame, request: str = "request", items: str = "issues") -> DataFrame:
    """S4 + U2 audit: per request the landed pages, rows and total, and
    whether a page is missing (the first page, or a page a landed page
    points to). The narrow page table (one row per landed page, no items)
    is checkpointed once and read three times, all keyed by request (a hot
    request is spread by its page starts in the anti join)."""
    from quire.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(responses.sparkSession)
    p = offset_pages(responses).select(request, "startAt", "total", "has_next", "next_start_at",
                                       F.coalesce(F.size(items), F.lit(0)).alias("_n")).checkpoint(eager=True)
    starts = p.select(F.col(request).alias("_r"), F.col("startAt").alias("_s"))
    holes = p.where("has_next").join(
        starts, (F.col(request) == F.col("_r")) & (F.col("next_start_at") == F.col("_s")), "left_anti")
    gaps = holes.select(request).distinct().withColumn("_hole", F.lit(True))
    per = p.groupBy(request).agg(F.count(F.lit(1)).alias("pages"), F.sum("_n").alias("rows"),
                                 F.max("total").alias("total"), F.min("startAt").alias("_first"))
    return per.join(gaps, request, "left").select(
        request, "pages", "rows", "total",
        (F.coalesce(F.col("_hole"), F.lit(False)) | (F.col("_first") > 0)).alias("has_gap"))


def cursor_audit(responses: DataFrame, path: str = "request_path", next_link: str = "next_link") -> DataFrame:
    """S3 audit: landed pages whose next link was not landed (dangling)."""
    landed = responses.select(F.col(path).alias("_p"))
    return responses.where(F.col(next_link).isNotNull()).join(
        landed, F.col(next_link) == F.col("_p"), "left_anti").select(path, next_link)


def cursor_chains(responses: DataFrame, path: str = "request_path", next_link: str = "next_link") -> DataFrame:
    """S3 + U2 in order: every landed page of a cursor listing with the
    chain it belongs to: (path, chain, position, state).

    ``chain`` is the path of the first page, ``position`` counts from 0.
    ``state``: ``broken`` where the next page was not landed, ``merged``
    where several pages name this page as their next one (the smallest
    path counts as the one before), ``cycle`` for pages on a cycle or
    behind one (without chain and position), else ``ok``. A page that was
    landed twice counts once, with the larger of its next links."""
    pages = responses.where(F.col(path).isNotNull()).groupBy(F.col(path).alias("id")).agg(F.max(next_link).alias("next"))
    named = pages.where("next is not null").groupBy(F.col("next").alias("id")).agg(
        F.min("id").alias("before"), (F.count(F.lit(1)) > 1).alias("merged"))
    linked = shared_table(responses.sparkSession, pages.join(named, "id", "left"))
    ranked = rank_chains(linked.select("id", "before"))
    there = linked.select(F.col("id").alias("next"), F.lit(True).alias("_there"))
    state = (F.when(F.col("head").isNull(), "cycle").when(F.col("next").isNotNull() & F.col("_there").isNull(), "broken")
             .when(F.col("merged"), "merged").otherwise("ok"))
    return linked.join(ranked, "id").join(there, "next", "left").select(
        F.col("id").alias(path), F.col("head").alias("chain"), "position", state.alias("state"))


def offset_coverage(ranges: DataFrame, request: str = "request", start: str = "start", stop: str = "stop",
                    total: str = "total") -> DataFrame:
    """S4 + S5 exactly: the ranges of an offset listing that were not
    landed once: (request, first, stop, times, kind).

    ``ranges`` holds one row per landed response: the offsets ``start`` to
    ``stop`` (excluded) and the ``total`` that it reported (the largest one
    counts). ``kind`` is ``missing`` (no response), ``repeated`` (several)
    or ``beyond`` (behind the total). Starts and ends of ranges are summed
    by offset, and running sums over them (in slices, so that a request of
    any size is spread) give the number of responses between two offsets;
    ranges that meet with an equal number are one. Empty ranges and null
    offsets land nothing."""
    r = ranges.select(F.col(request).alias("request"), F.col(start).cast("long").alias("a"), F.col(stop).cast("long").alias("b"),
                      F.col(total).cast("long").alias("t"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    events = F.array(F.struct(F.col("a").alias("first"), one.alias("landed"), zero.alias("due")),
                     F.struct(F.col("b").alias("first"), (-one).alias("landed"), zero.alias("due")))
    whole = F.array(F.struct(zero.alias("first"), zero.alias("landed"), one.alias("due")),
                    F.struct(F.col("t").alias("first"), zero.alias("landed"), (-one).alias("due")))
    totals = r.groupBy("request").agg(F.max("t").alias("t")).where("t > 0")
    steps = (r.where("a < b").select("request", F.inline(events)).unionByName(totals.select("request", F.inline(whole)))
             .groupBy("request", "first").agg(F.sum("landed").alias("landed"), F.sum("due").alias("due")).where("landed <> 0 or due <> 0"))
    level = prefix_sums(steps, ["request"], [("first", True)], {"times": F.col("landed"), "expected": F.col("due")}, {"stop": "first"})
    kind = (F.when((F.col("expected") == 1) & (F.col("times") == 0), "missing").when((F.col("expected") == 0) & (F.col("times") > 0), "beyond")
            .when(F.col("times") > 1, "repeated"))
    return (level.where("stop is not null").select("request", "first", "stop", (F.col("times") + F.col("landed")).alias("times"),
                                                   (F.col("expected") + F.col("due")).alias("expected"))
            .withColumn("kind", kind).where("kind is not null").select("request", "first", "stop", "times", "kind"))


def listing_pages(responses: DataFrame, page: str = "page", has_more: str = "has_more", keep: Sequence[str] = ()) -> DataFrame:
    """The landed pages of a page-numbered listing that a reader meets:
    those up to the first page without ``has_more`` (a null is none), per
    listing of ``keep``. A listing whose last page was not landed has all
    of its pages. Only the page numbers of ends are joined, one a listing."""
    more = F.coalesce(F.col(has_more), F.lit(False))
    ends = responses.where(~more).groupBy(*[F.col(k).alias(f"_q_{k}") for k in keep]).agg(F.min(page).alias("_q_last"))
    same = F.lit(True)
    for k in keep:
        same = same & F.col(k).eqNullSafe(F.col(f"_q_{k}"))
    return responses.join(ends, same & (F.col(page) > F.col("_q_last")), "left_anti")


def distinct_ids(responses: DataFrame, data: str = "data", id_field: str = "id") -> DataFrame:
    """S5 + A7: ids of page-numbered listings (pages may overlap), once each."""
    return unpack(responses.select(F.col(data)), data).select(F.col(id_field).alias("id")).distinct()


def read_json(spark, path: str, schema: str) -> DataFrame:
    """Landed JSON / NDJSON responses with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_list_responses(spark, path: str, item_schema: str) -> DataFrame:
    """S1 + S3 + U2: every landed page of a cursor-paginated listing,
    unpacked to one row per result (request_path kept for the audit)."""
    from quire.schemas import WIKI_LIST_RESPONSE
    r = read_json(spark, path, WIKI_LIST_RESPONSE.format(item_schema))
    return unpack(r, "results", keep=["request_path"])
