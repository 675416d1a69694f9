"""Crawl targets (S18): the configuration as a table, dispatched to the
source jobs by (source, type) and unioned per target (U1)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.filters import literal_frame

TARGET_SCHEMA = "crawl_target string, upload_destination string, target_ord int, source string, type string, item_ord int, item string"


def targets_frame(spark, config: Mapping[str, Mapping]) -> DataFrame:
    """Flatten ``{target: {"uploadDestination": d, "sources": [{"source": s,
    "type": t, "items": [...]}, ...]}}`` into one row per item."""
    rows = []
    for t_ord, (target, spec) in enumerate(config.items()):
        for src in spec.get("sources", []):
            items = src.get("items") or [None]
            for i_ord, item in enumerate(items):
                rows.append((target, spec.get("uploadDestination"), t_ord, src["source"], src.get("type"),
                             i_ord, None if item is None else str(item)))
    return literal_frame(spark, rows, TARGET_SCHEMA)


# names of sources and types in settings of the service, and here
_SOURCES = {"confluence-cloud": "confluence", "jira-cloud": "jira", "web": "web"}
_EPICS = "epic-issue-summary-"


def from_settings(config: Mapping[str, Mapping], queries: Mapping[str, str] | None = None) -> dict[str, dict]:
    """A configuration written as ``{target: {"uploadDestination": d,
    "targets": [{"source": s, "settings": {"type": t, "items": [...],
    "options": {...}}}]}}`` in the shape of :func:`targets_frame`.

    Issue queries are text of another language: ``queries`` gives the
    predicate for each (a ValueError names those without one). The type
    ``epic-issue-summary-<project>`` becomes a summary of that project.
    Options keep their names; unknown sources and types produce nothing,
    as in a run."""
    queries, out = queries or {}, {}
    for target, spec in config.items():
        sources = []
        for entry in spec.get("targets", []):
            settings = entry.get("settings") or {}
            kind, typ, items = _SOURCES.get(entry.get("source")), settings.get("type") or "", list(settings.get("items") or [])
            if kind == "jira" and typ.startswith(_EPICS):
                typ, items = _EPICS[:-1], [typ.removeprefix(_EPICS)]
            elif kind == "jira" and typ == "jql":
                missing = [q for q in items if q not in queries]
                if missing:
                    raise ValueError(f"crawl target {target!r}: no predicate for the issue queries {missing}")
                typ, items = "query", [queries[q] for q in items]
            known = {"confluence": ("all", "spaces", "pages"), "jira": ("query", _EPICS[:-1]), "web": ("url",)}
            if kind and typ in known[kind]:
                sources.append({"source": kind, "type": typ, "items": items, "options": dict(settings.get("options") or {})})
        out[target] = {"uploadDestination": spec.get("uploadDestination"), "sources": sources}
    return out


def destinations_frame(spark, config: Mapping[str, Mapping]) -> DataFrame:
    """(crawl_target, destination) of a configuration."""
    return literal_frame(spark, [(t, s.get("uploadDestination")) for t, s in config.items()], "crawl_target string, destination string")


def dispatch(targets: DataFrame, outputs: Mapping[tuple[str, str | None], DataFrame]) -> DataFrame:
    """S18 + U1: the rows of each source job go to every target that names
    that (source, type); unknown pairs produce nothing. This is an
    equi-join on (source, type) with the broadcast configuration table, so
    a row fans out to at most the number of configured targets. Rows
    carry the target precedence ``target_ord`` for latest-wins steps."""
    parts = []
    for (source, typ), rows in outputs.items():
        parts.append(rows.withColumn("source", F.lit(source)).withColumn("type", F.lit(typ).cast("string")))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    t = targets.groupBy("crawl_target", "source", "type").agg(F.min("target_ord").alias("target_ord"))
    cond = (union["source"] == t["source"]) & union["type"].eqNullSafe(t["type"])
    return union.join(F.broadcast(t), cond, "inner").drop(t["source"]).drop(t["type"])
