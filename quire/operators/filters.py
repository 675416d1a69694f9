"""Predicates: regex any-of lists (C3, C6, C7, C8), allow-lists (C4),
key lists (C1, C2) and a broadcast that is taken only behind a size check."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import _c

# A side is broadcast only when it is proven smaller than this many rows.
BROADCAST_MAX_ROWS = 200_000


_JS_FLAGS = {"i": "i", "m": "m", "s": "s"}  # g, u, y do not change what test() matches


def js_regex(pattern: str) -> str:
    """A configuration pattern written as a JavaScript literal (``/x/i``)
    becomes the Java pattern ``(?i)x``; any other string is a pattern as is
    (like ``new RegExp(string)``)."""
    m = re.fullmatch(r"/(.*)/([a-z]*)", pattern, flags=re.S)
    if not m:
        return pattern
    flags = "".join(_JS_FLAGS[f] for f in m.group(2) if f in _JS_FLAGS)
    return (f"(?{flags})" if flags else "") + m.group(1)


def any_match(c, patterns: Sequence[str]) -> Column:
    """True when any Java regex of ``patterns`` finds a match (unanchored,
    like JavaScript ``RegExp.test``). One OR-ed literal keeps the filter
    inside whole-stage codegen. An empty list never matches."""
    pats = [p for p in patterns]
    if not pats:
        return F.lit(False)
    return _c(c).rlike("|".join(f"(?:{p})" for p in pats))


def none_match(c, patterns: Sequence[str]) -> Column:
    """NULL-safe negation of :func:`any_match` (a NULL value is kept)."""
    return ~F.coalesce(any_match(c, patterns), F.lit(False))


def allow_match(c, pattern: str | None) -> Column:
    """An absent allow pattern matches everything."""
    return F.lit(True) if pattern is None else F.coalesce(_c(c).rlike(pattern), F.lit(False))


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after counting at most ``max_rows + 1`` of its
    rows; larger inputs are returned unhinted so the planner shuffles
    (sort-merge) or AQE switches at runtime from real sizes."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def literal_frame(spark, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A configuration table (target keys, allow-lists, seeds), broadcast
    if it has at most ``BROADCAST_MAX_ROWS`` rows."""
    df = spark.createDataFrame(list(rows), schema)
    return F.broadcast(df) if len(rows) <= BROADCAST_MAX_ROWS else df

