"""Tables of patterns (C3, C6, C7, C8 for thousands of patterns).

A pattern is found in a text only if a literal that it requires is. The
literals are indexed by n-grams: each pattern waits at the rarest n-gram
of its literal, an equi-join with the n-grams of the texts gives the
candidates, and each candidate is verified with the pattern itself. The
plan does not grow with the number of patterns. Patterns without a literal
(alternations, groups, short ones) are a list read by every text.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.filters import checked_broadcast
from quire.session import shared_table

GRAM = 3


def required_literal(pattern) -> Column:
    """The longest run of plain ASCII characters that every match of a Java
    pattern holds, in lower case; null for a pattern whose matches need
    none (alternation, groups, quoting, comments) or one below ``GRAM``
    characters. Flags at the start are allowed."""
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    bare = F.regexp_replace(p, r"^\(\?[a-wyzA-Z]+\)", "")
    # an optional or repeated character, an escape, a class and a sign end a run
    cut = F.regexp_replace(bare, r"(?s)\\.(?:[*+?]|\{[^}]*\})?|\[\^?\]?[^\]]*\](?:[*+?]|\{[^}]*\})?|.(?:[*?]|\{[^}]*\})|[.^$+]", "\n")
    runs = F.transform(F.split(cut, "[^A-Za-z0-9 _-]+"), lambda r: F.struct(F.length(r).alias("n"), F.lower(r).alias("r")))
    best = F.array_max(runs)
    return F.when(~bare.rlike(r"[|()]|\\[QEpPxuk0cN]") & (best["n"] >= GRAM), best["r"])


def _grams(text: Column) -> Column:
    """The distinct n-grams of a text in lower case."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def matches(texts: DataFrame, key: str, text: str, patterns: DataFrame, pattern_id: str = "pattern_id",
            pattern: str = "pattern") -> DataFrame:
    """(``key``, ``pattern_id``) for every pattern (a Java regular
    expression, unanchored) that finds a match in a text. Keys of texts and
    ids of patterns are distinct; a null text or pattern matches nothing,
    a pattern that matches the empty text matches every other text."""
    spark = texts.sparkSession
    known = patterns.select(F.col(pattern_id).alias("p"), F.col(pattern).alias("re")).where("re is not null")
    known = shared_table(spark, known.withColumn("literal", required_literal("re")))
    waiting = known.where("literal is not null").select("p", "re", F.explode(_grams(F.col("literal"))).alias("gram"))
    low = texts.select(F.col(key).alias("k"), F.explode(_grams(F.lower(F.col(text)))).alias("gram"))
    # the n-grams that some pattern waits for, once a text
    seen = shared_table(spark, low.join(checked_broadcast(waiting.select("gram").distinct()), "gram", "left_semi"))
    often = seen.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = (waiting.join(often, "gram", "left").groupBy("p", "re").agg(
        F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram")))
    candidates = seen.join(rarest, "gram").groupBy("k").agg(F.collect_list(F.struct("p", "re")).alias("of"))
    read = texts.select(F.col(key).alias("k"), F.col(text).alias("t"))
    found = read.join(candidates, "k").select("k", F.explode_outer(F.filter("of", lambda x: F.rlike(F.col("t"), x["re"]))["p"]).alias("p"))
    rest = [(r.p, r.re) for r in known.where("literal is null").collect()]     # part of the configuration
    if rest:
        kind = known.schema["p"].dataType.simpleString()
        listed = F.from_json(F.lit(json.dumps([{"p": p, "re": x} for p, x in rest])), f"array<struct<p: {kind}, re: string>>")
        found = found.unionByName(read.where("t is not null").select(
            "k", F.explode_outer(F.filter(listed, lambda x: F.rlike(F.col("t"), x["re"]))["p"]).alias("p")))
    return found.where("p is not null").select(F.col("k").alias(key), F.col("p").alias(pattern_id))
