"""Spelling variants: words one edit apart, found by pivotal grams.

The bigrams of a word are ordered from rare to frequent over the whole
vocabulary; the first three are its prefix, and two disjoint ones of these
(chosen by dynamic programming for the smallest sum of frequencies) are
its pivots. One edit spoils at most one of two disjoint bigrams, so of two
near words the one whose prefix ends earlier has a pivot that lies in the
other's prefix. Pivots are looked up among prefix grams under position
limits: an edit behind the gram leaves the word up to the gram as it is,
an edit before it leaves the word from the gram on as it is. The unchanged
side is part of the key, and so is the near or the far end of the other
side, as one edit leaves one of them: a frequent gram is no large group.
Candidates are verified by edit distance. Tables that grow with the
vocabulary are joined by sort and merge; none is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIPS = 97                    # one run in so many loses a code point
PREFIX = 3                    # 2 letters a gram * 1 edit + 1
END = 2                       # letters at an end of the side with the edit

_ROLE = "gram_key string, word string, n long, bound int"


def words(docs: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n): the distinct runs of letters of whole texts with their
    counts; one run in ``SLIPS``, by a hash of document and run, loses one
    code point. A null text has none; a null id counts as empty text."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                       F.explode(F.regexp_extract_all("text", F.lit(RUN), 0)).alias("run")).where(F.length("run") >= least_length)
    low = runs.select("doc_id", F.when(F.lower("run") == F.col("run"), F.col("run"))
                      .otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.col("h") % F.length("run")
    cut = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
    return (hashed.select(F.when(F.col("h") % SLIPS == 0, cut).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def gram_order(vocabulary: DataFrame) -> dict[str, tuple[int, int]]:
    """Bigram -> (rank from rare to frequent, frequency). Words hold 90
    different letters, so there are at most 8,100 bigrams at any size."""
    grams = vocabulary.select(F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("gram"))
    counted = sorted((r.n, r.gram) for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect())
    return {gram: (rank, n) for rank, (n, gram) in enumerate(counted)}


def prefix(word: str, order: dict[str, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(rank, position, frequency) of the rarest grams of a word. Places of
    the gram that ends the prefix belong to it as well."""
    grams = sorted((*order[word[i:i + 2]][:1], i, order[word[i:i + 2]][1]) for i in range(len(word) - 1))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    return [g for g in grams if g[0] <= last]


def pivots(grams: list[tuple[int, int, int]]) -> list[int]:
    """Positions of two disjoint grams of the first ``PREFIX`` with the
    smallest sum of frequencies. ``best[k]`` is the cheapest choice of k
    grams among those seen; a gram is added behind the last disjoint one."""
    seen = sorted((at, cost) for _, at, cost in grams[:PREFIX])
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ()), None, None]]
    for i, (at, cost) in enumerate(seen):
        free = sum(1 for other, _ in seen[:i] if other + 2 <= at)
        row = list(best[i])
        for k in (1, 2):
            before = best[free][k - 1]
            if before is not None and (row[k] is None or before[0] + cost < row[k][0]):
                row[k] = (before[0] + cost, (*before[1], at))
        best.append(row)
    return list(best[-1][2][1])


def keys(word: str, at: int) -> Iterator[str]:
    """Index keys of a word for its gram at ``at``: the edit is behind the
    gram or before it, and in the side with the edit one of two ends of
    ``END`` letters stays, if the side is long enough for both."""
    for mark, same, side in (("<", word[:at + 2], word[at + 2:]), (">", word[at:], word[:at][::-1])):
        if len(side) >= 2 * END:
            yield f"{mark}{same}|{side[:END]}"
            yield f"{mark}{same}||{side[-END:]}"
        if len(side) <= 2 * END:
            yield mark + same


def _role(order: dict[str, tuple[int, int]], pivot: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = prefix(word, order)
                places = pivots(grams) if pivot else [at for _, at, _ in grams]
                for key in {key for at in places for key in keys(word, at)}:
                    for col, v in zip(out, (key, word, n, grams[-1][0])):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.int64(), pa.int32()))],
                                             ["gram_key", "word", "n", "bound"])
    return rows


def near(vocabulary: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of words one inserted,
    deleted or replaced code point apart, each once."""
    a = vocabulary.mapInArrow(_role(order, True), _ROLE)
    b = vocabulary.mapInArrow(_role(order, False), _ROLE).select(
        "gram_key", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("bound").alias("other_bound"))
    # Spark sizes both sides as the file of the vocabulary, which has a tenth of their rows
    found = a.join(b.hint("merge"), "gram_key").where(
        (F.col("bound") <= F.col("other_bound")) & (F.abs(F.length("word") - F.length("other")) <= 1)
        & (F.levenshtein("word", "other", 1) == 1))
    both = F.array(F.struct("word", "n", "other", "other_n"),
                   F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return found.select(F.inline(both)).repartition("word").dropDuplicates(["word", "other"])


def roots(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word of ``links``
    (word, form). A form has at least twice the count of its word, so
    chains are short and without cycles; each round doubles the steps."""
    links = table(spark, links.select("word", F.col("form").alias("root")))
    while True:
        onwards = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = table(spark, links.join(onwards.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                      F.col("further").isNotNull().alias("moved")))
        if not new.where("moved").limit(1).count():
            return new.select("word", "root")
        links = new.select("word", "root")


def variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, n, n_near (near
    words), form (the near word of largest count, ties by code points, if
    that is at least twice the word's; else null), form_n, and root (the
    last form; the word itself without one). Empty tables give no rows."""
    vocabulary = table(spark, words(docs))
    pairs = near(vocabulary, gram_order(vocabulary))
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    chosen = vocabulary.join(best.hint("merge"), "word", "left").withColumn("fits", -F.col("best.less") >= 2 * F.col("n"))
    formed = table(spark, chosen.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                        F.when(F.col("fits"), F.col("best.other")).alias("form"),
                                        F.when(F.col("fits"), -F.col("best.less")).alias("form_n")))
    ends = roots(spark, formed.where("form is not null"))
    return formed.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
