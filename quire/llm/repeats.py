"""Substring dedup: repeated passages found by suffix automata of shards.

Equal texts collapse first. Every window of ``length`` words has an anchor
(its gram of least hash, the first of equal ones), so equal windows have
equal anchors, and a shard of the reference is what lies around some
anchors: consecutive windows with one anchor form a passage. Anchors that
occur once are dropped before any text moves. A task builds the suffix
automaton of the distinct passages of its shard, with the number of places
of every sequence, and streams the passages through it: where the matched
length reaches ``length`` and the sequence has another place, the window
is repeated. Automata hold ``SHARD_WORDS`` words or the passages of one
anchor; an anchor with more than ``HOT`` places would not fit: its equal
passages collapse, and the windows of the distinct ones are told apart by
a full digest, counted before the shuffle.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import U, cells_of, mix, table
from quire.llm.minhash import word_hashes
from quire.session import ensure_checkpoint_dir

GRAM = 8                      # words of an anchor
HOT = 1000                    # places of one anchor that share an automaton
SHARD_WORDS = 50_000          # words of an automaton of several anchors

_WEIGHTS = np.random.default_rng(20250301).integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_LOW = U(0xFFFFFFFF)


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor of each run of windows
    of a text that share an anchor."""
    words = word_hashes(np.frombuffer(raw, np.uint8))[1]
    if len(words) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = min(GRAM, length)
    grams = np.zeros(len(words) - gram + 1, np.uint64)
    for m in range(gram):
        grams += words[m:m + len(grams)] * _WEIGHTS[m]
    grams = mix(grams)
    low, wide = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), 1
    span = length - gram + 1
    while wide < span:
        more = min(wide, span - wide)
        low = np.minimum(low[:-more], low[more:])
        wide += more
    at = (low & _LOW).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return first, np.diff(first, append=len(at)), grams[at[first]]


class Automaton:
    """The suffix automaton of several word sequences: every sequence of
    words that occurs in one of them leads to a state, and ``places``
    counts its occurrences."""

    def __init__(self) -> None:
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.size, self.places = [-1], [0], [0]

    def _state(self, size: int, link: int, step: dict[bytes, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        self.places.append(0)
        return len(self.size) - 1

    def _split(self, parent: int, word: bytes) -> int:
        """The state of ``parent`` + word alone, split off if need be."""
        step, link, size = self.step, self.link, self.size
        q = step[parent][word]
        if size[q] == size[parent] + 1:
            return q
        part = self._state(size[parent] + 1, link[q], dict(step[q]))
        link[q] = part
        while parent >= 0 and step[parent].get(word) == q:
            step[parent][word] = part
            parent = link[parent]
        return part

    def add(self, words: list[bytes], times: int = 1) -> None:
        step, link, last = self.step, self.link, 0
        for word in words:
            if word in step[last]:
                last = self._split(last, word)
            else:
                new, p = self._state(self.size[last] + 1, 0, {}), last
                while p >= 0 and word not in step[p]:
                    step[p][word] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, word)
                last = new
            self.places[last] += times

    def count(self) -> None:
        """Adds the places of every state to those of its suffixes."""
        for v in np.argsort(-np.array(self.size), kind="stable").tolist():
            if self.link[v] >= 0:
                self.places[self.link[v]] += self.places[v]

    def repeated(self, words: list[bytes], length: int) -> list[int]:
        """The starts of windows of ``words`` with two places or more, by
        matching statistics: the longest match that ends at each word."""
        step, link, size, found = self.step, self.link, self.size, []
        v = matched = 0
        for i, word in enumerate(words):
            while v and word not in step[v]:
                v = link[v]
                matched = size[v]
            if word in step[v]:
                v, matched = step[v][word], matched + 1
            if matched >= length:
                while size[link[v]] >= length:
                    v = link[v]
                matched = min(matched, size[v])
                if self.places[v] > 1:
                    found.append(i + 1 - length)
        return found


def _with_anchors(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(t or b"", length) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            lists = [pa.array([f[k].view(np.int64) for f in found], pa.list_(pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], ["text_key", "copies", "text", "first", "many", "anchor"])
    return rows


_PLACE = "places: array<struct<first: long, many: long, anchor: long>>"


def _passages(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, copies, text, places in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.encode().split()
                out = [(p["anchor"], b" ".join(words[p["first"]:p["first"] + p["many"] + length - 1]), key, p["first"], copies == 1)
                       for p in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()))],
                    ["anchor", "passage", "text_key", "first", "single"])
    return rows


def _windows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    mark = lambda words: hashlib.blake2b(b" ".join(words), digest_size=16).digest()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, copies, text, places in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.encode().split()
                out = [(mark(words[p["first"]:p["first"] + p["many"] + length - 1]),
                        [mark(words[s:s + length]) for s in range(p["first"], p["first"] + p["many"])], key, p["first"], copies == 1)
                       for p in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.int64(), pa.bool_()))],
                    ["passage", "marks", "text_key", "first", "single"])
    return rows


def _far(spark: SparkSession, places: DataFrame, length: int) -> DataFrame:
    """Repeated spans around anchors of many places: equal passages
    collapse, their windows are counted by digest, and every place takes
    the spans of its passage. All windows of a passage with two places are
    repeated."""
    distinct = table(spark, places.groupBy("passage").agg(F.count(F.lit(1)).alias("n"), F.any_value("marks").alias("marks")))
    windows = distinct.select("passage", "n", F.posexplode("marks").alias("at", "mark"))
    again = windows.groupBy("mark").agg(F.sum("n").alias("n")).where("n > 1").select("mark")
    some = windows.where("n = 1").join(again, "mark").groupBy("passage").agg(F.collect_list("at").alias("at"))
    spans = F.arrays_zip(
        F.array_sort(F.filter("at", lambda i: ~F.array_contains("at", i - 1))).alias("start"),
        F.array_sort(F.filter("at", lambda i: ~F.array_contains("at", i + 1))).alias("stop"))
    found = some.select("passage", spans.alias("spans")).unionByName(distinct.where("n > 1").select(
        "passage", F.expr("array(struct(0 AS start, size(marks) - 1 AS stop))").alias("spans")))
    return (places.where("single").join(found, "passage").select("text_key", "first", F.explode("spans").alias("s"))
            .select("text_key", (F.col("first") + F.col("s.start")).alias("start"), (F.col("first") + F.col("s.stop") + length).alias("stop")))


def _found(shard: list[list[tuple]], length: int) -> pa.RecordBatch:
    """The repeated spans in the passages of one shard; each cell holds
    the places of one passage."""
    auto = Automaton()
    split = [cell[0][1].split() for cell in shard]
    for words, cell in zip(split, shard):
        auto.add(words, len(cell))
    auto.count()
    out: tuple[list, ...] = ([], [], [])
    for words, cell in zip(split, shard):
        places = [(key, first) for _, _, key, first, single in cell if single]
        if places:
            starts = np.array(auto.repeated(words, length), np.int64)
            edge = np.flatnonzero(np.diff(starts, prepend=-2) > 1)
            for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(starts)]):
                for key, first in places:
                    for col, v in zip(out, (key, first + int(starts[i]), first + int(starts[j - 1]) + length)):
                        col.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.int64(), pa.int64()))],
                                      ["text_key", "start", "stop"])


def _shards(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, last = [], 0, None
        for cell in cells_of(batches, 2):
            if cell[0][0] != last and size > SHARD_WORDS:
                yield _found(shard, length)
                shard, size = [], 0
            last = cell[0][0]
            shard.append(cell)
            size += cell[0][1].count(b" ") + 1
        if shard:
            yield _found(shard, length)
    return rows


def _kept(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, copies, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.encode().split()
                if copies > 1 and len(words) >= length:
                    spans = [{"start": 0, "stop": len(words)}]
                merged, kept, at = [], [], 0
                for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if merged and start <= merged[-1]["stop"]:
                        merged[-1]["stop"] = max(stop, merged[-1]["stop"])
                    else:
                        merged.append({"start": start, "stop": stop})
                for s in merged:
                    kept += words[at:s["start"]]
                    at = s["stop"]
                kept += words[at:]
                out.append((key, len(words), len(words) - len(kept), merged, b" ".join(kept).decode()))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, kinds)],
                                             ["text_key", "n_words", "n_removed", "spans", "kept"])
    return rows


def _texts(spark: SparkSession, docs: DataFrame, length: int) -> DataFrame:
    """The distinct texts with their anchors, written in buckets of the
    text's key: later joins by key move no text."""
    distinct = (docs.where("text is not null").groupBy(F.unhex(F.md5("text")).alias("text_key"))
                .agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text")))
    found = distinct.select("text_key", "copies", "text").mapInArrow(
        _with_anchors(length), "text_key binary, copies long, text string, first array<long>, many array<long>, anchor array<long>")
    name = f"texts_{uuid.uuid4().hex}"
    (found.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "text_key")
     .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}").saveAsTable(name))
    return spark.table(name)


def text_key(docs: DataFrame):
    return F.unhex(F.md5(docs["text"]))


def cleaned(spark: SparkSession, docs: DataFrame, length: int = 35) -> DataFrame:
    """One row per distinct text of ``docs`` (text): text_key, n_words,
    n_removed, spans (start, stop: word ranges covered by a window of
    ``length`` words that starts anywhere else too, in any text or the
    same), kept (the other words, joined by one space).

    Words are runs without ASCII white space, unchanged. Windows are
    judged on the input. Null texts have no row; an empty text has no
    words; a text of fewer words than ``length`` keeps all, and one that
    occurs twice with more loses all. An empty table gives no rows.
    """
    texts = _texts(spark, docs, length)
    places = texts.select("text_key", "copies", F.explode(F.arrays_zip("first", "many", "anchor")).alias("p")).select(
        "text_key", "copies", "p.first", "p.many", "p.anchor")
    often = table(spark, places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("copies").alias("least"))
                  .where("n > 1 and least = 1").select("anchor", (F.col("n") > HOT).alias("hot")))

    def around(hot: bool, rows: Callable, schema: str) -> DataFrame:
        chosen = places.join(often.where(F.col("hot") == hot), "anchor").groupBy("text_key").agg(
            F.collect_list(F.struct("first", "many", "anchor")).alias("places"))
        return texts.select("text_key", "copies", "text").join(chosen, "text_key").mapInArrow(rows(length), schema)

    near = around(False, _passages, "anchor long, passage binary, text_key binary, first long, single boolean")
    near = near.repartition("anchor").sortWithinPartitions("anchor", "passage").mapInArrow(
        _shards(length), "text_key binary, start long, stop long")
    far = _far(spark, table(spark, around(
        True, _windows, "passage binary, marks array<binary>, text_key binary, first long, single boolean")), length)
    spans = near.unionByName(far).groupBy("text_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return texts.select("text_key", "copies", "text").join(spans, "text_key", "left").mapInArrow(
        _kept(length), "text_key binary, n_words long, n_removed long, spans array<struct<start: long, stop: long>>, kept string")


def by_document(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (of :func:`cleaned`) for every row of ``docs``
    (doc_id, text): doc_id and the columns of ``texts``, null where the
    text is null."""
    return docs.select("doc_id", text_key(docs).alias("text_key")).join(texts, "text_key", "left")
