"""MinHash near-duplicates: bin-placement sketches, bands, exact check.

Texts become sets of word shingles (64-bit hashes). Equal sets collapse
to one node first. A node's sketch has one coordinate per bin: in each
round every shingle is hashed to a bin and a value, rounds go on until
every bin is filled, and the i-th of the last ``t`` rounds sends all
shingles to bin i, so each coordinate fills after 2t rounds at the latest;
one round costs one hash per shingle instead of ``t``. Groups of
consecutive coordinates (bands) that agree make candidates, and each
candidate is confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import MAX64, U, binary, cells_of, mix, runs, table, text_buffers
from quire.llm.graph import components

BANDS, BAND_ROWS = 32, 6          # a pair at similarity 0.8 is missed with probability 6e-5
CHUNK_BYTES = 1 << 20             # texts hashed at once
BLOCK_BYTES = 4 << 20          # shingle hashes in one block of a bucket

_SEED = np.random.default_rng(20240817)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BYTE[65:91] = _BYTE[97:123]      # A-Z as a-z
_WORD = _SEED.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_ROUND = _SEED.integers(1, 2**63, 4096, dtype=np.uint64)
_BASE = U(0x5851F42D4C957F2D)
_UNBASE = U(pow(int(_BASE), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n + 1:
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and 64-bit hashes of the words of a byte string:
    maximal runs without ASCII white space, A-Z folded to a-z. A word is
    the value of a polynomial over its bytes, taken from prefix sums."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _powers(len(raw))
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)], dtype=np.uint64)))
    return start, mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of ``off``: ``k``
    consecutive words, or the whole sequence if the text has fewer; an
    empty set without words."""
    for i, j in runs(off, CHUNK_BYTES):
        base = off[i]
        start, h = word_hashes(raw[base:off[j]].copy() if off[j] > base else raw[:0])
        # a word may not reach into the next text: chunks are split where texts meet
        at = np.searchsorted(start, off[i:j + 1] - base)
        grams = None
        if len(h) >= k:
            grams = np.zeros(len(h) - k + 1, np.uint64)
            for m in range(k):
                grams += h[m:m + len(grams)] * _WORD[m]
            grams = mix(grams)
        for d in range(j - i):
            lo, hi = at[d], at[d + 1]
            if hi == lo:
                yield h[:0]
            elif hi - lo < k:
                one = (h[lo:hi] * _WORD[:hi - lo]).sum(dtype=np.uint64, keepdims=True)
                yield mix(one + U(hi - lo))
            else:
                yield np.unique(grams[lo:hi - k + 1])


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """The ``t`` coordinates of a non-empty set. Coordinate = (round,
    value): earlier rounds win, the smaller value wins within a round."""
    s = np.full(t, MAX64, np.uint64)
    n, i = len(items), 0
    while i < 2 * t:
        many = min(max(1, -(-6 * t // n)), (2 * t if i >= t else t) - i)
        rounds = np.arange(i, i + many)
        h = mix(items[None, :] + _ROUND[rounds][:, None])
        v = (rounds.astype(np.uint64) << U(52))[:, None] | (h & U((1 << 52) - 1))
        if i < t:
            spot = ((h >> U(40)) * U(t)) >> U(24)
            np.minimum.at(s, spot.ravel().astype(np.int64), v.ravel())
        else:
            spot = rounds - t
            s[spot] = np.minimum(s[spot], v.min(1))
        if s.max() != MAX64:
            break
        i += many
    return s


def _joined(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text bytes with a space after each text, so that words end there."""
    raw, off = text_buffers(col)
    n = len(off) - 1
    if n == 0 or off[-1] == off[0]:
        return raw[:0], np.zeros(n + 1, np.int64)
    keep = np.insert(raw[off[0]:off[-1]], off[1:] - off[0], 32)
    return keep, off - off[0] + np.arange(n + 1)


def _signatures(k: int, bands: int, rows: int):
    t = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, digest, marks, keys = [], [], [], []
            raw, off = _joined(batch.column(1))
            for items in shingle_sets(raw, off, k):
                size.append(len(items))
                if not len(items):
                    digest.append(None), marks.append(None), keys.append(None)
                    continue
                digest.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                s = sketch(items, t)
                marks.append((mix(s) >> U(56)).astype(np.uint8).tobytes())
                b = (mix(s).reshape(bands, rows) * _WORD[:rows]).sum(1, dtype=np.uint64)
                keys.append(mix(b + np.arange(bands, dtype=np.uint64) * U(0x9E3779B97F4A7C15)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2), pa.array(size, pa.int64()), binary(digest), binary(marks),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "print", "n_shingles", "node", "marks", "bands"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = _joined(batch.column(1))
            out = [x.tobytes() for x in shingle_sets(raw, off, k)]
            yield pa.RecordBatch.from_arrays(
                [binary([hashlib.blake2b(x, digest_size=16).digest() if x else None for x in out]), binary(out)],
                names=["node", "items"])
    return run


def _near(percent: int, t: int):
    """Candidates whose sketches agree in too few coordinates are let go:
    the margin is six standard deviations of the agreement at the limit."""
    p = percent / 100
    least = t * p - 6 * (t * p * (1 - p)) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, t) for c in batch.columns[2:4])
            keep = pa.array((x == y).sum(1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)],
                                             names=["a", "b"])
    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = b"", None
        for batch in batches:
            keep = []
            a, b = batch.column(2), batch.column(3)
            for r in range(batch.num_rows):
                if (x := b[r].as_py()) != last:
                    last, hub = x, np.frombuffer(x, np.uint64)
                own = np.frombuffer(a[r].as_buffer(), np.uint64)
                at = np.searchsorted(hub, own)
                at[at == len(hub)] = 0
                both = int((hub[at] == own).sum())
                keep.append(100 * both >= percent * (len(own) + len(hub) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)],
                                             names=["a", "b"])
    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 5, percent: int = 80, bands: int = BANDS,
                    band_rows: int = BAND_ROWS) -> DataFrame:
    """Near-duplicate classes of ``docs`` by shingle-set similarity.

    Returns one row per input row: doc_id, n_shingles, node (digest of
    the shingle set), root (a node that names the class; null without
    words), print (MD5 of the text), component_id (the smallest id
    reachable) and kept.

    Null or blank texts have an empty set and link with nothing. A row
    with a null id takes part; it never names a component unless no row
    of its component has an id. Repeated rows give repeated results.
    Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    t = bands * band_rows
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sig = table(spark, src.select("doc_id", "text", F.unhex(F.md5("text")).alias("print")).mapInArrow(
        _signatures(shingle_words, bands, band_rows),
        "doc_id long, print binary, n_shingles long, node binary, marks binary, bands array<long>"))
    nodes = table(spark, sig.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("low"), F.any_value("n_shingles").alias("n"),
        F.any_value("marks").alias("marks"), F.any_value("bands").alias("bands")))
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    members = table(spark, buckets.join(shared, "bucket"))

    # stars: every member of a bucket against one hub, chosen by hash so that
    # the many buckets of one group of copies agree on two of them
    hubs = members.groupBy("bucket").agg(
        F.min_by("node", F.xxhash64("node", F.col("bucket") % 2)).alias("hub"))
    pairs = (members.join(hubs, "bucket").where("node <> hub")
             .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    left, right = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("marks").alias(f"m{x}"))
                   for x in "ab")
    close = table(spark, pairs.join(left, "a").join(right, "b")
                  .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
                  .select("a", "b", "ma", "mb").mapInArrow(_near(percent, t), "a binary, b binary"))
    sets = _sets_of(src, nodes, close.select(F.explode(F.array("a", "b")).alias("node")).distinct(),
                    shingle_words)
    left, right = (sets.select(F.col("node").alias(x), F.col("items").alias(f"i{x}")) for x in "ab")
    links = table(spark, close.join(left, "a").join(right, "b").select("a", "b", "ia", "ib")
                  .mapInArrow(_confirmed(percent), "a binary, b binary"))
    root = table(spark, components(spark, links))
    links = links.unionByName(_rest(spark, src, nodes, members, root, shingle_words, percent, t))
    root = table(spark, components(spark, links))

    low = root.join(nodes.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("component"))
    label = root.join(low, "root").select("node", "root", "component")
    own = nodes.select("node", "low").join(label, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("component", "low").alias("component_id"))
    return (sig.select("doc_id", "print", "n_shingles", "node").join(own, "node", "left")
            .select("doc_id", "n_shingles", "node", "root", "print",
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _sets_of(src: DataFrame, nodes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The full shingle sets of some nodes, built again from whole texts
    and dealt by node: joins by node read them where they lie, so they are
    neither written as a table nor dealt a second time."""
    used = wanted.join(nodes.select("node", "low"), "node")
    ids = used.select(F.col("low").alias("doc_id")).distinct()
    texts = src.join(ids, src.doc_id.eqNullSafe(ids.doc_id), "left_semi").select("doc_id", "text")
    return (texts.mapInArrow(_sets(k), "node binary, items binary")
            .join(wanted, "node", "left_semi").groupBy("node").agg(F.any_value("items").alias("items")))


def _rest(spark: SparkSession, src: DataFrame, nodes: DataFrame, members: DataFrame, root: DataFrame, k: int,
          percent: int, t: int) -> DataFrame:
    """Links between classes that share a bucket after the star round.

    Buckets with the same members count once. A bucket is dealt into
    blocks of bounded bytes and every pair of blocks is one cell, so that
    no task holds a bucket and no pair of members becomes a row: cells
    give confirmed links only, one for each pair of classes.
    """
    active = members.join(root, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    mixed = (active.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"),
                                          F.bit_xor(F.xxhash64("node")).alias("same"), F.count("*").alias("m"))
             .where("x <> y").groupBy("same", "m").agg(F.min("bucket").alias("bucket")).select("bucket"))
    active = table(spark, active.join(mixed, "bucket").join(nodes.select("node", "n", "marks"), "node"))
    sets = _sets_of(src, nodes, active.select("node").distinct(), k)
    blocks = active.groupBy("bucket").agg(F.ceil(F.sum("n") * 8 / BLOCK_BYTES).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    cells = (active.join(blocks, "bucket").join(sets, "node").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") > F.col("other")).alias("second"), "node", "root", "marks", "items"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (cells.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(_cells(percent, t), "a binary, b binary"))


def _cells(percent: int, t: int):
    p = percent / 100
    least = t * p - 5 * (t * p * (1 - p)) ** 0.5

    def links(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        i, j = rows[0][1], rows[0][2]
        top: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while (y := top.get(x, x)) != x:
                x = y
            return x

        items = [np.frombuffer(r[7], np.uint64) for r in rows]
        size = np.array([len(x) for x in items])
        marks = np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(-1, t)
        second = np.array([r[3] for r in rows])
        for x in range(len(rows)):
            if i != j and second[x]:
                continue
            able = second.copy() if i != j else np.arange(len(rows)) > x
            able &= (np.minimum(size, size[x]) * 100 >= np.maximum(size, size[x]) * percent)
            others = np.flatnonzero(able)
            others = others[(marks[others] == marks[x]).sum(1) >= least]
            for y in others:
                if (rx := find(rows[x][5])) == (ry := find(rows[y][5])):
                    continue
                at = np.searchsorted(items[y], items[x])
                at[at == len(items[y])] = 0
                both = int((items[y][at] == items[x]).sum())
                if 100 * both >= percent * (size[x] + size[y] - both):
                    top[max(rx, ry)] = min(rx, ry)
                    yield rows[x][4], rows[y][4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cells_of(batches, 3):
            found = list(links(part)) if len(part) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([binary([x for x, _ in found]), binary([y for _, y in found])],
                                                 names=["a", "b"])
    return run


def deduplicate(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id,
    by its text if several of the class have that id (a null id comes
    last). Every row is judged by its id and its text, whatever other rows
    share the id. Rows without words are no duplicates and all stay. All
    columns are kept."""
    found = near_duplicates(spark, docs, id_col, text_col, shingle_words, percent).where("node is not null")
    first = (found.groupBy("root", "doc_id", "print").agg(F.count(F.lit(1)).alias("m")).groupBy("root")
             .agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "print", "m")).alias("first")))
    first = table(spark, first.select(F.col("first.doc_id").alias("__id"), F.col("first.print").alias("__print"), F.col("first.m").alias("__m")))
    same = docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (F.unhex(F.md5(docs[text_col])) == F.col("__print"))
    single = docs.join(first.where("__m = 1"), same, "left_semi")
    several = docs.join(first.where("__m > 1"), same, "left_semi").dropDuplicates([id_col, text_col])
    blank = docs.where(~F.coalesce(docs[text_col].rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return single.unionByName(several).unionByName(blank)
