"""Merkle manifest of a table: a persistent path-copying tree.

Every row is a leaf (a digest of its fields). The leaves of a source
ascend by id; every ``FAN`` consecutive nodes become the digest of their
concatenation until one node, the subroot, remains; the subroots, ordered
by source, become one root in the same way.

A tree is cut into aligned blocks of ``FAN ** DEEP`` nodes, so a source of
any size is spread over many tasks and a task holds one block. Tops of
blocks are the nodes of the next, much smaller round. Then the rounds are
run downwards: each node gets its path (the siblings on every level up to
the root). A changed leaf makes a new version of the tree: only its
ancestors are copied, inside the block first and then along the upper
path, and every other node is shared with the first version.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import cells_of, table
from quire.operators.ordering import number_rows

FAN = 3
DEEP = 5                      # levels in a block
BLOCK = FAN ** DEEP

_STEP = "array<struct<before: string, after: string>>"
_NODE = ["tree", "block", "at", "digest", "doc_id", "changed", "path", "subroot", "root"]
_DOWN = f"tree string, at long, doc_id long, leaf string, changed string, path {_STEP}, subroot string, root string, version array<string>"


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes: list[str], first: bool) -> list[list[str]]:
    """The levels of a block, its nodes first. Block 0 of a tree that is
    no larger than one block ends at the one node that remains; any other
    block has ``DEEP`` levels above its nodes."""
    found = [nodes]
    whole = first and len(nodes) < BLOCK
    while len(found[-1]) > 1 if whole else len(found) <= DEEP:
        below = found[-1]
        found.append([digest(below[i:i + FAN]) for i in range(0, len(below), FAN)])
    return found


def steps(tree: list[list[str]], i: int) -> list[dict[str, str]]:
    """The siblings of node ``i`` on each level of its block."""
    found = []
    for nodes in tree[:-1]:
        lo = i - i % FAN
        found.append({"before": "".join(nodes[lo:i]), "after": "".join(nodes[i + 1:lo + FAN])})
        i //= FAN
    return found


def copied(path: list[dict[str, str]], leaf: str) -> list[str]:
    """The nodes of the version that ``leaf`` makes: itself and the copies
    of its ancestors; all other nodes stay those of the first version."""
    found = [leaf]
    for step in path:
        found.append(digest((step["before"], found[-1], step["after"])))
    return found


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(cell[0][0], cell[0][1], levels([r[3] for r in cell], cell[0][1] == 0)[-1][0]) for cell in cells_of(batches, 2)]
    cols = list(zip(*rows)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["tree", "at", "digest"])


_ARROW = pa.schema([
    ("tree", pa.string()), ("at", pa.int64()), ("doc_id", pa.int64()), ("leaf", pa.string()), ("changed", pa.string()),
    ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
    ("subroot", pa.string()), ("root", pa.string()), ("version", pa.list_(pa.string()))])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the row of their upper path first (none in the round of
    the root): every node with its whole path and its version."""
    for cell in cells_of(batches, 2):
        upper, subroot, root = [], None, None
        if cell[0][2] < 0:
            *_, upper, subroot, root = cell[0]
            cell = cell[1:]
        tree = levels([r[3] for r in cell], cell[0][1] == 0)
        subroot, root = subroot or tree[-1][0], root or tree[-1][0]
        out = []
        for i, (key, _, at, leaf, doc_id, changed, *_) in enumerate(cell):
            path = steps(tree, i) + upper
            out.append((key, at, doc_id, leaf, changed, path, subroot, root, copied(path, changed or leaf)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)


def _blocks(nodes: DataFrame, upper: DataFrame | None = None) -> DataFrame:
    """Nodes (and the paths above their blocks) brought together by block."""
    have = nodes.columns
    rows = nodes.select(
        "tree", F.expr(f"at div {BLOCK}").alias("block"), "at", "digest",
        *[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("changed", "string"))],
        F.lit(None).cast(_STEP).alias("path"), F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"))
    if upper is not None:
        rows = rows.unionByName(upper.select(
            "tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("digest"),
            F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("changed"), "path", "subroot", "root"))
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at").select(*_NODE)


def _rounds(spark: SparkSession, nodes: DataFrame) -> list[DataFrame]:
    """Nodes of each round, the given ones first and one node a tree last."""
    found = [nodes]
    while True:
        tops = table(spark, _blocks(found[-1]).mapInArrow(_tops, "tree string, at long, digest string"))
        found.append(tops)
        if not tops.where("at > 0").limit(1).count():
            return found


def _downwards(spark: SparkSession, rounds: list[DataFrame], upper: DataFrame | None) -> DataFrame:
    """The nodes of the first round with their paths; ``upper`` holds the
    paths of the trees' last nodes, if these are leaves of another tree."""
    for nodes in reversed(rounds[1:-1]):
        upper = table(spark, _blocks(nodes, upper).mapInArrow(_paths, _DOWN).select("tree", "at", "path", "subroot", "root"))
    return _blocks(rounds[0], upper).mapInArrow(_paths, _DOWN)


def field(c: str | Column) -> Column:
    """A field as hashed: ``-`` if null, else byte count, colon, value."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def versions(spark: SparkSession, docs: DataFrame, tampered: Column | None = None, changed_text: Column | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text;
    other columns are ignored): doc_id, leaf, changed (the leaf with
    ``changed_text`` where ``tampered`` holds, else null), subroot, root,
    path (before, after: sibling digests joined, level by level up to the
    root) and version (the changed, else the original leaf and the copies
    of its ancestors; the last is the root of that version).

    A null source is a source of its own and comes first; null ids come
    first in their source, and rows of equal id are ordered by leaf, so
    equal rows are interchangeable. Empty tables give no rows. A source
    without limit is spread over blocks of ``BLOCK`` leaves.
    """
    leaf = F.sha2(F.concat(*[field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]), 256)
    other = F.lit(None).cast("string")
    if tampered is not None:
        fields = [*[field(c) for c in ("doc_id", "source", "lang", "n_chars")], field(changed_text)]
        other = F.when(tampered, F.sha2(F.concat(*fields), 256))
    rows = docs.select(F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf.alias("digest"), other.alias("changed"))
    numbered = number_rows(rows, ["tree"], [("doc_id", True), ("digest", True), ("changed", True)])
    leaves = table(spark, numbered.withColumn("at", F.col("rn") - 1).drop("rn"))
    sources = _rounds(spark, leaves)
    subroots = number_rows(sources[-1].select(F.col("tree").alias("name"), "digest"), [], [("name", True)])
    subroots = table(spark, subroots.select(F.lit("").alias("tree"), (F.col("rn") - 1).alias("at"), "digest", "name"))
    above = _downwards(spark, _rounds(spark, subroots.drop("name")), None)
    upper = table(spark, above.join(subroots.select("at", "name"), "at").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("at"), "path", F.col("leaf").alias("subroot"), "root"))
    return _downwards(spark, sources, upper).select("doc_id", "leaf", "changed", "subroot", "root", "path", "version")
