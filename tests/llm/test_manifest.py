"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F

from quire.llm import merkle
from quire.llm.queries import op11_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, at long, digest string, root int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """The top of a tree and, for each node, its siblings by level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(place):
            lo = at - at % 3
            paths[i].append((nodes[lo:at], nodes[at + 1:lo + 3]))
            place[i] = at // 3
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(((r, leaf(*r)) for r in rows if r[3] == s), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s in sources}
    tops = {s: climb([d for _, d in t]) for s, t in trees.items()}
    root, upper = climb([tops[s][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        for (r, d), path in zip(trees[s], tops[s][1]):
            path = path + upper[i]
            other = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                other = leaf(r[0], None if r[1] is None else r[1].replace("\n", ""), *r[2:])
            for before, after in path:
                other = h(*before, other, *after)
            proof = h(*[x for before, after in path for x in (*before, *after)])
            out.append((r[0], d, tops[s][0], root, proof, other, other == root))
    return sorted(out, key=str)


def rows_of(seed, counts):
    rng, rows = random.Random(seed), []
    for source, n in counts.items():
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "é\n\n", f"t{rng.random()}\nx", "plain"])
            rows.append((rng.choice([None, rng.randrange(10**6), 7]) if rng.random() < 0.1 else rng.randrange(10**9), text,
                         rng.choice([None, "en"]), source, rng.choice([None, 3])))
    return rows


@pytest.mark.parametrize("counts", [{"a": 1}, {None: 2, "": 1, "b": 3, "é": 4, "z": 9}, {"hot": 2 * 243 + 1, "x": 243, "y": 244, None: 5},
                                    {f"s{i}": 1 for i in range(250)}])
def test_against_plain_tree(spark, tmp_path, counts):
    rows = rows_of(3, counts)
    rows += rows[:1]
    spark.createDataFrame([(*r, "t", 5, "d", 1) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_merkle(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)


def test_versions(spark):
    rows = rows_of(5, {"a": 700, "b": 2})
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert merkle.versions(spark, docs.limit(0)).count() == 0
    for r in merkle.versions(spark, docs, F.col("doc_id") % 2 == 0, F.lit("other")).collect():
        assert len(r.version) == len(r.path) + 1 and r.version[0] == (r.changed or r.leaf)
        assert (r.version[-1] == r.root) == (r.changed is None) and r.version[-2 if r.subroot != r.root else -1] is not None


def test_slices_do_not_matter(spark):
    docs = spark.createDataFrame(rows_of(9, {"a": 300, None: 40}), "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(str, merkle.versions(spark, docs.repartition(int(n))).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
