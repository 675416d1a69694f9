"""Decisions of the pipeline's stages where rows share an id."""

import random

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import minhash, toxicity

SCHEMA = "doc_id long, text string, own string, print string, score int"


def test_rows_without_an_own_id(spark):
    rng = random.Random(3)
    clean = lambda: " ".join("".join(rng.choice("abcdelnorst") for _ in range(6)) for _ in range(30))
    rows = [(i, clean() + (" you idiot moron scum" if i % 3 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    bad, good = clean() + " you idiot moron scum", clean()
    extra = [(None, bad), (None, good), (7, bad), (7, good), (None, None), (None, "")]
    df = spark.createDataFrame([(*r, "o", "p", 1) for r in rows + extra], SCHEMA)
    left = toxicity.drop_toxic(spark, df, labels)
    assert left.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert got == sorted([r for r in rows + extra if "scum" not in (r[1] or "")], key=str)


def test_one_row_of_a_class(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (5, a), (5, b), (5, a + " end"), (6, b), (9, "x y"), (9, "x y"), (9, "other text"), (None, "n n n"), (None, "n n n"), (None, "N n n"),
            (None, None), (None, ""), (3, " "), (3, " "), (None, b.upper())]
    df = spark.createDataFrame([(*r, "o", "p", 1) for r in rows], SCHEMA)
    left = minhash.deduplicate(spark, df)
    assert left.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    n = [x for x in got if x[0] is None and (x[1] or "").strip()]
    assert len(n) == 1 and n[0][1].lower() == "n n n"
    assert [x for x in got if x not in n] == sorted([(1, a), (5, b), (9, "x y"), (9, "other text"), (None, None), (None, ""), (3, " "), (3, " ")], key=str)
    assert minhash.deduplicate(spark, df.limit(0)).count() == 0
