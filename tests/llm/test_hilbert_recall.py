"""The windows of the curves alone: recall against brute force, copies, ends of curves."""

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import hilbert


def _frame(spark, v, kind="float"):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], f"vec_id long, embedding array<{kind}>")


def test_recall_of_directions_without_structure(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "LEAST", 16)
    monkeypatch.setattr(hilbert, "SLICE", 256)              # windows reach over several slices
    v = np.random.default_rng(4).standard_normal((2400, 24)).astype(np.float32).astype(np.float64)
    got = hilbert.nearest(spark, _frame(spark, v), lambda c: c % 20 == 0, k=20, exact=False).collect()
    q = np.arange(0, 2400, 20)
    s = v[q] @ v.T
    s[np.arange(len(q)), q] = -np.inf
    true = {int(i): set(np.argsort(-row)[:20].tolist()) for i, row in zip(q, s)}
    assert len(got) == 20 * len(q) == len({(r.query_id, r.rank) for r in got}) == len({(r.query_id, r.vec_id) for r in got})
    assert sum(r.vec_id in true[r.query_id] for r in got) >= 0.9 * len(got)
    for r in got:
        assert r.vec_id != r.query_id and r.score == pytest.approx(float(v[r.query_id] @ v[r.vec_id]), rel=1e-12)


def test_copies_are_one_node(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((300, 8))
    v[::3] = v[0] * 3                                       # a third of all rows; the largest product of each of them
    v[3] = -0.0 + v[3]
    got = {}
    for r in sorted(hilbert.nearest(spark, _frame(spark, v, "double"), lambda c: c % 20 == 0, k=4, exact=False).collect(),
                    key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(range(0, 300, 20))
    for q in range(0, 300, 60):
        assert got[q] == [i for i in range(0, 18, 3) if i != q][:4]


def test_signs_of_zero_and_few_rows(spark):
    rows = [(0, [0.0, 1.0]), (1, [-0.0, 1.0]), (2, [1.0, -0.0]), (40, [5.0]), (60, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in hilbert.nearest(spark, df, lambda c: c % 20 == 0, exact=False).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]
    assert hilbert.nearest(spark, df.where("vec_id = 1"), lambda c: c % 20 == 0, exact=False).count() == 0
    assert hilbert.nearest(spark, df.limit(0), lambda c: c % 20 == 0, exact=False).count() == 0


def test_places_are_the_order_of_the_keys(spark):
    v = np.random.default_rng(6).standard_normal((500, 8))
    nodes = (_frame(spark, v, "double").selectExpr("vec_id as id", "true as asked", "embedding as v")
             .mapInArrow(hilbert._nodes("<f8"), "id long, asked boolean, dim int, vec binary, code binary, unit double"))
    got = {(r.curve, r.id): r.pos for r in hilbert.places(spark, nodes, "<f8").collect()}
    for c in range(hilbert.CURVES):
        order = np.lexsort((np.arange(500), hilbert.curve_keys(v, c)))
        assert [got[c, int(i)] for i in order] == list(range(500))


def test_a_slice_that_spans_batches():
    v = np.eye(4, dtype=np.int8)

    def batch(query, pos, ids, rows):
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([0] * n, pa.int32()), pa.array([4] * n, pa.int32()), pa.array([0] * n), pa.array([query] * n, pa.int32()), pa.array(pos),
             pa.array(ids), pa.array([x.tobytes() for x in rows], pa.binary()), pa.array([1.0] * n)],
            names=["curve", "dim", "slice", "query", "pos", "id", "code", "unit"])
    parts = [batch(0, [0, 1], [10, 11], v[:2]), batch(0, [2, 3], [12, 13], v[2:]), batch(1, [1], [11], v[1:2]), batch(1, [3], [13], v[3:])]
    got = [tuple(r.values()) for b in hilbert._slices(9, 1)(iter(parts)) for r in b.to_pylist()]
    assert {(q, i) for q, i, _ in got} == {(11, 10), (11, 12), (13, 12)}
