"""A large group of copies is packed in bounded runs and split over tasks."""

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import hilbert


def test_packed_holds_one_run():
    read = []

    def batches():
        for b in range(10):
            read.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array([2] * 4, pa.int32()), pa.array(range(4 * b, 4 * b + 4), pa.int64()),
                 pa.array([np.ones(2).tobytes()] * 4, pa.binary())], names=["dim", "id", "vec"])
    out = hilbert._packed(4, False)(batches())
    first = next(out)
    assert read == [0, 1]                      # not all rows of the dim
    ids = [i for b in (first, *out) for i in np.frombuffer(b.column(1)[0].as_py(), np.int64).tolist()]
    assert ids == list(range(40))


def test_packed_parts_dims():
    b = pa.RecordBatch.from_arrays(
        [pa.array([1, 1, 2], pa.int32()), pa.array([1, 2, 3], pa.int64()),
         pa.array([np.ones(1).tobytes(), np.ones(1).tobytes(), np.ones(2).tobytes()], pa.binary())], names=["dim", "id", "vec"])
    assert [(r.column(0)[0].as_py(), len(r.column(1)[0].as_py()) // 8) for r in hilbert._packed(1024, False)(iter([b]))] == [(1, 2), (2, 1)]


def test_copies_are_split(spark, monkeypatch):
    keys, ranged = [], type(spark.range(0)).repartitionByRange

    def seen(self, n, *cols):
        keys.append(cols)
        return ranged(self, n, *cols)
    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", seen)
    df = spark.createDataFrame([(i, [1.0, 0.5, 0.25]) for i in range(60)], "vec_id long, embedding array<double>")
    got = hilbert.nearest(spark, df, lambda c: c % 20 == 0, k=5).collect()
    assert len(keys) == 3 and all(c[-1] == "id" for c in keys)
    assert sorted((r.query_id, r.vec_id) for r in got) == sorted((q, v) for q in (0, 20, 40) for v in [i for i in range(6) if i != q][:5])
