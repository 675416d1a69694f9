"""Shared pieces: intermediate tables, Arrow text buffers, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quire.session import ensure_checkpoint_dir

U = np.uint64
MAX64 = U(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir``
    and read it back: the lineage is cut, the rows are computed once, and
    a lost executor costs a re-read."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tables(sf_dir: str, spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and odd multipliers); returns a new array."""
    x = x ^ (x >> U(31))
    x *= U(0x9E3779B97F4A7C15)
    x ^= x >> U(29)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets (a null
    is an empty text); nothing is copied."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    if offsets is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off.astype(np.int64)


def runs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def binary(rows: list[bytes | None]) -> pa.Array:
    return pa.array(rows, pa.binary())


def cells_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """The rows of each run of equal values in the first ``keys`` columns
    of sorted batches; one run is held at a time."""
    last, part = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != last:
                if part:
                    yield part
                last, part = row[:keys], []
            part.append(row)
    if part:
        yield part
