"""Vectors that take part, one row per id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")


def finite(x: Column) -> Column:
    """A number of a vector is there and finite."""
    return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < INF)


def valid(df: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """id, the columns ``more`` and v (array<double>) of the vectors that
    are not null, not zero and have finite components only. Of several
    rows of one id the smallest counts; rows without an id do not."""
    v = df[vec_col].cast("array<double>")
    rows = df.select(df[id_col].cast("long").alias("id"), *(df[c].alias(c) for c in more), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INF)) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & fine)
    return rows.groupBy("id").agg(F.min(F.struct(*more, "v")).alias("own")).select("id", "own.*")


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """A list column whose rows all have ``dim`` numbers, as rows."""
    return np.asarray(col.flatten()).reshape(-1, dim).astype(np.float64)
