"""A corpus pipeline: toxic documents go, one document of each group of
near-duplicates stays, secrets are masked, sources are mixed to target
weights, and the mix is encoded into pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and reads it again as
the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm import minhash, mixing, pieces, secrets, toxicity
from quire.llm.common import table, tables
from quire.llm.queries import PIECES


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(spark, docs, tables(sf_dir, spark, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(spark, docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(spark, docs, length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pieces.encode(docs, public_tokenizers.path(PIECES))
    return pieces.digest(found)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic), ("minhash", deduplicate), ("secrets", mask_secrets), ("mixing", mix_sources),
    ("sentencepiece", encode)]

# trees, sketches and pieces are beyond SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(sf_dir, spark, "documents")
    for _, stage in STAGES:
        docs = table(spark, stage(spark, docs, sf_dir))
    return docs
