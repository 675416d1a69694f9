"""The queries of the operators: each applies one, with its production
parameters, to the whole table and returns the whole result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (
    chat, hilbert, itq, merkle, minhash, mixing, pages, pieces, repeats, secrets, spelling, toxicity, wordpiece)
from quire.llm.common import tables

PIECES = "piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(tables(sf_dir, spark, "documents"), public_tokenizers.path(PIECES))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_turns(spark, tables(sf_dir, spark, "conversations"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, tables(sf_dir, spark, "documents"), shingle_words=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op4_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(spark, tables(sf_dir, spark, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(spark, tables(sf_dir, spark, "documents"), tables(sf_dir, spark, "labels"))


def op6_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(spark, tables(sf_dir, spark, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20, exact=False)


def op7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(spark, tables(sf_dir, spark, "pages"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.encode(tables(sf_dir, spark, "documents"), public_tokenizers.path(PIECES)))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, tables(sf_dir, spark, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(spark, tables(sf_dir, spark, "documents")).select(
        "doc_id", "start", "stop", "kind", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score", "secret")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = merkle.versions(spark, tables(sf_dir, spark, "documents"), tampered, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    siblings = F.transform("path", lambda step: F.concat(step["before"], step["after"]))
    folded = F.element_at("version", -1)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
                        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(sf_dir, spark, "documents")
    texts = repeats.cleaned(spark, docs, length=35).select(
        "text_key", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return repeats.by_document(docs, texts).select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_words", "n_removed")],
        F.coalesce("kept_sha256", F.sha2(F.lit(""), 256)).alias("kept_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, tables(sf_dir, spark, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_chat, op3_minhash, op4_itq, op5_toxicity, op6_hilbert, op7_pages, op8_sentencepiece,
        op9_mixing, op10_secrets, op11_merkle, op12_repeats, op13_spelling)}
