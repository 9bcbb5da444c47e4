"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm import (
    licenses,
    merkle,
    mixing,
    multiset,
    negatives,
    packing,
    pii,
    quality,
    simhash,
    substrings,
    suffixes,
    toxicity,
    vectors,
)
from perigee.llm.oracles import ORACLES  # noqa: F401 - for those who register the queries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, which every machine has."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = substrings.without_repeats(documents(spark, sf_dir))
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op2_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = suffixes.without_repeats(documents(spark, sf_dir))
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query
def op7_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.fingerprints(documents(spark, sf_dir))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op9_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.personal_data(documents(spark, sf_dir), ["doc_id"])
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    digest = F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256")
    spans = pii.listed(F.col("spans")).alias("spans")
    return rows.select(F.col("row.doc_id").alias("doc_id"), *counts, digest, spans)


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.tampered(documents(spark, sf_dir), changed)
    proof = merkle.proof_of(F.col("path")).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors_ = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(vectors_.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(documents(spark, sf_dir))
