"""Queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, decontam, divergence, jaccard, langid, licenses, media, mixing, pieces, pii, quality, secretscan, sharding


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(_table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(_table(spark, sf_dir, "documents"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(_table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.digest(_table(spark, sf_dir, "documents"))


_ALL = (op1_mixing, op2_quality, op3_language_id, op4_license_scan, op5_ngram_jaccard, op6_decontamination, op7_secret_scan, op8_pii, op9_media, op10_sharding, op11_pieces, op12_centroids, op13_divergence)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
ORACLES: dict[str, str] = {"op1_mixing": mixing.oracle(), "op4_license_scan": licenses.oracle(), "op5_ngram_jaccard": jaccard.oracle(), "op12_centroids": centroids.oracle(), "op13_divergence": divergence.oracle()}
