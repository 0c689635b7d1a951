"""The registered queries of this subpackage, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontamination, jaccard_join, licenses, line_dedup, manifest, near_dedup, oracle, packing, quality_classifier,
               quality_rules, sharding, substring_dedup, url_filter, whitening)

# The rules of op9, in the order (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents")).drop("text")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.benchmark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.merkle_manifest(_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality_rules, op2_line_dedup, op3_quality_classifier, op4_license_scan, op5_substring_dedup, op6_jaccard_join, op7_sharding, op8_decontamination,
    op9_url_filter, op10_packing, op11_minhash_near_dedup, op12_merkle_manifest, op13_embedding_whitening)}


def oracles() -> dict[str, str]:
    return {
        "op1_quality_rules": oracle.quality_rules(), "op2_line_dedup": oracle.line_dedup(),
        "op4_license_scan": oracle.license_scan(), "op5_substring_dedup": oracle.substring_dedup(),
        "op6_jaccard_join": oracle.jaccard_components(), "op7_sharding": oracle.balanced_shards(), "op8_decontamination": oracle.benchmark_leaks(),
        "op9_url_filter": oracle.url_filter(URL_RULES), "op10_packing": oracle.packed(),
        "op11_minhash_near_dedup": oracle.near_duplicates(), "op12_merkle_manifest": oracle.merkle_manifest(),
    }
