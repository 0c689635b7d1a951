"""The corpus pipeline: documents to packed training batches in five stages.

quality rules -> line dedup -> near-duplicate groups (one document of each
stays) -> benchmark decontamination -> packing.  Each stage is one operator
of ``rankwalk.llm`` applied to all that its predecessor kept; its output is
written as Parquet and read again.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankwalk.llm import decontamination, jaccard_join, line_dedup, oracle, packing, quality_rules
from rankwalk.llm.common import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filtered(docs)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share are cut from all of them."""
    return line_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document that is left."""
    return packing.packed(docs)


STAGES = [("quality_rules", keep_quality), ("line_dedup", drop_common_lines), ("ngram_jaccard_join", drop_near_copies),
          ("benchmark_decontamination", drop_benchmark_leaks), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


ORACLE_SQL = oracle.packed(f"({oracle.without_leaks(f'({oracle.one_of_each(f"({oracle.lines_kept(f"({oracle.quality_kept('documents')})")})")})')})")
