"""End to end from files: adjacency text (+ optional page index) -> ranked,
titled top-k.  This is the notebook's whole path - parse, initialise, iterate,
take the top 20, join titles, format - as one call over Spark DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import graph as gr, pagerank as pr, report
from ..sources.adjacency import read_adjacency
from ..sources.index import read_index, titles


def rank_adjacency_text(spark: SparkSession, adjacency_path: str | list[str],
                        index_path: str | list[str] | None = None, alpha: float = 0.15,
                        max_iter: int = 10, k: int = 20, mode: str = "FAILFAST",
                        checkpoint_every: int = 1) -> DataFrame:
    """(id, title, rank) of the ``k`` highest-ranked pages, highest first.
    Without an index the title column is NULL."""
    records = read_adjacency(spark, adjacency_path, mode=mode)
    ranks = pr.pagerank(gr.graph_from_records(records), alpha, max_iter,
                        checkpoint_every=checkpoint_every)
    top = report.topk(ranks, k)
    if index_path is None:
        names = spark.createDataFrame([], "id string, title string")
        return report.with_titles(top, names, how="left")
    return report.with_titles(top, titles(read_index(spark, index_path, mode=mode)))


def ranked_report_lines(titled: DataFrame) -> DataFrame:
    """(position, line) of a titled top-k, formatted as ``rank | id | title``."""
    return report.ranked_lines(titled)
