"""In-memory graph literal -> DataFrames (for fixtures and small examples).

A literal is ``{"nodes": [...], "edges": [(src, dst), ...]}``; the rows are
handed to ``createDataFrame`` with an explicit schema.  Only bounded, hand-
written inputs belong here - real graphs come from a scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.graph import Graph, edges_from_pairs

NODE_SCHEMA = "id STRING"
EDGE_SCHEMA = "src STRING, dst STRING"


def literal_frames(spark: SparkSession, literal: dict) -> tuple[DataFrame, DataFrame]:
    nodes = spark.createDataFrame([(str(n),) for n in literal["nodes"]], NODE_SCHEMA)
    edges = spark.createDataFrame([(str(a), str(b)) for a, b in literal["edges"]], EDGE_SCHEMA)
    return nodes, edges


def graph_from_literal(spark: SparkSession, literal: dict) -> Graph:
    nodes, edges = literal_frames(spark, literal)
    return Graph(edges_from_pairs(edges, "src", "dst"), nodes)
