"""Tasks keep their size as the tables grow, and sources are evaluated once."""

import pytest
from pyspark.sql import functions as F

from rankwalk.operators import graph as gr, markov, pagerank as pr, sequence, traversal


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(sequence, "ROWS_PER_TASK", 100)


def tasks(df):
    """Partitions that hold rows, as Spark runs the plan."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def counted(spark, rows, schema):
    """The rows, and how many of them have been computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def note(row):
        seen.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(note), schema), seen


def test_loop_partitions_follow_the_links(spark):
    assert pr.loop_partitions(spark, 36_000_000) == 36
    assert pr.loop_partitions(spark, 432_000_000) == 432


def test_a_null_end_is_a_node_without_links(spark):
    edges = spark.createDataFrame([("a", "b", 1), (None, "b", 2), ("b", None, 1)], "src string, dst string, cnt bigint")
    prepared = pr.prepare(gr.Graph(edges))
    try:
        found = {r["id"]: (r["dangling"], r["out_degree"]) for r in prepared.vertices.collect()}
        assert found == {"a": (False, 1.0), "b": (False, 1.0), None: (True, 0.0)}
    finally:
        prepared.release()


def test_record_links_are_merged_in_tasks_of_even_size(spark, small_tasks):
    records = spark.range(500).select((F.col("id") % 90).cast("string").alias("node"),
                                      F.create_map(F.col("id").cast("string"), F.lit(1), F.lit("x"), F.lit(2)).alias("links"))
    assert tasks(gr.edges_from_records(records)) == 10
    edges = gr.graph_from_records(records).edges
    assert tasks(edges) == 10 and edges.agg(F.sum("cnt")).first()[0] == 500 + 2 * 90


def test_pairs_are_summed_in_tasks_of_even_size(spark, small_tasks):
    rows = spark.range(1000).select(F.lit(1).alias("g"), F.col("id").alias("o"), F.col("id").alias("v"))
    found = sequence.consecutive_pairs(rows, "g", ["o"], "v")
    assert tasks(found) == 10 and found.count() == 999


def test_strong_components_evaluate_their_edges_once(spark):
    links = [("a", "b", 1), ("b", "a", 1), ("b", "c", 1), ("c", "d", 1)]
    edges, seen = counted(spark, links, "src string, dst string, cnt bigint")
    found = {r["id"]: r["component"] for r in traversal.strong_components(gr.Graph(edges)).collect()}
    assert found == {"a": "a", "b": "a", "c": "c", "d": "d"} and seen.value == len(links)


def test_chain_structure_evaluates_its_edges_once(spark):
    links = [("a", "b", 1), ("b", "a", 1), ("b", "c", 1)]
    edges, seen = counted(spark, links, "src string, dst string, cnt bigint")
    found = {r["component"]: r["period"] for r in traversal.chain_structure(gr.Graph(edges)).collect()}
    assert found == {"a": 2, "c": None} and seen.value == len(links)


def test_blocks_are_read_and_joined_a_few_at_a_time(spark, monkeypatch):
    seen, product = [], markov.matrix_product
    names = ["spark.sql.parquet.columnarReaderBatchSize", "spark.sql.sortMergeJoinExec.buffer.in.memory.threshold"]

    def noted(a, b):
        seen.append([int(spark.conf.get(n)) for n in names])
        return product(a, b)

    monkeypatch.setattr(markov, "matrix_product", noted)
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, cnt bigint")
    found = {r["id"]: r["mass"] for r in markov.power_iteration_squaring(gr.Graph(edges), 1).collect()}
    assert found == {"a": 1.0, "b": 0.0} and all(n <= markov.BATCH for n in seen[0])
