"""Adjacency-text and index sources, including the edge cases of the format."""

import os

import pytest

from conftest import SF_SMALL, write_lines
from rankwalk.operators import eda, graph as gr, pagerank as pr
from rankwalk.sources import adjacency, index, inventory


def edges_of(spark, path):
    g = gr.graph_from_records(adjacency.read_adjacency(spark, path))
    return g, {(r["src"], r["dst"]): r["cnt"] for r in g.edges.collect()}


def test_parse_roundtrip_and_types(spark, tmp_dir):
    path = write_lines(tmp_dir, ["5\t{'4': 3, '2': 1, '6': 1}"])
    rec = adjacency.read_adjacency(spark, path)
    assert rec.schema.simpleString() == "struct<node:string,links:map<string,bigint>>"
    assert rec.first()["links"] == {"4": 3, "2": 1, "6": 1}


def test_empty_dict_is_a_sink_and_a_record(spark, tmp_dir):
    path = write_lines(tmp_dir, ["a\t{}", "b\t{'a': 2}"])
    records = adjacency.read_adjacency(spark, path)
    g, e = edges_of(spark, path)
    assert e == {("b", "a"): 2}
    assert {r["id"] for r in gr.dangling(g).collect()} == {"a"}
    avg = eda.average_degree(eda.record_degrees(records)).first()
    assert (avg["records"], avg["avg_out_degree"]) == (2, 1.0)


def test_self_loop_single_node_rank_one(spark, tmp_dir):
    path = write_lines(tmp_dir, ["a\t{'a': 1}"])
    g, _ = edges_of(spark, path)
    assert [(r["id"], r["rank"]) for r in pr.pagerank(g, max_iter=5).collect()] == [("a", 1.0)]


def test_sinks_only(spark, tmp_dir):
    path = write_lines(tmp_dir, ["a\t{}", "b\t{}"])
    g, _ = edges_of(spark, path)
    for steps in (0, 1, 3):
        assert sorted(r["rank"] for r in pr.pagerank(g, max_iter=steps).collect()) == [0.5, 0.5]


def test_repeated_lines_merge_as_sets(spark, tmp_dir):
    _, same = edges_of(spark, write_lines(os.path.join(tmp_dir, "s"), ["a\t{'b': 2}", "a\t{'b': 2}"]))
    assert same == {("a", "b"): 2}
    _, other = edges_of(spark, write_lines(os.path.join(tmp_dir, "o"), ["a\t{'b': 2}", "a\t{'b': 3}"]))
    assert other == {("a", "b"): 5}


def test_duplicate_key_last_wins(spark, tmp_dir):
    _, e = edges_of(spark, write_lines(tmp_dir, ["a\t{'b': 2, 'b': 3}"]))
    assert e == {("a", "b"): 3}


def test_zero_count_dropped(spark, tmp_dir):
    g, e = edges_of(spark, write_lines(tmp_dir, ["a\t{'b': 0}"]))
    assert e == {}
    assert {r["id"] for r in gr.dangling(g).collect()} == {"a", "b"}


def test_malformed_failfast_and_permissive(spark, tmp_dir):
    path = write_lines(tmp_dir, ["a\t{'b': 1", "c\t{'d': 1}", "e\tx\ty"])
    with pytest.raises(Exception):
        adjacency.read_adjacency(spark, path).collect()
    parsed = adjacency.parse_adjacency(adjacency.read_lines(spark, path), mode="PERMISSIVE")
    good, bad = adjacency.split_rejects(parsed)
    assert [r["node"] for r in good.collect()] == ["c"]
    assert sorted(r["line"] for r in bad.collect()) == ["a\t{'b': 1", "e\tx\ty"]


def test_render_keeps_a_hub_on_one_record(spark, tmp_dir):
    rows = [("h", f"t{i:05d}", i % 3 + 1) for i in range(25_000)] + [("x", "h", 1)]
    edges = spark.createDataFrame(rows, "src string, dst string, cnt bigint")
    path = os.path.join(tmp_dir, "hub")
    adjacency.render_adjacency(edges).write.text(path)
    assert adjacency.read_adjacency(spark, path).count() == 2
    _, back = edges_of(spark, path)
    assert back == {(s, d): c for s, d, c in rows}


def test_index_source(spark, tmp_dir):
    path = write_lines(tmp_dir, ["Alpha page\t1\t3\t2", "Beta\t20\t0\t1"])
    idx = index.read_index(spark, path)
    assert sorted(map(tuple, idx.collect())) == [("1", "Alpha page", 3, 2), ("20", "Beta", 0, 1)]


def test_inventory_lists_parquet_tables(spark):
    files = inventory.list_files(spark, SF_SMALL)
    names = {r["name"] for r in files.collect()}
    assert {"lineitem.parquet", "orders.parquet"} <= names
    total = inventory.directory_size(files).first()
    assert total["files"] == len(names) and total["bytes"] > 0


def test_render_escapes_awkward_ids_both_readers_agree(spark, tmp_dir):
    import ast
    rows = [("a", "it's", 1), ("a", 'say "hi"', 2), ("b", "back\\slash", 3), ("c", "plain", 1)]
    edges = spark.createDataFrame(rows, "src string, dst string, cnt bigint")
    lines = [r["value"] for r in adjacency.render_adjacency(edges).collect()]
    assert "c\t{'plain': 1}" in lines                  # the source format where it can be
    python_view = {}
    for line in lines:
        node, links = line.split("\t")
        for k, v in ast.literal_eval(links).items():
            python_view[(node, k)] = v
    path = os.path.join(tmp_dir, "awkward")
    adjacency.render_adjacency(edges).write.text(path)
    _, spark_view = edges_of(spark, path)
    assert spark_view == python_view == {(s, d): c for s, d, c in rows}
