"""Published results of the textbook graphs and the 11-node test graph."""

import pytest
from pyspark.sql import functions as F

from conftest import TEST11_LINES, TOY1, TOY2, write_lines
from rankwalk.operators import eda, graph as gr, markov, pagerank as pr
from rankwalk.sources.adjacency import read_adjacency
from rankwalk.sources.literal import graph_from_literal

# Steady state of TOY1 (A..E) and the 20-step ranks of the
# 11-node graph at alpha 0.15.
TOY1_STEADY = {"A": 2 / 19, "B": 3 / 19, "C": 3.5 / 19, "D": 4.5 / 19, "E": 6 / 19}
TOY1_PRINTED = {"A": 0.10526316, "B": 0.15789474, "C": 0.18421053, "D": 0.23684211, "E": 0.31578947}
TEST11_GOLDEN = {
    "2": 0.3620640495978871, "3": 0.333992700474142, "5": 0.08506399429624555,
    "4": 0.06030963508473455, "1": 0.04255740809817991, "6": 0.03138662354831139,
    "7": 0.01692511778009981, "8": 0.01692511778009981, "9": 0.01692511778009981,
    "10": 0.01692511778009981, "11": 0.01692511778009981,
}
TOY2_MASS = [1.0, 0.8, 0.6, 0.43333333, 0.31666667, 0.22222222, 0.16111111,
             0.11203704, 0.08101852, 0.05617284, 0.04058642]


def as_dict(df, key="id", value="rank"):
    return {r[key]: r[value] for r in df.collect()}


@pytest.fixture(scope="module")
def test11(spark, tmp_path_factory):
    path = write_lines(str(tmp_path_factory.mktemp("test11")), TEST11_LINES)
    records = read_adjacency(spark, path)
    return records, gr.graph_from_records(records)


def test_toy1_power_iteration_reaches_steady_state(spark):
    g = graph_from_literal(spark, TOY1)
    mass = as_dict(markov.power_iteration(g, 50, start="first"), value="mass")
    for k, v in TOY1_STEADY.items():
        assert abs(mass[k] - v) < 1e-8
        assert round(mass[k], 8) == TOY1_PRINTED[k]


def test_toy1_squaring_matches_steady_state(spark):
    g = graph_from_literal(spark, TOY1)
    mass = as_dict(markov.power_iteration_squaring(g, 10, start="first"), value="mass")
    for k, v in TOY1_PRINTED.items():
        assert round(mass[k], 8) == v


def test_squaring_fallback_equals_dense(spark):
    g = graph_from_literal(spark, TOY1)
    dense = as_dict(markov.power_iteration_squaring(g, 3), value="mass")
    sparse = as_dict(markov.power_iteration_squaring(g, 3), value="mass")
    plain = as_dict(markov.power_iteration(g, 8), value="mass")
    for k in dense:
        assert abs(dense[k] - sparse[k]) < 1e-15
        assert abs(dense[k] - plain[k]) < 1e-15


def test_toy2_mass_leaks_through_sink(spark):
    g = graph_from_literal(spark, TOY2)
    trace = sorted(markov.mass_trace(g, 10).collect())
    assert [round(r["total_mass"], 8) for r in trace] == TOY2_MASS


def test_toy2_transition_matrix_has_no_sink_row(spark):
    g = graph_from_literal(spark, TOY2)
    t = markov.transition_matrix(g).collect()
    assert {r["src"] for r in t} == {"A", "B", "C", "D"}
    rows = {}
    for r in t:
        rows[r["src"]] = rows.get(r["src"], 0.0) + r["prob"]
    assert all(abs(v - 1.0) < 1e-15 for v in rows.values())


def test_adjacency_matrix_and_list(spark):
    g = graph_from_literal(spark, TOY1)
    m = {(r["src"], r["dst"]) for r in markov.adjacency_matrix(g).collect()}
    assert m == set(TOY1["edges"])
    lists = {}
    for r in sorted(gr.adjacency_list(g).collect()):
        lists.setdefault(r["id"], []).append(r["neighbor"])
    assert lists == {"A": ["B", "D"], "B": ["C", "E"], "C": ["D"], "D": ["E"], "E": ["A", "B", "C"]}


def test_test11_pagerank_golden(spark, test11):
    _, g = test11
    ranks = as_dict(pr.pagerank(g, alpha=0.15, max_iter=20))
    assert set(ranks) == set(TEST11_GOLDEN)
    for k, v in TEST11_GOLDEN.items():
        assert abs(ranks[k] - v) < 1e-12, (k, ranks[k], v)
    top = [r["id"] for r in pr.pagerank(g, max_iter=20).orderBy(F.desc("rank"), "id").limit(6).collect()]
    assert top == ["2", "3", "5", "4", "1", "6"]


def test_test11_eda(spark, test11):
    records, g = test11
    assert eda.record_count(g).first()["records"] == 10
    assert eda.count_nodes(g).first()["nodes"] == 11
    dc = eda.dangling_count(g).first()
    assert (dc["nodes"], dc["records"], dc["dangling"]) == (11, 10, 1)
    degrees = {r["id"]: r["out_degree"] for r in eda.record_degrees(records).collect()}
    assert degrees == {"2": 1, "3": 1, "4": 2, "5": 5, "6": 3, "7": 2, "8": 2, "9": 2, "10": 1, "11": 1}
    assert eda.average_degree(eda.record_degrees(records)).first()["avg_out_degree"] == 2.0
    top = [r["id"] for r in eda.top_by(eda.record_degrees(records), "out_degree", 3).collect()]
    assert top == ["5", "6", "4"]


def test_test11_metrics(spark, test11):
    _, g = test11
    m = sorted(pr.pagerank_metrics(g, max_iter=3).collect())
    dm = [round(r["dangling_mass"], 8) for r in m]
    # m is read before each step: the dangling mass of states 0, 1, 2.
    assert dm[:3] == [0.09090909, 0.05929752, 0.04670398]
    assert all(abs(r["total_mass"] - 1.0) < 1e-12 for r in m)
    assert m[0]["max_delta"] is None and m[1]["max_delta"] > 0
