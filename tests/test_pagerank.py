"""PageRank properties: mass conservation, limits, salting and partitioning
invariance, GraphX convention, and the shape of one step's physical plan."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, TEST11_LINES, TOY2, write_lines
from rankwalk.operators import graph as gr, pagerank as pr
from rankwalk.plans import graphs
from rankwalk.sources.adjacency import read_adjacency
from rankwalk.sources.literal import graph_from_literal


def ranks(df, col="rank"):
    return {r["id"]: r[col] for r in df.collect()}


@pytest.fixture(scope="module")
def trade(spark):
    return graphs.trade_graph(spark, SF_SMALL)


@pytest.fixture(scope="module")
def test11(spark, tmp_path_factory):
    path = write_lines(str(tmp_path_factory.mktemp("t11")), TEST11_LINES)
    return gr.graph_from_records(read_adjacency(spark, path))


def test_mass_is_one_after_every_step(spark, trade):
    m = pr.pagerank_metrics(trade, max_iter=4).collect()
    assert len(m) == 5
    assert all(abs(r["total_mass"] - 1.0) < 1e-12 for r in m)


def test_alpha_one_and_zero_iterations_give_uniform(spark):
    g = graph_from_literal(spark, TOY2)
    for r in pr.pagerank(g, alpha=1.0, max_iter=1).collect():
        assert abs(r["rank"] - 0.2) < 1e-15
    for r in pr.pagerank(g, max_iter=0).collect():
        assert r["rank"] == 0.2


def test_salting_does_not_change_ranks(spark, test11):
    plain = ranks(pr.pagerank(test11, max_iter=20))
    salted = ranks(pr.pagerank(test11, max_iter=20, salt_chunk=1))   # every link its own bucket
    assert plain.keys() == salted.keys()
    assert max(abs(plain[k] - salted[k]) for k in plain) < 1e-15


def test_partition_count_does_not_change_ranks(spark, trade):
    base = ranks(pr.pagerank(trade, max_iter=5))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = ranks(pr.pagerank(trade, max_iter=5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert max(abs(base[k] - other[k]) for k in base) < 1e-15


def test_id_relabelling_invariance(spark, test11):
    relabelled = gr.Graph(test11.edges.select(F.concat(F.lit("n"), "src").alias("src"),
                                              F.concat(F.lit("n"), "dst").alias("dst"), "cnt"))
    a = ranks(pr.pagerank(test11, max_iter=10))
    b = ranks(pr.pagerank(relabelled, max_iter=10))
    assert max(abs(a[k] - b["n" + k]) for k in a) < 1e-15


def test_tolerance_stops_early(spark, test11):
    exact = ranks(pr.pagerank(test11, max_iter=60))
    approx = ranks(pr.pagerank(test11, max_iter=60, tol=1e-6))
    assert max(abs(exact[k] - approx[k]) for k in exact) < 1e-4


def test_graphx_convention_has_the_same_limit(spark, test11):
    n = 11
    g4 = ranks(pr.pagerank(test11, max_iter=50))
    g5 = ranks(pr.pagerank_graphx(test11, max_iter=50), "pagerank")
    assert abs(sum(g5.values()) - n) < 1e-9
    assert max(abs(g4[k] - g5[k] / n) for k in g4) < 1e-5
    g5_10 = ranks(pr.pagerank_graphx(test11, max_iter=10), "pagerank")
    assert max(abs(g4[k] - g5_10[k] / n) for k in g4) > 1e-4   # different path


def _step_plan(spark, graph, salt_chunk=pr.DEFAULT_SALT_CHUNK):
    """Physical nodes of one (statically planned) step, walked on the JVM plan
    tree: cached relations are leaves there and subqueries are expressions, so
    only the step's own operators are listed."""
    prep = pr.prepare(graph, salt_chunk)
    state = pr.cut_lineage(prep.state0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = pr.step(state, prep)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    partitioning = state._jdf.queryExecution().executedPlan().outputPartitioning().toString()
    nodes, todo = [], [plan]
    while todo:
        node = todo.pop()
        nodes.append((node.nodeName(), node.simpleString(400)))
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    prep.release()
    return nodes, partitioning


def _exchanges(nodes):
    return [text for name, text in nodes if name == "Exchange"]


def test_step_moves_only_the_partial_sums(spark, trade):
    nodes, partitioning = _step_plan(spark, trade)
    names = {name for name, _ in nodes}
    # The checkpointed state keeps the vertex partitioning ...
    assert partitioning.startswith("hashpartitioning(id")
    # ... so there is no cartesian product / nested loop, the links stream
    # through a hash table of the ranks, and the only exchange of the step is
    # the partial sums going to dst.
    assert not names & {"CartesianProduct", "BroadcastNestedLoopJoin"}
    assert "ShuffledHashJoin" in names and "InMemoryTableScan" in names
    ex = _exchanges(nodes)
    assert len(ex) == 1 and "hashpartitioning(dst" in ex[0], ex


def test_hub_ranks_are_the_only_extra_movement(spark, trade):
    nodes, _ = _step_plan(spark, trade, salt_chunk=20)      # customers become hubs
    ex = _exchanges(nodes)
    assert len(ex) == 2, ex
    assert any("salt" in e for e in ex) and any("hashpartitioning(dst" in e for e in ex), ex


def test_hub_salting_matches_plain_ranks(spark, trade):
    plain = ranks(pr.pagerank(trade, max_iter=3))
    salted = ranks(pr.pagerank(trade, max_iter=3, salt_chunk=20))
    assert max(abs(plain[k] - salted[k]) for k in plain) < 1e-15


def test_checkpoint_interval_gives_the_same_ranks(spark, trade):
    every_step = ranks(pr.pagerank(trade, max_iter=7))
    sparse = ranks(pr.pagerank(trade, max_iter=7, checkpoint_every=3))
    assert max(abs(every_step[k] - sparse[k]) for k in every_step) < 1e-15


def test_sink_free_graph_matches_dense_brute_force(spark):
    import numpy as np
    from conftest import TOY1
    g = graph_from_literal(spark, TOY1)
    prep = pr.prepare(g)
    assert prep.n_dangling == 0          # the dangling-mass job is skipped
    prep.release()
    nodes = TOY1["nodes"]
    idx = {v: i for i, v in enumerate(nodes)}
    t = np.zeros((5, 5))
    for a, b in TOY1["edges"]:
        t[idx[a], idx[b]] = 1.0
    t = t / t.sum(axis=1, keepdims=True)
    x = np.full(5, 0.2)
    for _ in range(12):
        x = 0.15 / 5 + 0.85 * (x @ t)
    got = ranks(pr.pagerank(g, max_iter=12))
    assert max(abs(got[v] - x[idx[v]]) for v in nodes) < 1e-15


def test_hub_with_a_third_of_all_links_is_spread_over_partitions(spark):
    hub_links = [("h", f"t{i}", 1) for i in range(3000)]
    other = [(f"s{i % 600}", f"t{(i * 7) % 3000}", 1 + i % 3) for i in range(6000)]
    edges = spark.createDataFrame(hub_links + other, "src string, dst string, cnt bigint")
    g = gr.graph_from_pairs(edges, "src", "dst", "cnt")
    prep = pr.prepare(g, salt_chunk=500, partitions=8)
    try:
        assert prep.hub_links is not None
        spread = (prep.hub_links.where(F.col("src") == "h")
                  .select(F.spark_partition_id().alias("p")).distinct().count())
        assert spread >= 4                               # 6 salts over 8 partitions
        plain = prep.links.where(F.col("src") == "h").count()
        assert plain == 0                                # the hub left the plain table
    finally:
        prep.release()
    a = ranks(pr.pagerank(g, max_iter=5, salt_chunk=500, partitions=8))
    b = ranks(pr.pagerank(g, max_iter=5))
    assert max(abs(a[k] - b[k]) for k in a) < 1e-15
