"""Disk that iterated jobs hold: shuffles, states and written tables go when
nothing reads them any more."""

import os
import time

import pytest

from rankwalk.operators import graph as gr, markov, pagerank as pr, traversal

LINKS = [("a", "b", 1), ("b", "c", 2), ("c", "a", 1), ("b", "d", 1), ("d", "a", 3), ("a", "s", 1)]


@pytest.fixture
def graph(spark):
    return gr.Graph(spark.createDataFrame(LINKS, "src string, dst string, cnt bigint"))


def shuffles(spark):
    """Shuffles that have a file on this machine."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    names = [os.path.basename(f) for f in files.split("\n")]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_over(spark, before):
    """Shuffles still there that were not before; files go a moment after their action."""
    until = time.time() + 10
    while (left := shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def folders(spark):
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return set(os.listdir(base))


def test_a_loop_leaves_no_shuffle_of_its_steps(spark, graph):
    prepared = pr.prepare(graph)
    try:
        before = shuffles(spark)
        pr.drop_checkpoint(pr.iterate(prepared, 4, redistribute=False))
        assert not left_over(spark, before)
    finally:
        prepared.release()


def test_writing_a_table_leaves_no_shuffle(spark, graph):
    before = shuffles(spark)
    table = gr.written(gr.out_degree(graph.edges), "degrees")
    assert not left_over(spark, before) and table.count() == 4
    with pr.session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        before = shuffles(spark)
        pr.cut_lineage(gr.out_degree(graph.edges), mode="parquet")
        assert not left_over(spark, before)


def test_prepared_edges_are_kept_for_lost_blocks_and_go_with_the_release(spark, graph):
    before = folders(spark)
    prepared = pr.prepare(graph)
    assert folders(spark) - before
    prepared.release()
    assert folders(spark) == before
    stored = graph.once()
    before = folders(spark)
    prepared = pr.prepare(stored)
    assert not any(f.startswith("edges-") for f in folders(spark) - before)     # not written again
    prepared.release()
    assert stored.edges.count() == len(LINKS)


def test_metrics_hold_two_states_at_most(spark, graph, monkeypatch):
    states, cut = [], pr.cut_lineage

    def rdds():
        base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return {f for f in os.listdir(base) if f.startswith("rdd-")}

    before = rdds()

    def counted(*args, **more):
        kept = cut(*args, **more)
        states.append(len(rdds() - before))
        return kept

    monkeypatch.setattr(pr, "cut_lineage", counted)
    found = pr.pagerank_metrics(graph, max_iter=4).orderBy("step").collect()
    assert len(found) == 5 and all(abs(r["total_mass"] - 1) < 1e-12 for r in found)
    assert found[0]["max_delta"] is None and all(r["max_delta"] > 0 for r in found[1:])
    assert markov.mass_trace(graph, 4).count() == 5
    assert max(states) <= 2 and rdds() == before


def test_a_walk_leaves_no_shuffle_of_its_steps(spark, graph, monkeypatch):
    seen, step = [], traversal.Walk.step

    def noted(self, *args):
        before = shuffles(spark)
        step(self, *args)
        seen.append(left_over(spark, before))

    monkeypatch.setattr(traversal.Walk, "step", noted)
    found = {r["id"]: r["hops"] for r in traversal.hop_distances(graph).collect()}
    assert found == {"a": 0, "b": 1, "s": 1, "c": 2, "d": 2} and seen and not any(seen)
