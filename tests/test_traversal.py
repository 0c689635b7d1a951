"""Distances, strongly connected components and chain structure against brute
force, with hubs that are split, and what an iterated job leaves behind."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from rankwalk.operators import pagerank as pr
from rankwalk.operators import traversal
from rankwalk.operators.graph import Graph


def graph(spark, links, nodes=()):
    edges = spark.createDataFrame([(str(a), str(b), c) for a, b, c in links], "src string, dst string, cnt bigint")
    return Graph(edges, spark.createDataFrame([(str(n),) for n in nodes], "id string") if nodes else None)


def brute_paths(links, nodes, start, cost):
    dist = {n: (0.0 if n == start else None) for n in nodes}
    for _ in nodes:
        for a, b, c in links:
            if dist[a] is not None and (dist[b] is None or dist[a] + cost(c) < dist[b]):
                dist[b] = dist[a] + cost(c)
    return dist


def brute_components(links, nodes):
    reach = {n: {n} for n in nodes}
    grew = True
    while grew:
        grew = False
        for a, b, _ in links:
            for r in reach.values():
                if a in r and b not in r:
                    r.add(b)
                    grew = True
    return {n: min(m for m in nodes if m in reach[n] and n in reach[m]) for n in nodes}


def brute_period(links, members):
    """gcd of the lengths of all closed walks up to twice the size, from each member."""
    inside, found = [(a, b) for a, b, _ in links if a in members and b in members], 0
    for start in members:
        at = {start}
        for length in range(1, 2 * len(members) + 1):
            at = {b for a, b in inside if a in at}
            if start in at:
                found = math.gcd(found, length)
    return found or None


@pytest.fixture(scope="module")
def odd():
    """A hub with a third of all links, cycles of 3 and of 2 and 4, a self loop, a path, apart nodes."""
    rng = random.Random(5)
    links = [("a0", "a1", 1), ("a1", "a2", 1), ("a2", "a0", 2), ("a2", "b0", 1),                    # period 3, leaves
             ("b0", "b1", 1), ("b1", "b0", 4), ("b1", "b2", 1), ("b2", "b3", 1), ("b3", "b0", 1),   # period 2, closed
             ("c", "c", 1), ("d0", "d1", 1), ("d1", "d2", 1), ("d2", "c", 1)]
    hub = [("h", f"k{i}", 1 + i % 3) for i in range(30)] + [(f"k{i}", "h", 1) for i in range(0, 30, 2)]
    rest = sorted({(f"r{rng.randrange(25)}", f"r{rng.randrange(25)}") for _ in range(35)})
    links += hub + [(a, b, 1 + i % 4) for i, (a, b) in enumerate(rest)] + [("d0", "h", 1)]
    return links, sorted({x for a, b, _ in links for x in (a, b)} | {"z"})


@pytest.mark.parametrize("chunk", [pr.DEFAULT_SALT_CHUNK, 4])
def test_distances(spark, odd, chunk):
    links, nodes = odd
    g = graph(spark, links, ["z"])
    starts = spark.createDataFrame([("d0",), ("absent",)], "id string")
    hops = {r["id"]: r["hops"] for r in traversal.hop_distances(g, starts, salt_chunk=chunk).collect()}
    assert hops == brute_paths(links, nodes, "d0", lambda c: 1)
    assert hops["z"] is None and hops["k29"] == 2
    for width in ((0.1, 100.0) if chunk == 4 else (0.5,)):
        found = traversal.distances(g, starts, cost="1D / l.cnt", width=width, salt_chunk=chunk).collect()
        assert {r["id"]: r["dist"] for r in found} == brute_paths(links, nodes, "d0", lambda c: 1 / c)
    first = {r["id"]: r["hops"] for r in traversal.hop_distances(g, salt_chunk=chunk).collect()}
    assert first == brute_paths(links, nodes, "a0", lambda c: 1)


@pytest.mark.parametrize("chunk", [pr.DEFAULT_SALT_CHUNK, 4])
def test_components_and_periods(spark, odd, chunk):
    links, nodes = odd
    g, want = graph(spark, links, ["z"]), brute_components(links, nodes)
    assert {r["id"]: r["component"] for r in traversal.strong_components(g, chunk).collect()} == want
    rows = {r["component"]: r for r in traversal.chain_structure(g, chunk).collect()}
    assert set(rows) == set(want.values())
    for c, r in rows.items():
        members = {n for n in nodes if want[n] == c}
        assert r["size"] == len(members) and r["period"] == brute_period(links, members), c
        assert r["closed"] == all(b in members for a, b, _ in links if a in members)
    assert rows["a0"]["period"] == 3 and rows["b0"]["period"] == 2 and rows["c"]["period"] == 1 and rows["z"]["period"] is None
    assert rows["b0"]["closed"] and not rows["a0"]["closed"]


def test_empty_and_linkless(spark):
    empty = graph(spark, [])
    assert traversal.hop_distances(empty).count() == 0
    assert traversal.strong_components(empty).count() == 0
    assert traversal.chain_structure(empty).count() == 0
    alone = graph(spark, [], ["x", "y"])
    assert {(r["id"], r["hops"]) for r in traversal.hop_distances(alone).collect()} == {("x", 0), ("y", None)}
    assert {tuple(r) for r in traversal.chain_structure(alone).collect()} == {("x", 1, True, None), ("y", 1, True, None)}


def checkpoints(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("rdd-")}


def test_loop_holds_two_checkpoints_at_most(spark, odd, monkeypatch):
    g = graph(spark, odd[0])
    before, held, cut = checkpoints(spark), [], pr.cut_lineage

    def counted(*a, **k):
        out = cut(*a, **k)
        held.append(len(checkpoints(spark) - before))
        return out

    monkeypatch.setattr(pr, "cut_lineage", counted)
    pr.pagerank(g, max_iter=10).count()
    assert len(held) == 11 and max(held) <= 2
    mid = checkpoints(spark)
    assert len(mid - before) == 1
    pr.pagerank(g, max_iter=7, checkpoint_every=3).count()
    traversal.hop_distances(g).count()
    assert len(checkpoints(spark) - mid) == 2           # each keeps the state that it returned


def test_failed_step_leaves_nothing(spark, odd, monkeypatch):
    g = graph(spark, odd[0])
    cached = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    views = lambda: {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = (cached(), views())

    def fails(*a, **k):
        raise RuntimeError("step")

    with monkeypatch.context() as m:
        m.setattr(pr, "step", fails)
        with pytest.raises(RuntimeError, match="step"):
            pr.pagerank(g)
    with monkeypatch.context() as m:
        m.setattr(pr, "loop_partitions", fails)
        with pytest.raises(RuntimeError, match="step"):
            pr.pagerank(g)
        with pytest.raises(RuntimeError, match="step"):
            traversal.strong_components(g)
    with pytest.raises(Exception):
        traversal.distances(g, cost="l.none").count()
    assert (cached(), views()) == before


def test_convergence_stops_by_the_data(spark, odd):
    rows = pr.pagerank_convergence(graph(spark, odd[0]), tol=1e-3).collect()
    assert [r["step"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows[-1]["stopped"] and rows[-1]["max_delta"] < 1e-3 and not any(r["stopped"] for r in rows[:-1])
    assert [r["stopped"] for r in pr.pagerank_convergence(graph(spark, odd[0]), tol=0.0, max_iter=3).collect()] == [False] * 3
    assert pr.pagerank_convergence(graph(spark, [])).count() == 0
