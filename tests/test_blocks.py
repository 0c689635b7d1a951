"""Products of block matrices: by tiles, by passes, of listed and of full blocks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankwalk.operators import graph as gr, markov


def table(spark, matrix):
    i, j = np.nonzero(matrix)
    rows = [(int(x), int(y), float(matrix[x, y])) for x, y in zip(i, j)]
    return gr.written(markov._blocks(spark.createDataFrame(rows, "i long, j long, prob double")), "blocks")


def dense(rows, n):
    found = np.zeros((n, n))
    for r in rows:
        block = markov._matrix(pa.scalar(bytes(r["data"]), pa.binary()))
        at = np.s_[r["bi"] * markov.BLOCK:(r["bi"] + 1) * markov.BLOCK, r["bj"] * markov.BLOCK:(r["bj"] + 1) * markov.BLOCK]
        assert not found[at].any()          # a block comes once
        found[at] = block
    return found


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(markov, "BLOCK", 8)
    monkeypatch.setattr(markov, "TILE", 3)


@pytest.mark.parametrize("density, denser, passes", [(0.05, 0, 1), (0.05, 10**9, 4), (0.6, 1000, 4)])
def test_squares_match_numpy(spark, small, monkeypatch, density, denser, passes):
    monkeypatch.setattr(markov, "DENSER", denser)
    monkeypatch.setattr(markov, "PASS_BYTES", 1 << 40 if passes == 1 else 1)
    made, product = [], markov.matrix_product
    monkeypatch.setattr(markov, "matrix_product", lambda a, b: made.append(1) or product(a, b))
    rng = np.random.default_rng(5)
    m = np.where(rng.random((80, 80)) < density, rng.random((80, 80)), 0.0)
    folders = []
    found = dense(markov.squared(table(spark, m), folders).collect(), 80)
    assert np.allclose(found, m @ m, rtol=0, atol=1e-12) and len(made) == passes and len(folders) == 1


def test_products_are_not_shuffled(spark, small):
    """A block is sent once for each tile across the result, and no product is."""
    full = np.ones((48, 48))                # 6 x 6 blocks, 2 x 2 tiles
    t = table(spark, full)
    plan = markov.matrix_product(t, t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert (dense(markov.matrix_product(t, t).collect(), 48) == 48.0).all()


def test_few_entries_are_stored_by_their_places(spark, small):
    m = np.zeros((8, 8))
    m[2, 5], m[7, 0] = 0.5, 0.25
    rows = table(spark, m).select(F.octet_length("data").alias("n"), "bi", "bj", "data").collect()
    assert [r["n"] for r in rows] == [24] and (dense(rows, 8) == m).all()
    assert len(markov._packed(np.ones((8, 8)))) == 8 * 64


def test_an_empty_matrix_has_an_empty_square(spark, small):
    t = table(spark, np.zeros((8, 8)))
    assert markov.squared(t, []).count() == 0
