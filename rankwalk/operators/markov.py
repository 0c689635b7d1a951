"""Markov-chain operators on sparse (COO) matrices held as DataFrames.

* adjacency matrix  (src, dst, value = 1): repeated links collapse to 1;
  zero entries are implicit.
* transition matrix (src, dst, prob): rows of the adjacency matrix scaled
  to sum 1; a sink has no row (its row is all zero).
* power iteration: x <- x T, a fixed number of steps, no sink handling and no
  teleport (the plain chain; mass held by sinks leaks away).
* power iteration by squaring: T <- T T, k times, then x T: 2^k hops, with T
  as a matrix of blocks.

Vector steps reuse the PageRank machinery (static, salted, persisted weights;
one checkpoint per step).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import Graph, written
from .sequence import numbered
from ..session import FREED_CONF, drop_path, scratch_path
from . import pagerank as pr

BLOCK, TILE, BATCH = 256, 16, 16        # entries a side, blocks a side of a tile, blocks read at once
DENSER = 1000                           # sums of a dense product in the time of one over listed entries
MOST_TASKS = 100_000                    # of one product; beyond, a task gets several tiles
PASS_BYTES = 8 << 30                    # shuffled at once by a product, if one column of tiles takes no more
BLOCK_SCHEMA = "bi long, bj long, data binary"
# A block is 512 KB: Spark's defaults would read 4096 rows into one batch, hold
# all blocks of a join key on the heap and put 100 in a page before looking.
BLOCK_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH),
              "spark.sql.parquet.columnarReaderBatchSize": str(BATCH),
              "spark.sql.sortMergeJoinExec.buffer.in.memory.threshold": str(BATCH),
              "parquet.block.size": str(32 << 20),
              "parquet.page.size.row.check.min": "1",
              "parquet.page.size.row.check.max": str(BATCH)}

# The block functions travel to the Python workers by value, so the executors
# need numpy and pyarrow only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def adjacency_matrix(graph: Graph) -> DataFrame:
    return graph.edges.select("src", "dst", F.lit(1).alias("value")).distinct()


def binary_graph(graph: Graph) -> Graph:
    """The same nodes with every link counted once."""
    return Graph(graph.edges.select("src", "dst", F.lit(1).cast("bigint").alias("cnt")).distinct(),
                 graph.extra_ids)


def transition_matrix(graph: Graph, binary: bool = True) -> DataFrame:
    """(src, dst, prob), rows summing to 1.  ``binary`` uses the 0/1
    adjacency matrix (as the textbook transition matrix); otherwise link
    multiplicity weighs in (as PageRank does)."""
    g = binary_graph(graph) if binary else graph
    from .graph import transition_weights
    return transition_weights(g.edges).withColumnRenamed("w", "prob")


def _initial(prepared: pr.PreparedGraph, start: str) -> DataFrame:
    v = prepared.vertices
    if start == "uniform":
        return v.withColumn("rank", F.lit(1.0 / max(prepared.n, 1)))
    if start == "first":
        first = v.agg(F.min("id")).scalar()
        return v.withColumn("rank", F.when(F.col("id") == first, F.lit(1.0)).otherwise(F.lit(0.0)))
    raise ValueError(f"unknown start {start!r}")


def power_iteration(graph: Graph, steps: int, start: str = "first", binary: bool = True,
                    salt_chunk: int = pr.DEFAULT_SALT_CHUNK) -> DataFrame:
    """(id, mass) after ``steps`` plain steps x <- x T.

    ``start``: ``"first"`` = all mass on the smallest id (one-hot),
    ``"uniform"`` = 1/N each.  0 steps returns the start vector.
    """
    g = binary_graph(graph) if binary else graph
    prepared = pr.prepare(g, salt_chunk)
    try:
        prepared.state0 = _initial(prepared, start)
        final = pr.iterate(prepared, steps, redistribute=False, teleport=False)
    finally:
        prepared.release()
    return final.select("id", F.col("rank").alias("mass"))


def mass_trace(graph: Graph, steps: int, start: str = "uniform", binary: bool = True,
               salt_chunk: int = pr.DEFAULT_SALT_CHUNK) -> DataFrame:
    """(step, total_mass) for steps 0..``steps`` of the plain power iteration:
    stays 1 on a graph without sinks, leaks on one with sinks."""
    g = binary_graph(graph) if binary else graph
    rows: list = []

    def gather(i: int, s: DataFrame, before: DataFrame | None) -> None:
        rows.append((i, s.agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]))

    prepared = pr.prepare(g, salt_chunk)
    try:
        prepared.state0 = _initial(prepared, start)
        pr.drop_checkpoint(pr.iterate(prepared, steps, redistribute=False, teleport=False, each=gather))
    finally:
        prepared.release()
    return graph.edges.sparkSession.createDataFrame(rows, "step int, total_mass double")


def _blocks(entries: DataFrame) -> DataFrame:
    """(i, j, prob), i and j from 0 -> (bi, bj, data): the blocks with an entry,
    each a BLOCK x BLOCK matrix of doubles as :func:`_packed` stores it (a
    group has that many entries at most)."""
    def dense(key, group):
        block = np.zeros((BLOCK, BLOCK))
        block[group["i"].to_numpy() % BLOCK, group["j"].to_numpy() % BLOCK] = group["prob"].to_numpy()
        return pa.table([pa.array([k.as_py()]) for k in key] + [pa.array([_packed(block)], pa.binary())], names=["bi", "bj", "data"])

    at = lambda c: F.floor(F.col(c) / BLOCK).cast("bigint")
    return (entries.withColumns({"bi": at("i"), "bj": at("j")}).groupBy("bi", "bj")
            .applyInArrow(dense, BLOCK_SCHEMA))


def _packed(block: np.ndarray) -> bytes:
    """A block's bytes: its places (int32) and their values if that is at most
    half as long, else all values."""
    flat = np.ascontiguousarray(block).ravel()
    at = np.flatnonzero(flat)
    return at.astype(np.int32).tobytes() + flat[at].tobytes() if 24 * len(at) <= flat.nbytes else flat.tobytes()


def _entries(data) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(row, column, value) of the entries of a block stored by its places; None if it has all values."""
    buffer = data.as_buffer()
    if buffer.size == 8 * BLOCK * BLOCK:
        return None
    n = buffer.size // 12
    at = np.frombuffer(buffer, np.int32, n)
    return at // BLOCK, at % BLOCK, np.frombuffer(buffer, np.float64, n, 4 * n)


def _matrix(data) -> np.ndarray:
    found = _entries(data)
    if found is None:
        return np.frombuffer(data.as_buffer(), dtype=np.float64).reshape(BLOCK, BLOCK)
    block = np.zeros((BLOCK, BLOCK))
    block[found[0], found[1]] = found[2]
    return block


def _row(bi: int, bj: int, block: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bi]), pa.array([bj]), pa.array([_packed(block)], pa.binary())], ["bi", "bj", "data"])


def _add_product(total: np.ndarray, left: dict, right: dict) -> None:
    """Add to a tile the product of a column of its blocks, ``left`` (by their
    row in the tile), with a row of blocks, ``right`` (by their column)."""
    listed = [_entries(x) for x in right.values()]
    few = None not in listed
    if few:
        k, y = (np.concatenate([e[n] for e in listed]) for n in (0, 2))
        order = np.argsort(k, kind="stable")
        y, j = y[order], np.concatenate([e[1] + at * BLOCK for at, e in zip(right, listed)])[order]
        each = np.bincount(k, minlength=BLOCK)
        first = np.cumsum(each) - each
    low, high, wide = min(right), max(right) + 1, None
    for at, data in left.items():
        rows = total[at * BLOCK:(at + 1) * BLOCK]
        if few and (found := _entries(data)) is not None:
            i, inner, x = found
            times = each[inner]
            n = times.sum()
            if DENSER * n < len(right) * BLOCK**3:
                # Few entries meet: every one of the left with its row of the right.
                met = np.arange(n) + np.repeat(first[inner] - (np.cumsum(times) - times), times)
                np.add.at(rows.reshape(-1), np.repeat(i * rows.shape[1], times) + j[met], np.repeat(x, times) * y[met])
                continue
        if wide is None:
            wide = np.zeros((BLOCK, (high - low) * BLOCK))
            for to, block in right.items():
                wide[:, (to - low) * BLOCK:(to - low + 1) * BLOCK] = _matrix(block)
        rows[:, low * BLOCK:high * BLOCK] += _matrix(data) @ wide


def _tiles(m: DataFrame, c: str) -> tuple[int, int]:
    """The first tile along ``c`` and the number of tiles from it on."""
    least, most = (x or 0 for x in m.agg(F.min(c), F.max(c)).first())
    return least // TILE, most // TILE - least // TILE + 1


def matrix_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two block matrices (bi, bj, data), by tiles of TILE x TILE
    blocks of the result.  A tile gets the rows of blocks of ``a`` and the
    columns of ``b`` that it is made of, ordered by the inner index, and adds up
    one inner index after the other: a block is sent once for each TILE blocks
    across the result, products are never shuffled, and a task holds one tile
    and 2 TILE blocks, however large the matrix is."""
    (top, down), (start, across) = _tiles(a, "bi"), _tiles(b, "bj")

    def multiply(batches):
        at, k, total, sides = None, None, np.zeros((TILE * BLOCK, TILE * BLOCK)), ({}, {})

        def add():
            if sides[0] and sides[1]:
                _add_product(total, *sides)
            for side in sides:
                side.clear()

        def made():
            """The tile's blocks with an entry; it is empty afterwards."""
            for i in range(TILE):
                for j in range(TILE):
                    block = total[i * BLOCK:(i + 1) * BLOCK, j * BLOCK:(j + 1) * BLOCK]
                    if block.any():
                        yield _row((top + at // across) * TILE + i, (start + at % across) * TILE + j, block)
            total[:] = 0

        for batch in batches:
            for tile, inner, side, place, data in zip(*batch.columns):
                tile, inner = tile.as_py(), inner.as_py()
                if (tile, inner) != (at, k):
                    add()
                    if at not in (None, tile):
                        yield from made()
                    at, k = tile, inner
                sides[side.as_py()][place.as_py()] = data
        if at is not None:
            add()
            yield from made()

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda c, first: F.floor(F.col(c) / TILE).cast("bigint") - first
    place = lambda c: (F.col(c) % TILE).cast("int").alias("place")
    left = (a.withColumn("_t", every(across))
            .select((of("bi", top) * across + F.col("_t")).alias("tile"), F.col("bj").alias("k"), F.lit(0).alias("side"), place("bi"), "data"))
    right = (b.withColumn("_t", every(down))
             .select((F.col("_t").cast("bigint") * across + of("bj", start)).alias("tile"), F.col("bi").alias("k"), F.lit(1).alias("side"), place("bj"), "data"))
    parts = min(down * across, MOST_TASKS)
    return (left.unionByName(right).repartitionById(parts, (F.col("tile") % parts).cast("int"))
            .sortWithinPartitions("tile", "k").mapInArrow(multiply, BLOCK_SCHEMA))


def squared(t: DataFrame, folders: list[str]) -> DataFrame:
    """T T as a written table (``folders`` gets its folder), made by columns of
    tiles: as many at once as shuffle PASS_BYTES, or one, so that the disk for
    shuffles is twice the matrix at most, not once more for each column."""
    spark = t.sparkSession
    folders.append(scratch_path(spark, "blocks"))
    stored = t.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    (_, down), (start, across) = _tiles(t, "bi"), _tiles(t, "bj")
    columns = int(min(across, max(1, PASS_BYTES // max(1, stored + stored * down // across))))
    for at in range(start, start + across, columns):
        with pr.session_conf(spark, FREED_CONF):
            matrix_product(t, t.where(F.col("bj").between(at * TILE, (at + columns) * TILE - 1))).write.mode("append").parquet(folders[-1])
    return spark.read.schema(t.schema).parquet(folders[-1])


def power_iteration_squaring(graph: Graph, squarings: int, start: str = "first",
                             binary: bool = True) -> DataFrame:
    """(id, mass) after 2^``squarings`` hops, computed as x T^(2^k).

    T is squared as a block matrix of which only blocks with an entry are
    stored; the same path for every size.  Squaring fills the matrix in (up to
    n^2 entries, as the method itself does).  0 squarings = 1 hop.
    """
    if start not in ("first", "uniform"):
        raise ValueError(f"unknown start {start!r}")
    g = binary_graph(graph) if binary else graph
    spark = g.edges.sparkSession
    ids = written(numbered(g.vertices.withColumn("_all", F.lit(0)), "_all", ["id"], "nr").select("id", (F.col("nr") - 1).alias("nr")), "states")
    n = ids.count()
    end = lambda c, nr: ids.select(F.col("id").alias(c), F.col("nr").alias(nr))
    entries = transition_matrix(g, binary=False).join(end("src", "i"), "src").join(end("dst", "j"), "dst")
    folders: list[str] = []
    # A batch of blocks is BATCH times their size.
    with pr.session_conf(spark, BLOCK_CONF):
        t = written(_blocks(entries.select("i", "j", "prob")), "blocks", folders)
        for _ in range(squarings):
            t = squared(t, folders)
            drop_path(spark, folders.pop(0))        # nothing reads the matrix before its square

        def move(batches):
            """x T, block by block: (nr, mass) of every column that gets any."""
            for batch in batches:
                for bi, bj, data in zip(*batch.columns):
                    block, bi = _matrix(data), bi.as_py()
                    mass = block[0] * float(bi == 0) if start == "first" else block.sum(axis=0) / n
                    at = np.flatnonzero(mass)
                    yield pa.RecordBatch.from_arrays([pa.array(at + bj.as_py() * BLOCK), pa.array(mass[at])], ["nr", "part"])

        rows = t.where("bi = 0") if start == "first" else t
        moved = written(rows.mapInArrow(move, "nr long, part double"), "moved")
        drop_path(spark, folders.pop())
    moved = moved.groupBy("nr").agg(F.sum("part").alias("part"))
    return ids.join(moved, "nr", "left").select("id", F.coalesce("part", F.lit(0.0)).alias("mass"))
