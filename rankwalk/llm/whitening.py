"""Whitened embeddings, with the covariances found by polarisation.

Every entry c of a vector becomes the whole number x = floor(256 * c).  The
fit list holds each distinct x-vector once: n vectors with sums S.  For every
dimension the squared centred values (n*x - S)**2 are summed over the fit list,
and for every pair of dimensions those of the sum of the two; then

    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2

gives all cross-covariances.  The sums are exact: a task adds up the squares
of v = x - floor(S / n), whole numbers that stay small, and with r = S - n *
floor(S / n) the sum of (n*x - S)**2 is n*n * sum(v*v) - n*r*r in unbounded
integers.  ``eigh`` of the assembled d x d matrix gives the components.

Scale.  The fit list comes from one ``distinct`` with map-side combine, so a
vector that a third of all rows repeat costs one row a task.  Each task adds up
its d * (d + 1) / 2 sums and sends only these; the driver gets one row for each
pair of dimensions, however many vectors there are.  What travels to the tasks
are d sums and d x 4 numbers.

Cases: a null vector and one with a null, NaN or infinite entry is left out,
and so is one whose length is not the table's (the most frequent length among
the others; of equally frequent ones the largest).  Entries beyond +-2**36
count as +-2**36.  Repeated rows are each returned; a null vec_id is kept; other
columns are not looked at.  Components without variance (an eigenvalue up to
1e-12 of the trace) are not returned, so a fit list of one vector, an empty
table and vectors without entries give no rows.  A deviation that a long can't
hold is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean_run, materialise

SCALE, LARGEST = 256, 1 << 44
OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


@dataclass
class Fit:
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray        # eigenvalues, falling
    vectors: np.ndarray       # d x components


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector counts."""
    usable = F.col("e").isNotNull() & F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long")
    kept = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("e")).where(usable)
    most = kept.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return kept.where(F.size("e") == (most[0]["d"] if most else 0)).select("vec_id", F.transform("e", whole).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _safe(m: np.ndarray, bound: int) -> np.ndarray:
    """``m`` as Python integers if 64 bits could not hold ``bound``."""
    return m if bound < 1 << 62 else m.astype(object)


def _largest(m: np.ndarray) -> int:
    return int(np.abs(m).max(initial=0))


def _totals(parts: DataFrame, *by: str) -> list:
    """One row for each dimension or pair: bounded by the vectors' length."""
    with lean_run(parts.sparkSession):
        return parts.groupBy(*by).agg(F.sum("q").alias("q")).collect()


def _decimals(values: Iterator[int]) -> pa.Array:
    from decimal import Decimal
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def sums(fit_list: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, S): the number of vectors and their sum in each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (d + 1)
        for batch in batches:
            m = _matrix(batch.column(0), d)
            found = _safe(m, len(m) * _largest(m)).sum(axis=0)
            total = [t + int(f) for t, f in zip(total, [*found, len(m)])]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), _decimals(total)], ["i", "q"])

    found = {r["i"]: int(r["q"]) for r in _totals(fit_list.mapInArrow(add, "i int, q decimal(38,0)"), "i")}
    return found.get(d, 0), [found.get(i, 0) for i in range(d)]


def squares(fit_list: DataFrame, n: int, totals: list[int]) -> dict[tuple[int, int], int]:
    """(i, j), i <= j -> the exact sum of the squared centred values, n times
    as large as x, of dimension i (i = j) or of the sum of i and j."""
    d, centre = len(totals), [s // n for s in totals]
    rest = [s - n * c for s, c in zip(totals, centre)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, at = [[0] * (d - i) for i in range(d)], np.array(centre, dtype=np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), d) - at
            v = _safe(v, len(v) * (2 * _largest(v)) ** 2)
            for i in range(d):
                both = v[:, i:] + v[:, i, None]
                both[:, 0] = v[:, i]
                total[i] = [t + int(f) for t, f in zip(total[i], (both * both).sum(axis=0))]
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int32()) for k in (0, 1)] + [_decimals(q for row in total for q in row)], ["i", "j", "q"])

    found = _totals(fit_list.mapInArrow(add, "i int, j int, q decimal(38,0)"), "i", "j")
    exact = {}
    for r in found:
        i, j = r["i"], r["j"]
        exact[i, j] = n * n * int(r["q"]) - n * (rest[i] if i == j else rest[i] + rest[j]) ** 2
    return exact


def covariance(n: int, square: dict[tuple[int, int], int], d: int) -> np.ndarray:
    """Polarisation; every entry is rounded once, from the exact fraction."""
    v = np.zeros((d, d))
    for (i, j), q in square.items():
        v[i, j] = v[j, i] = (q / n**3 if i == j else (q - square[i, i] - square[j, j]) / (2 * n**3))
    return v


def fitted(fit_list: DataFrame, d: int, most: int) -> Fit | None:
    """The first ``most`` components of the fit list; None without variance."""
    n, totals = sums(fit_list, d) if d else (0, [])
    if not n:
        return None
    v = covariance(n, squares(fit_list, n, totals), d)
    values, vectors = np.linalg.eigh(v)
    order, trace = np.argsort(values)[::-1][:most], float(np.trace(v))
    order = order[values[order] > 1e-12 * trace]
    return Fit(n, totals, trace, values[order], vectors[:, order]) if len(order) else None


def _projector(fit: Fit):
    """For tasks: x-vectors -> (n*x - S exactly, whitened)."""
    n, totals, turn = fit.n, list(fit.sums), fit.vectors / np.sqrt(fit.values)
    largest = max(map(abs, totals), default=0)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fits = n * _largest(x) + largest < 1 << 62
        y = _safe(x, 0 if fits else 1 << 62) * n - np.array(totals, dtype=np.int64 if fits else object)
        return y, (y / n).astype(np.float64) @ turn

    return project


def identity_error(fit_list: DataFrame, fit: Fit) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - I)."""
    project, d, k, n = _projector(fit), len(fit.sums), len(fit.values), fit.n

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = project(_matrix(batch.column(0), d))[1]
            total += w.T @ w
        at = np.indices((k, k), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at[0].ravel()), pa.array(at[1].ravel()), pa.array(total.ravel())], ["i", "j", "q"])

    found = _totals(fit_list.mapInArrow(add, "i int, j int, q double"), "i", "j")
    return max(abs(r["q"] / n - (r["i"] == r["j"])) for r in found)


def whitened(rows: DataFrame, components: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    of every row that counts and its first ``components`` components."""
    x = quantised(rows)
    fit_list = materialise(x.select("x").distinct(), "fit-list")
    d = fit_list.select(F.size("x").alias("d")).take(1)
    fit = fitted(fit_list, d[0]["d"] if d else 0, components)
    if fit is None:
        return rows.sparkSession.createDataFrame([], OUT)
    project, k, d, n = _projector(fit), len(fit.values), d[0]["d"], fit.n
    explained, error = fit.values / fit.trace, identity_error(fit_list, fit)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, w = project(_matrix(batch.column("x"), d))
            y = _safe(y, d * _largest(y) ** 2)
            deviation = [s if s < 1 << 63 else None for s in map(int, (y * y).sum(axis=1))]
            row = pa.array(np.repeat(np.arange(len(w)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                 pa.array(np.full(len(row), n)), pa.array(deviation, pa.int64()).take(row), pa.array(w.ravel()),
                 pa.array(np.tile(explained, len(w))), pa.array(np.full(len(row), error))],
                [c.split()[0] for c in OUT.split(", ")])

    return x.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(place, OUT)
