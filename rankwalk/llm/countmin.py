"""Count-min sketches as Spark data: partition sketches, their merge, look-up.

A task hashes its items to cells, and ships each range of cells as one
compressed blob of (cell gaps, counts); the shuffle brings the blobs of a range
together and they are added up, so no task holds more than one range of the
merged sketch.  The blobs of ``FAN`` partitions are added at a time, those sums
again by ``FAN``, and so on: what a merge task reads depends on the size of a
partition and not on their number.  The merged sketch has a fixed size (depth
<< log2 cells), is gathered as compressed bytes and broadcast: its size does not
grow with the data.  Counts stop at 2**32 - 1.  A sketch never underestimates,
so a filter on it loses nothing; a crowded one only lets more through to the
exact step behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean_run
from .textkernel import mix

FLUSH = 2 << 20
FAN = 64
TASKS = 4   # merge tasks a group of FAN partitions
MOST_COUNT = 2**32 - 1
_U = np.uint64
_SALTS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89], dtype=np.uint64)
SCHEMA = "row int, part int, source int, blob binary"


@dataclass(frozen=True)
class Shape:
    """depth rows of 2**log2 cells; 2**(log2 - part_log2) ranges a row."""

    depth: int
    log2: int
    part_log2: int = 22

    @property
    def parts(self) -> int:
        return 1 << max(0, self.log2 - self.part_log2)

    @property
    def part_cells(self) -> int:
        return 1 << min(self.log2, self.part_log2)

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return (mix(hashes ^ _SALTS[row]) >> _U(64 - self.log2)).astype(np.uint32)


def _pack(cells: np.ndarray, counts: np.ndarray) -> bytes:
    gaps = np.diff(cells, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    many = np.flatnonzero(counts > 1)
    raw = b"".join([np.array([len(cells), len(many)], dtype="<u4").tobytes(), gaps.tobytes(),
                    many.astype("<u4").tobytes(), counts[many].astype("<u4").tobytes()])
    return np.uint32(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = pa.decompress(blob[4:], decompressed_size=int(np.frombuffer(blob[:4], dtype="<u4")[0]), codec="zstd",
                        asbytes=True)
    n, m = (int(x) for x in np.frombuffer(raw, dtype="<u4", count=2))
    gaps = np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8, count=4 * n, offset=8).reshape(4, n).T).view("<u4")
    counts = np.ones(n, dtype=np.uint32)
    counts[np.frombuffer(raw, dtype="<u4", count=m, offset=8 + 4 * n)] = np.frombuffer(raw, dtype="<u4", count=m,
                                                                                     offset=8 + 4 * n + 4 * m)
    return np.cumsum(gaps.ravel(), dtype=np.uint32).astype(np.int64), counts


def _blobs(row: int, parts: Iterable[int], source: int, blobs: list[bytes]) -> pa.RecordBatch:
    parts = pa.array(parts, pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), row, dtype=np.int32)), parts,
                                       pa.array(np.full(len(parts), source, dtype=np.int32)), pa.array(blobs, pa.binary())],
                                      ["row", "part", "source", "blob"])


def _flush(shape: Shape, held: list[np.ndarray], source: int) -> Iterator[pa.RecordBatch]:
    hashes = np.concatenate(held)
    for row in range(shape.depth):
        cells = np.sort(shape.cells(hashes, row))
        first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        counts, cells = np.diff(first, append=len(cells)), cells[first]
        cuts = np.searchsorted(cells, np.arange(shape.parts + 1, dtype=np.int64) * shape.part_cells)
        parts = np.flatnonzero(np.diff(cuts))
        yield _blobs(row, parts, source, [
            _pack(cells[cuts[p]:cuts[p + 1]] - np.uint32(p * shape.part_cells), counts[cuts[p]:cuts[p + 1]]) for p in parts])


def _packed(counts: np.ndarray) -> bytes:
    cells = np.flatnonzero(counts)
    return _pack(cells.astype(np.uint32), counts[cells])


def _added(blobs: DataFrame, shape: Shape, finish: Callable[[np.ndarray], bytes], tasks: int) -> DataFrame:
    """One row per (row, range, source): ``finish`` of the sum of its blobs."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, counts = None, None
        for batch in batches:
            for *now, blob in zip(*(batch.column(i) for i in range(4))):
                if key != (now := [x.as_py() for x in now]):
                    if key is not None:
                        yield _blobs(key[0], [key[1]], key[2], [finish(counts)])
                    key, counts = now, np.zeros(shape.part_cells, dtype=np.uint32)
                cells, more = _unpack(blob.as_py())
                counts[cells] = np.minimum(counts[cells].astype(np.uint64) + more, MOST_COUNT)
        if key is not None:
            yield _blobs(key[0], [key[1]], key[2], [finish(counts)])

    keys = ["row", "part", "source"]
    return blobs.repartition(tasks, *keys).sortWithinPartitions(*keys).mapInArrow(add, SCHEMA)


def sketch(source: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], shape: Shape,
           finish: Callable[[np.ndarray], np.ndarray], fan: int = FAN) -> list[tuple[int, int, bytes]]:
    """The merged sketch of what ``hashes`` yields for every batch of
    ``source`` (a scan, or steps without a shuffle over one): compressed
    ``finish(counts)`` bytes per (row, range)."""

    def partition_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, mine = [], 0, TaskContext.get().partitionId()
        for batch in batches:
            for h in hashes(batch):
                held.append(h)
                size += len(h)
                if size >= FLUSH:
                    yield from _flush(shape, held, mine)
                    held, size = [], 0
        if size:
            yield from _flush(shape, held, mine)

    def done(counts: np.ndarray) -> bytes:
        return pa.compress(np.ascontiguousarray(finish(counts)).tobytes(), codec="zstd", asbytes=True)

    spark, ranges = source.sparkSession, shape.depth * shape.parts
    blobs, sources = source.mapInArrow(partition_sketch, SCHEMA), source.rdd.getNumPartitions()
    while sources > fan:
        sources = -(-sources // fan)
        blobs = blobs.withColumn("source", F.floor(F.col("source") / fan).cast("int"))
        blobs = _added(blobs, shape, _packed, min(TASKS * sources, ranges * sources))
    tasks = max(1, min(2 * shape.parts, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    merged = _added(blobs.withColumn("source", F.lit(0)), shape, done, tasks)
    with lean_run(spark):
        return [(r["row"], r["part"], bytes(r["blob"])) for r in merged.collect()]


def loaded(shape: Shape, blobs: list[tuple[int, int, bytes]], bits: int) -> list[np.ndarray]:
    """The rows of a merged sketch as uint8 arrays; bits: 1 or 4 a cell."""
    size = shape.part_cells * bits // 8
    rows = [np.zeros(max(1, (1 << shape.log2) * bits // 8), dtype=np.uint8) for _ in range(shape.depth)]
    for row, part, blob in blobs:
        rows[row][part * size:(part + 1) * size] = np.frombuffer(
            pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True), dtype=np.uint8)
    return rows


def repeated_bits(counts: np.ndarray) -> np.ndarray:
    """One bit a cell: counted twice or more."""
    return np.packbits(counts >= 2, bitorder="little")


def seen_bits(counts: np.ndarray) -> np.ndarray:
    """One bit a cell: counted at all (the sketch as a membership filter)."""
    return np.packbits(counts >= 1, bitorder="little")


def magnitude(counts: np.ndarray) -> np.ndarray:
    """Four bits a cell: the number of binary digits of the count; 15 stands
    for all longer ones too."""
    digits = np.minimum(np.ceil(np.log2(counts.astype(np.float64) + 1)), 15).astype(np.uint8)
    return digits[0::2] | digits[1::2] << 4


def magnitudes_at(table: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The digits that ``magnitude`` kept of these cells."""
    return table[cells >> np.uint32(1)] >> (cells & np.uint32(1)).astype(np.uint8) * np.uint8(4) & np.uint8(15)


class Filter:
    """Broadcast membership test: all rows' bits set."""

    def __init__(self, spark: SparkSession, shape: Shape, blobs: list[tuple[int, int, bytes]]) -> None:
        self.shape, self.blobs = shape, spark.sparkContext.broadcast(blobs)

    def open(self) -> Callable[[np.ndarray], np.ndarray]:
        """For use in a task: hashes -> boolean mask."""
        shape, rows = self.shape, loaded(self.shape, self.blobs.value, 1)

        def passes(hashes: np.ndarray) -> np.ndarray:
            out = np.ones(len(hashes), dtype=bool)
            for r, bits in enumerate(rows):
                at = shape.cells(hashes, r)
                out &= (bits[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8) & 1).astype(bool)
            return out

        return passes
