"""Merged count-min sketches and length limits against plain counts."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwalk.llm.countmin import MOST_COUNT, Shape, _pack, _unpack, loaded, magnitude, magnitudes_at, sketch
from rankwalk.llm.packing import bucket_limits

SHAPE = Shape(depth=2, log2=10, part_log2=8)


def merged(source, fan):
    return sketch(source, lambda batch: [batch.column(0).to_numpy().view(np.uint64)], SHAPE, magnitude, fan=fan)


@pytest.fixture(scope="module")
def items(spark):
    """20,000 items over 70 partitions, a third of them equal."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1500)
    return spark.range(0, 20000, numPartitions=70).select(F.xxhash64(key).alias("h"))


@pytest.mark.parametrize("fan", [2, 8, 64, 100])
def test_merge_levels_count_alike(items, fan):
    values = np.array([r["h"] for r in items.collect()], dtype=np.int64).view(np.uint64)
    blobs = merged(items, fan)
    assert sorted((row, part) for row, part, _ in blobs) == list(itertools.product(range(2), range(4)))
    for row, table in enumerate(loaded(SHAPE, blobs, 4)):
        counts = np.bincount(SHAPE.cells(values, row), minlength=1 << 10)
        digits = np.array([min(int(c).bit_length(), 15) for c in counts])
        assert (magnitudes_at(table, np.arange(1 << 10, dtype=np.uint32)) == digits).all()


def test_sketch_of_nothing(items):
    assert merged(items.where("h is null"), 2) == []


def test_large_counts_survive_packing_and_stop_at_the_most():
    cells, counts = np.array([0, 3, 4_000_000], dtype=np.uint32), np.array([1, 2, MOST_COUNT], dtype=np.uint32)
    found = _unpack(_pack(cells, counts))
    assert found[0].tolist() == cells.tolist() and found[1].tolist() == counts.tolist()
    assert np.minimum(found[1].astype(np.uint64) + found[1], MOST_COUNT).tolist() == [2, 4, MOST_COUNT]


@pytest.mark.parametrize("times", [1, 10**14])
def test_limits_have_least_padding_at_any_size(times):
    longest = np.array([1, 2, 5, 9, 20, 50, 460], dtype=np.int64)
    count = np.array([4, 1, 7, 2, 3, 1, 1], dtype=np.int64) * times
    limits = bucket_limits(count, count * longest, longest, 3)

    def padding(cuts):
        return sum(int(c) * (min(x for x in cuts if x >= n) - int(n)) for c, n in zip(count, longest))

    assert padding(limits) == min(padding([*cuts, 460]) for cuts in itertools.combinations(longest[:-1].tolist(), 2))
