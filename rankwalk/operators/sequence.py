"""Consecutive pairs within ordered groups - a skew-safe ``lead``.

``lead(value) OVER (PARTITION BY g ORDER BY o)`` puts each whole group into
one window task; a single user or order holding a third of all rows would
then be one straggler.  Here the rows are instead range-partitioned on the
full sort key (g, o..., value), so the range partitioner splits a hot group
over as many tasks as its size needs.  Each task walks its sorted slice
with numpy (consecutive rows of the same group form a pair) and pre-counts
its pairs; the only pairs that straddle two tasks are those between the
last row of one non-empty partition and the first row of the next, found
from a P-row boundary table (P = number of partitions).
"""

from __future__ import annotations

import sys
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

# The per-partition function travels to the Python workers by value, so the
# executors need numpy/pandas only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


ROWS_PER_TASK = 500_000


def tasks_for(rows: DataFrame) -> int:
    """Partitions for ``rows``, which are counted: ``ROWS_PER_TASK`` each, so
    that a task's memory stays the same as the table grows, and at least the
    cluster's default parallelism."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))


def _pairs_in_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counted pairs (edge = 0), then one row (edge = 1) with the partition's
    first and last group and value."""
    pid = TaskContext.get().partitionId()
    first = last = None
    for pdf in batches:
        if pdf.empty:
            continue
        g, v = pdf["_g"].to_numpy(), pdf["_v"].to_numpy()
        if first is None:
            first = (g[0], v[0])
        else:
            g, v = np.concatenate([[last[0]], g]), np.concatenate([[last[1]], v])
        last = (g[-1], v[-1])
        src, dst = v[:-1], v[1:]
        pairs = pd.DataFrame({"src": src, "dst": dst})[g[:-1] == g[1:]].dropna()
        if len(pairs):
            counted = pairs.groupby(["src", "dst"], sort=False).size().reset_index(name="cnt")
            yield counted.assign(edge=0, pid=pid, g0=None, g1=None)[_WALK_COLUMNS]
    if first is not None:
        row = {"edge": 1, "pid": pid, "g0": first[0], "g1": last[0], "src": last[1], "dst": first[1], "cnt": 1}
        yield pd.DataFrame([row], columns=_WALK_COLUMNS)


_WALK_COLUMNS = ["edge", "pid", "g0", "g1", "src", "dst", "cnt"]


def consecutive_pairs(df: DataFrame, group: str, order: list[str], value: str,
                      partitions: int | None = None) -> DataFrame:
    """(src, dst, cnt): how often ``value`` b directly follows a within a group.

    Equivalent to counting (value, lead(value)) over (partition by group order
    by order..., value) where neither is null: a row with a null value keeps
    its place, so its neighbours do not become a pair.  Rows with a null group
    are left out.

    The range shuffle is evaluated once: the walk emits the counted pairs and
    each partition's first and last row, and that small output is
    checkpointed before the pairs straddling two partitions are read off it.
    The number of partitions follows the number of rows.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    rows = (df.select(F.col(group).alias("_g"), *[F.col(c) for c in order],
                      F.col(value).cast("string").alias("_v"))
              .where(F.col("_g").isNotNull()))
    parts = partitions or tasks_for(rows)
    sort_key = ["_g", *order, "_v"]
    kind = rows.schema["_g"].dataType.simpleString()
    walked = (rows.repartitionByRange(parts, *sort_key).sortWithinPartitions(*sort_key).select("_g", "_v")
              .mapInPandas(_pairs_in_partition, f"edge int, pid int, g0 {kind}, g1 {kind}, src string, dst string, cnt long")
              .checkpoint())

    # P rows at most: ordering them needs no partitioning key.
    nxt = Window.orderBy("pid")
    straddle = (walked.where("edge = 1")
                .select("g1", "src", F.lead("g0").over(nxt).alias("next_g"), F.lead("dst").over(nxt).alias("dst"))
                .where("g1 = next_g and src is not null and dst is not null")
                .select("src", "dst", F.lit(1).cast("long").alias("cnt")))
    inner = walked.where("edge = 0").select("src", "dst", "cnt")
    return (inner.unionByName(straddle).repartition(parts, "src", "dst")
            .groupBy("src", "dst").agg(F.sum("cnt").alias("cnt")))


def numbered(df: DataFrame, group: str, order: list[str], name: str = "position",
             partitions: int | None = None) -> DataFrame:
    """``df`` with the place (1, 2, ...) of each row in its group, in the order
    of ``order`` (which must tell the rows of a group apart).

    Equivalent to ``row_number() over (partition by group order by order...)``,
    but a hot group is range-split over as many tasks as its size needs: rows
    are numbered within their partition, and the only groups that need an
    offset are those that go on from an earlier partition - one a partition at
    most, so the table of offsets is broadcast.
    """
    spark = df.sparkSession
    keys = [group, *order]
    parts = partitions or tasks_for(df)
    path = scratch_path(spark, "numbered")
    (df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id())).write.parquet(path)
    placed = spark.read.parquet(path)
    sizes = placed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sizes.select("_part", F.col(group).alias("_group"), F.sum("_n").over(earlier).alias("_before"))
               .where("_before > 0").withColumnRenamed("_part", "_at"))
    within = Window.partitionBy("_part", group).orderBy(*order)
    here = (F.col("_part") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_group"))
    return (placed.withColumn("_nr", F.row_number().over(within)).join(F.broadcast(offsets), here, "left")
            .select(*df.columns, (F.col("_nr") + F.coalesce("_before", F.lit(0))).cast("bigint").alias(name)))
