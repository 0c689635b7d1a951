"""Shared helpers: lineage cuts through written tables, row identity, global
row numbers without a global window."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Shuffle files go as each query ends; Arrow batches stay small, since a task
# holds a batch several times over (its texts are cut into pieces anyway).
RUN_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


@contextmanager
def lean_run(spark: SparkSession):
    """The queries run inside have ``RUN_CONF``."""
    before = {k: spark.conf.get(k, None) for k in RUN_CONF}
    for k, v in RUN_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts lineage (an executor lost later costs nothing upstream), frees
    the shuffle files behind it, and gives later joins the true size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with lean_run(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialise`` wrote and that nothing
    reads any more: all that depends on them must be written itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for file in table.inputFiles()[:1]:
            path = context._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def row_key() -> Column:
    """128-bit identity of a document row: equal only for rows with the same
    doc_id and the same text (such rows share one fate in every operator)."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"),
                          F.coalesce(F.col("text"), F.lit(""))).cast("binary"))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name the frame does not have (compared without case)."""
    have = {c.lower() for c in df.columns}
    while stem.lower() in have:
        stem = "_" + stem
    return stem


def log_cell(value: Column, bits: int) -> Column:
    """Log-linear cell of a whole number >= 0: the value itself below 2**bits,
    then 2**(bits - 1) cells a power of two."""
    half = 1 << (bits - 1)
    shift = F.length(F.bin(value)) - bits
    return (F.when(value < 2 * half, value)
             .otherwise(2 * half + (shift - 1) * half + F.floor(value / F.pow(F.lit(2), shift)) - half).cast("bigint"))


def log_cell_floor(cell: Column, bits: int) -> Column:
    """Smallest value of a cell."""
    half = 1 << (bits - 1)
    shift = F.floor((cell - 2 * half) / half) + 1
    return F.when(cell < 2 * half, cell).otherwise((half + (cell - 2 * half) % half) * F.pow(F.lit(2), shift)).cast("bigint")


def with_global_position(df: DataFrame, order: list[str], totals: dict[str, str], name: str,
                         group: str | None = None) -> DataFrame:
    """Prefix sums in the order of ``order`` (within each value of ``group``).

    Adds, for each ``{new: summed}`` of ``totals``, the sum of column
    ``summed`` over all earlier rows (exclusive), and as ``new_total`` the sum
    over all rows.  The rows are range-split and
    written once with their partition's number, per-partition totals are
    summed up in partition order, and each partition adds its own running sum:
    no task sees more than one partition, however large a group is.  Equal
    keys can be split too, since the row's number in the input ends the order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ([group] if group else []) + order
    placed = (df.withColumn("_nr", F.monotonically_increasing_id())
                .repartitionByRange(parts, *[F.col(k).asc_nulls_last() for k in keys], F.col("_nr"))
                .withColumn("_part", F.spark_partition_id()))
    placed = materialise(placed, name)
    by = [group] if group else []
    sums = placed.groupBy("_part", *by).agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in totals.items()])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_part", *by, *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_before_{k}")
                                       for k in totals],
                       *[F.sum(f"_sum_{k}").over(Window.partitionBy(*by)).alias(f"{k}_total") for k in totals])
    within = (Window.partitionBy("_part", *by)
              .orderBy(*[F.col(k).asc_nulls_last() for k in order], "_nr")
              .rowsBetween(Window.unboundedPreceding, -1))
    # One row per partition (and group): bounded by the number of partitions.
    out = placed.join(F.broadcast(sums), ["_part", *by])
    out = out.select("*", *[(F.col(f"_before_{k}") + F.coalesce(F.sum(v).over(within), F.lit(0))).alias(k)
                            for k, v in totals.items()])
    return out.drop("_nr", "_part", *[f"_before_{k}" for k in totals])
