"""Graph EDA: counts, out-degree statistics, top-k, sampling, histogram.

Global numbers (counts, min/max) come back as one-row DataFrames or as
scalar subqueries inside the plan; nothing is iterated on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import dict_degree, equal_width_bin, sample_key
from .graph import Graph, out_degree


def record_degrees(records: DataFrame, node: str = "node", links: str = "links") -> DataFrame:
    """Per adjacency record (line): (id, out_degree) with multiplicity, taken
    from the parsed map before any explode, so a record with an empty map
    keeps degree 0."""
    return records.select(F.col(node).alias("id"), dict_degree(links).alias("out_degree"))


def source_degrees(graph: Graph) -> DataFrame:
    """(id, out_degree) for every node with at least one out-link."""
    return out_degree(graph.edges).select(F.col("src").alias("id"), "out_degree")


def record_count(graph: Graph) -> DataFrame:
    """One row: number of nodes that have an out-link list with links."""
    return graph.edges.agg(F.countDistinct("src").alias("records"))


def count_records(records: DataFrame) -> DataFrame:
    """One row: number of parsed adjacency records (lines), those with an
    empty map and those of one node on several lines included."""
    return records.agg(F.count(F.lit(1)).alias("records"))


def count_nodes(graph: Graph, approx: bool = False, rsd: float = 0.02) -> DataFrame:
    """One row: number of distinct node ids on either side of any link (plus
    ids of empty records).  ``approx`` trades exactness for a HyperLogLog
    estimate: each task keeps one sketch, the sketches merge, and the ids are
    never shuffled."""
    if not approx:
        return graph.vertices.agg(F.count(F.lit(1)).alias("nodes"))
    ids = graph.edges.select(F.col("src").alias("id")).unionByName(graph.edges.select(F.col("dst").alias("id")))
    if graph.extra_ids is not None:
        ids = ids.unionByName(graph.extra_ids.select(F.col("id").cast("string").alias("id")))
    return ids.agg(F.approx_count_distinct("id", rsd).alias("nodes"))


def dangling_count(graph: Graph) -> DataFrame:
    """One row: nodes, records (nodes with out-links) and dangling = nodes - records."""
    v = graph.vertices
    srcs = graph.edges.select(F.col("src").alias("id")).distinct()
    flagged = v.join(srcs.withColumn("_has", F.lit(True)), "id", "left")
    return flagged.agg(F.count(F.lit(1)).alias("nodes"),
                       F.count("_has").alias("records"),
                       F.count(F.when(F.col("_has").isNull(), 1)).alias("dangling"))


def average_degree(degrees: DataFrame) -> DataFrame:
    """One row: records, total links and average out-degree (partial + final
    aggregate; no driver-side fold)."""
    return degrees.agg(F.count(F.lit(1)).alias("records"),
                       F.sum("out_degree").alias("links"),
                       F.avg("out_degree").alias("avg_out_degree"))


def top_by(df: DataFrame, value: str, k: int = 10) -> DataFrame:
    """The ``k`` rows with the largest ``value``, ties broken by id.  Planned
    as TakeOrderedAndProject: per-partition top-k, then one merge of k rows per
    partition - no full sort."""
    return df.orderBy(F.desc(value), F.asc("id")).limit(k)


def sample_fixed(df: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """Exactly min(n, count) rows without replacement, repeatable for a seed:
    the n smallest md5(id || seed) keys (bounded top-n, no full shuffle)."""
    return (df.withColumn("_k", sample_key("id", seed))
              .orderBy("_k").limit(n).drop("_k"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram over [min, max] of ``value``: one row per bin
    (bin, lo, hi, count), empty bins included; a range of one single value is
    widened by 0.5 on each side.  min and max are scalar subqueries; the
    counting is a partial + final aggregate."""
    spark = df.sparkSession
    stats = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    flat = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    stats = stats.select((F.col("lo") - flat).alias("lo"), (F.col("hi") + flat).alias("hi"))
    lo, hi = stats.select("lo").scalar(), stats.select("hi").scalar()
    counts = (df.select(equal_width_bin(F.col(value).cast("double"), lo, hi, bins).alias("bin"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    width = (hi - lo) / F.lit(float(bins))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counts, "bin", "left")
            .where(lo.isNotNull())
            .select("bin",
                    (lo + F.col("bin") * width).alias("lo"),
                    F.when(F.col("bin") == bins - 1, hi)
                     .otherwise(lo + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def node_sketches(nodes: DataFrame, by: Column, precision: int = 12) -> DataFrame:
    """(kind, sketch): a HyperLogLog sketch of the ids of each kind ``by``
    tells, to be stored: a few KB each, whatever they stand for."""
    return nodes.groupBy(by.alias("kind")).agg(F.hll_sketch_agg("id", precision).alias("sketch"))


def merged_estimate(sketches: DataFrame) -> DataFrame:
    """(nodes): the approximate number of distinct ids in all of the sketches,
    without reading an id again (relative error 1.04 / sqrt(2**precision))."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("nodes"))
