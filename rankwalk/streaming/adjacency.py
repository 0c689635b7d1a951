"""Adjacency text arriving as files in a folder, read with Structured
Streaming.  The same JVM-side parser as the batch source; the EDA numbers
(records, links, average out-degree, per-node out-degree) become running
aggregates whose state Spark keeps in its checkpointed state store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import dict_degree
from ..session import scratch_path
from ..sources.adjacency import parse_adjacency


def read_adjacency_stream(spark: SparkSession, path: str, mode: str = "FAILFAST",
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (node, links) from text files dropped into ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_adjacency(reader.load(path), mode=mode).select("node", "links")


def running_degree_stats(records: DataFrame) -> DataFrame:
    """One running row: records seen, links seen, average out-degree."""
    deg = records.select(dict_degree("links").alias("out_degree"))
    return deg.agg(F.count(F.lit(1)).alias("records"),
                   F.sum("out_degree").alias("links"),
                   F.avg("out_degree").alias("avg_out_degree"))


def running_out_degree(records: DataFrame) -> DataFrame:
    """Per node: out-degree summed over all its lines seen so far."""
    return (records.select(F.col("node").alias("id"), dict_degree("links").alias("d"))
                   .groupBy("id").agg(F.sum("d").alias("out_degree")))


def start_to_memory(df: DataFrame, name: str, output_mode: str = "complete") -> StreamingQuery:
    """Run an aggregate stream into an in-memory table ``name`` with its
    state checkpointed under the shared checkpoint folder."""
    spark = df.sparkSession
    return (df.writeStream.outputMode(output_mode).format("memory").queryName(name)
              .option("checkpointLocation", scratch_path(spark, f"stream-{name}"))
              .start())
