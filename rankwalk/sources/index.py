"""Page-index source: ``title \\t id \\t inDeg \\t outDeg`` lines.

Ids are kept as STRING everywhere (link ids in the adjacency text are never
cast), so the title lookup joins string to string and a non-numeric id can
never fail a cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_SCHEMA = "title STRING, id STRING, in_degree BIGINT, out_degree BIGINT"


def read_index(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """Read index lines -> (id, title, in_degree, out_degree)."""
    df = (spark.read.schema(INDEX_SCHEMA)
          .option("sep", "\t").option("quote", "").option("escape", "")
          .option("mode", mode).csv(path))
    return df.select("id", "title", "in_degree", "out_degree")


def titles(index: DataFrame) -> DataFrame:
    """(id, title) lookup frame."""
    return index.select("id", "title")


def render_index(names: DataFrame, in_deg: DataFrame | None = None,
                 out_deg: DataFrame | None = None) -> DataFrame:
    """(id, title) [+ degrees] -> index lines (value STRING)."""
    df = names
    if in_deg is not None:
        df = df.join(in_deg.withColumnRenamed("dst", "id"), "id", "left")
    else:
        df = df.withColumn("in_degree", F.lit(0))
    if out_deg is not None:
        df = df.join(out_deg.select(F.col("src").alias("id"), "out_degree"), "id", "left")
    else:
        df = df.withColumn("out_degree", F.lit(0))
    # concat_ws skips NULLs: an empty field instead keeps the others in place.
    return df.select(F.concat_ws("\t", F.coalesce("title", F.lit("")), F.coalesce("id", F.lit("")),
                                 F.coalesce(F.col("in_degree"), F.lit(0)).cast("string"),
                                 F.coalesce(F.col("out_degree"), F.lit(0)).cast("string")).alias("value"))
