"""Data-directory inventory: file listing and total size, as a Spark scan.

``binaryFile`` lists files in parallel; selecting only path and length
prunes the ``content`` column, so no file body is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """(path, name, length) for every file under ``path``."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(path).select("path", "length")
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def directory_size(files: DataFrame) -> DataFrame:
    """One row: number of files and total bytes."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
