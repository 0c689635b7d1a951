"""Contiguous shards of near equal bytes.  DataFrame operations only.

Rows are put in the order of doc_id (then text fingerprint); the exclusive
byte prefix sum of each row comes from per-partition totals plus a running sum
inside its partition; the cuts lie at equal targets, total * k / shards, and a
row belongs to the shard in which its middle byte lies.  No shard's bytes are
further from the target than the largest row.  Numbers within a shard come
from the row count's prefix sums in the same way.

A third of all rows sharing one doc_id, or even being equal, is split over
partitions, as the input row number ends the order.

Cases: a null text has 0 bytes and the CRC-32 of the empty text (0); a null
doc_id comes last; ties and repeated rows are numbered by their order in the
input; an empty table gives an empty result; with fewer rows than shards some
shards stay empty; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, with_global_position

ROW_OVERHEAD = 8


def balanced_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, first_byte."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit(1).cast("bigint").alias("one"))
    placed = with_global_position(sized, ["doc_id", "text_crc32", "size"], {"first_byte": "size", "nr": "one"}, "shard-sizes")
    middle = 2 * F.col("first_byte") + F.col("size")
    placed = placed.withColumn("shard", F.floor(middle * shards / (2 * F.col("first_byte_total"))).cast("int"))
    placed = materialise(placed.select("doc_id", "size", "text_crc32", "first_byte", "nr", "shard"), "shard-rows")
    starts = F.broadcast(placed.groupBy("shard").agg(F.min("nr").alias("start")))
    return placed.join(starts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("nr") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "first_byte")
