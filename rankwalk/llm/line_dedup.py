"""Corpus-wide removal of lines that many documents share.

Lines are normalised (white space stripped at both ends, A-Z lower-cased) and
hashed to 128 bits; each document gives a hash once, so counting rows counts
documents; hashes of at least ``min_docs`` documents form the written table of
common lines.  The documents' (position, hash) rows are joined with it, the
positions to drop return to their document, and the other lines are
reassembled in their order.

A line that a third of all documents hold is one partial sum per task when it
is counted; in the join both sides are plain shuffles of written data (or the
common lines are small enough for Spark to broadcast), so its partition is
split.

Cases: a null or empty text has one empty line; lines with an empty key are
never dropped; a null text stays null; each row is a document, so a repeated
row counts as one more; rows with equal doc_id and text share their fate; an
empty table gives an empty result; other columns pass through ``deduplicated``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialise, row_key

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


@F.arrow_udf(T.StringType())
def without_lines(texts: pa.Array, positions: pa.Array) -> pa.Array:
    """The text less the \\n-split lines at the given positions."""
    out = []
    for text, drop in zip(texts, positions):
        text = text.as_py()
        if text is not None and drop.is_valid:
            lines = text.split("\n")
            keep = np.ones(len(lines), dtype=bool)
            keep[drop.values.to_numpy(zero_copy_only=False)] = False
            text = "\n".join(lines[i] for i in np.flatnonzero(keep))
        out.append(text)
    return pa.array(out, pa.string())


def dropped_positions(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(row_key, positions): the lines to drop of every document that has any."""
    # A key too short to count has a null hash; hex strings, since Spark finds
    # distinct strings of an array by hashing but distinct binaries by pairs.
    hashed = F.transform(lines_of(F.col("text")), lambda x: F.when(F.char_length(line_key(x)) >= min_chars, F.md5(line_key(x).cast("binary"))))
    hashed = materialise(docs.select(row_key().alias("row_key"), hashed.alias("hashes")), "line-hashes")
    common = (hashed.select(F.explode(F.array_distinct("hashes")).alias("hash")).where("hash is not null")
              .groupBy(F.unhex("hash").alias("hash")).agg(F.count(F.lit(1)).alias("docs"))
              .where(F.col("docs") >= min_docs).select("hash"))
    common = materialise(common, "common-lines")
    placed = hashed.select("row_key", F.posexplode("hashes").alias("pos", "hash")).where("hash is not null")
    placed = placed.select("row_key", "pos", F.unhex("hash").alias("hash"))
    return placed.join(common, "hash").groupBy("row_key").agg(F.collect_set("pos").alias("positions"))


def _with_positions(docs: DataFrame, min_docs: int, min_chars: int) -> tuple[DataFrame, str]:
    drops = materialise(dropped_positions(docs, min_docs, min_chars), "line-drops")
    key, positions = fresh(docs, "row_key_"), fresh(docs, "positions_")
    return (docs.withColumn(key, row_key())
                .join(drops.select(F.col("row_key").alias(key), F.col("positions").alias(positions)), key, "left")
                .drop(key), positions)


def deduplicated(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with the common lines cut from text (n_chars, if present, set anew)."""
    joined, positions = _with_positions(docs, min_docs, min_chars)
    new = fresh(joined, "text_")
    joined = joined.withColumn(new, without_lines("text", positions))
    changes = {"text": F.col(new)} | ({"n_chars": F.char_length(F.col(new)).cast("bigint")} if "n_chars" in docs.columns else {})
    return joined.select(*[changes.get(c, F.col(c)).alias(c) for c in docs.columns])


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256, text (what is left)."""
    joined, positions = _with_positions(docs.select("doc_id", "text"), min_docs, min_chars)
    return joined.select(
        "doc_id", F.size(lines_of(F.col("text"))).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(positions), F.lit(0)).cast("bigint").alias("n_dropped"),
        without_lines("text", positions).alias("text"),
    ).withColumn("kept_sha256", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
