"""Benchmark items found inside documents: MinHash containment, then exact.

Texts become sets of 5-word shingles (A-Z lower-cased; fewer words: the whole
sequence).  A document holds an item when at least 4/5 of the item's shingles
are the document's, so some of the item's q - ceil(4q/5) + 1 smallest shingle
hashes must be among them: those are the item's MinHash sketch.  Items are
partitioned by size (powers of two); the largest sketch hash of a partition is
its cut, and a document's sketch for that partition is every shingle hash up to
the cut, so a document's sketch is as long as the document requires and a
12-shingle item is found in a 100,000-word text as surely as in a short one.
A document and an item that share a sketch hash are a candidate pair, and the
pair is kept when an exact count of common shingles reaches 4/5.

One pass reads the texts.  It keeps only hashes that a membership filter over
the items' shingles lets through (fixed size, broadcast; it has false hits but
no misses), so what is shuffled is a few narrow rows a document.  Hits, items
and sketches are written tables: a hash that a third of the documents share
meets a small item table that Spark broadcasts, or is split in a join of plain
shuffles.

An item is known by a digest of its text until its item_ids are joined at the
end, so ids need not be unique: shingles are counted once for each text.

Cases: null and empty texts of documents or items have no shingles and never
match; items with equal texts match alike, and each of their rows gives a
result; items with equal or null ids but other texts are counted apart; rows
with equal doc_id and text are one document; a null item_id or doc_id is
carried as null; empty tables give an empty result; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, row_key
from .countmin import Filter, Shape, seen_bits, sketch
from .textkernel import pieces, shingle_sets

SHINGLE = 5
FILTER = Shape(depth=2, log2=24)
NEEDED, OF = 4, 5      # containment of at least 4/5


def item_key() -> Column:
    """128-bit identity of an item's text."""
    return F.md5(F.col("text").cast("binary"))


def item_shingles(items: DataFrame) -> DataFrame:
    """(item, hash, q, class, sketch): every shingle of every distinct item
    text; sketch marks the item's smallest q - ceil(4q/5) + 1 hashes."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("item").to_pylist()
            out: list[tuple] = []
            for piece in pieces(batch.column("text")):
                for i, hashes in enumerate(shingle_sets(piece, SHINGLE), piece.first):
                    q = len(hashes)
                    small = q - -(-NEEDED * q // OF) + 1
                    ranked = hashes.view(np.int64)
                    out += [(keys[i], h, q, q.bit_length(), k < small) for k, h in enumerate(ranked.tolist())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()))],
                                                 ["item", "hash", "q", "class", "sketch"])

    return items.select("text").distinct().select(item_key().alias("item"), "text").mapInArrow(
        shingles, "item string, hash long, q int, class int, sketch boolean")


def _hits(docs: DataFrame, held: Filter) -> DataFrame:
    """(row_key, doc_id, hash) of document shingles that the filter lets through."""

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = held.open()
        for batch in batches:
            for piece in pieces(batch.column("text")):
                sets = list(shingle_sets(piece, SHINGLE))
                every = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                row = np.repeat(np.arange(piece.first, piece.first + piece.n), [len(s) for s in sets])
                hit = passes(every)
                rows = batch.select(["row_key", "doc_id"]).take(pa.array(row[hit]))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(every[hit].view(np.int64))],
                                                 ["row_key", "doc_id", "hash"])

    return docs.select(row_key().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        hits, "row_key string, doc_id long, hash long")


def document_sketches(hits: DataFrame, shingles: DataFrame) -> DataFrame:
    """(row_key, class, hash): for each size class of items the document's
    hashes up to the class's cut.  There is one cut for each bit length of an
    item's size, so at most 32 come to the driver."""
    unsigned = lambda c: F.col(c).bitwiseXOR(F.lit(-(2**63)))  # noqa: E731  unsigned order on signed longs
    cuts = shingles.where("sketch").groupBy("class").agg(F.max(unsigned("hash")).alias("cut")).collect()
    reached = F.array(*[F.when(unsigned("hash") <= F.lit(c["cut"]), F.lit(c["class"])) for c in cuts]).cast("array<int>")
    return hits.select("row_key", F.explode(F.array_compact(reached)).alias("class"), "hash")


def candidates(hits: DataFrame, shingles: DataFrame) -> DataFrame:
    """(row_key, item): the document's sketch and the item's share a hash."""
    of_items = shingles.where("sketch").select("class", "hash", "item")
    return document_sketches(hits, shingles).join(of_items, ["class", "hash"]).select("row_key", "item").distinct()


def verified(hits: DataFrame, shingles: DataFrame, pairs: DataFrame) -> DataFrame:
    """(row_key, doc_id, item, n_shared, q) of the pairs whose common shingles,
    counted for these pairs alone, reach 4/5 of the item's."""
    wanted = pairs.join(shingles.select("item", "hash", "q"), "item")
    counted = (wanted.join(hits, ["row_key", "hash"]).groupBy("row_key", "item")
               .agg(F.count(F.lit(1)).alias("n_shared"), F.first("q").alias("q"), F.first("doc_id").alias("doc_id")))
    return counted.where(OF * F.col("n_shared") >= NEEDED * F.col("q"))


def _contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row_key, doc_id, item, n_shared, q), one row per document and item text
    held; n_shared >= 4/5 q."""
    shingles = materialise(item_shingles(items), "item-shingles")
    blobs = sketch(shingles.select("hash"), lambda b: [b.column(0).to_numpy().view(np.uint64)], FILTER, seen_bits)
    hits = materialise(_hits(docs, Filter(docs.sparkSession, FILTER, blobs)).distinct(), "shingle-hits")
    return verified(hits, shingles, materialise(candidates(hits, shingles), "contained-candidates"))


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row_key, doc_id, item_id, n_shared, n_item_shingles), one row per
    document and row of items held; n_shared >= 4/5 n_item_shingles."""
    ids = items.select(item_key().alias("item"), F.col("item_id").cast("long").alias("item_id"))
    return (_contained(docs, items).join(ids, "item")
            .select("row_key", "doc_id", "item_id", "n_shared", F.col("q").cast("bigint").alias("n_item_shingles")))


def benchmark_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document and benchmark item held: doc_id, item_id, n_shared,
    n_item_shingles (rows with equal doc_id and text once)."""
    return contained_items(docs, items).drop("row_key")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    leaks = materialise(_contained(docs, items).select("row_key").distinct(), "leaks")
    key = fresh(docs, "row_key_")
    return docs.withColumn(key, row_key()).join(leaks.withColumnRenamed("row_key", key), key, "left_anti").select(*docs.columns)
