"""Repeated word windows removed everywhere but where they come first.

A window is ``size`` consecutive words of one document.  Pass one: every task
sketches the windows of its documents (a document counts a window once), the
partition sketches are merged, and the merged count-min sketch, which never
underestimates, tells which windows may occur in two documents or more.  Pass
two groups exactly those windows: per window (96 bits of fingerprint) the
smallest and largest doc_id, summed up map-side, so that a passage found in a
third of all documents is one row a task.  Windows found under one doc_id only
(false alarms of the sketch) go; the rest are the repeated windows.  They are
joined back with the windows' places (both sides plain shuffles of written
data, so a hot window's partition is split), the places whose document is not
the first go to their document, and its words under them are cut.

A second membership filter, made of the repeated windows, keeps the false
alarms of the first from being shuffled twice.

Cases: a null or empty text, or one shorter than a window, loses nothing; a
null doc_id is neither smaller nor larger than any other, so such documents
neither lose nor claim windows; documents with the same doc_id do not remove
each other's windows; repeated rows are treated alike; empty tables give an
empty result; other columns pass through ``deduplicated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialise, row_key
from .countmin import Filter, Shape, repeated_bits, seen_bits, sketch
from .textkernel import Piece, covered, pieces, windows

PREFILTER = Shape(depth=2, log2=28)
REPEATED = Shape(depth=1, log2=28)
KEY = ["k1", "k2"]


def _key() -> list[Column]:
    """The row's 128-bit identity as two longs: rows that share a doc_id are told apart by their texts."""
    return [F.conv(F.substring(row_key(), 1 + 16 * i, 16), 16, -10).cast("long").alias(k) for i, k in enumerate(KEY)]


def _windows_of(piece: Piece, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, row and word position (in the text) of each window's first
    place in its text."""
    every = windows(piece.word_hashes(), size)
    counts = np.maximum(np.diff(piece.words) - size + 1, 0)
    row = np.repeat(np.arange(piece.n), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    pos = np.arange(len(row)) - first
    hashes = every[piece.words[row] + pos] if len(row) else every[:0]
    keys = hashes ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(row), dtype=bool)
    again[order[1:]] = keys[order][1:] == keys[order][:-1]
    return hashes[~again], row[~again], pos[~again]


def _check_bits(piece: Piece, size: int, row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """32 further bits of each window, from a second polynomial."""
    if not len(row):
        return np.zeros(0, dtype=np.int32)
    return (windows(piece.word_hashes(), size, seed=7)[piece.words[row] + pos] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _places(docs: DataFrame, size: int, held: Filter) -> DataFrame:
    """(window, check, doc_id, k1, k2, pos) of the windows that the filter lets through."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = held.open()
        for batch in batches:
            for piece in pieces(batch.column("text")):
                hashes, row, pos = _windows_of(piece, size)
                hit = passes(hashes)
                row, pos = row[hit], pos[hit]
                ids = batch.select(["doc_id", *KEY]).take(pa.array(row + piece.first)).columns
                yield pa.RecordBatch.from_arrays([pa.array(hashes[hit].view(np.int64)), pa.array(_check_bits(piece, size, row, pos)),
                                                  *ids, pa.array(pos.astype(np.int32))], ["window", "check", "doc_id", *KEY, "pos"])

    return (docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), *_key(), "text")
            .mapInArrow(places, "window long, check int, doc_id long, k1 long, k2 long, pos int"))


def later_places(docs: DataFrame, size: int = 13, prefilter: Shape = PREFILTER, repeated: Shape = REPEATED) -> DataFrame:
    """(doc_id, k1, k2, positions): per document the word positions at which a
    window starts that a document with a smaller doc_id has too (the first
    position of each such window)."""
    spark = docs.sparkSession

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for piece in pieces(batch.column(0)):
            yield _windows_of(piece, size)[0]

    texts = docs.where("doc_id is not null").select("text")
    likely = Filter(spark, prefilter, sketch(texts, hashes, prefilter, repeated_bits))
    firsts = (_places(docs, size, likely).groupBy("window", "check")
              .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .where("first < last").select("window", "check", "first"))
    firsts = materialise(firsts, "repeated-windows")
    known = Filter(spark, repeated, sketch(firsts.select("window"), lambda b: [b.column(0).to_numpy().view(np.uint64)],
                                           repeated, seen_bits))
    later = (_places(docs, size, known).join(firsts, ["window", "check"]).where(F.col("first") < F.col("doc_id"))
             .select("doc_id", *KEY, "pos"))
    later = materialise(later, "later-places")
    return later.groupBy("doc_id", *KEY).agg(F.collect_set("pos").alias("positions"))


def _cut(size: int, with_text: bool):
    """UDF (text, positions) -> n_words, n_removed, kept text or its digest."""

    @F.arrow_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                               T.StructField("kept", T.StringType())]))
    def cut(texts: pa.Array, positions: pa.Array) -> pa.Array:
        out: list[tuple] = []
        for piece in pieces(texts):
            marks = np.zeros(len(piece.starts) + 1, dtype=bool)
            every = windows(piece.word_hashes(), size)
            for i in range(piece.n):
                at = positions[piece.first + i]
                a, b = piece.words[i], piece.words[i + 1]
                if at.is_valid and b - a >= size:
                    own = every[a:b - size + 1]
                    marks[a:b - size + 1] = np.isin(own, own[at.values.to_numpy()])
            gone = covered(marks[: max(0, len(piece.starts) - size + 1)], size) if len(piece.starts) >= size else marks[:-1]
            raw = piece.data.tobytes()
            for i in range(piece.n):
                a, b = int(piece.words[i]), int(piece.words[i + 1])
                stay = np.flatnonzero(~gone[a:b]) + a
                kept = b" ".join([raw[s:e] for s, e in zip(piece.starts[stay].tolist(), piece.ends[stay].tolist())])
                out.append((b - a, b - a - len(stay), kept.decode() if with_text else hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) or [[], [], []]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                          names=["n_words", "n_removed", "kept"])

    return cut


def _joined(docs: DataFrame, later: DataFrame, columns: list[str]) -> tuple[DataFrame, str]:
    keys, positions = [fresh(docs, f"{k}_") for k in KEY], fresh(docs, "positions_")
    later = materialise(later, "later-positions").select(*[F.col(c).alias(f"_later_{c}") for c in ("doc_id", *KEY)], F.col("positions").alias(positions))
    marked = docs.select(*columns, *[c.alias(k) for c, k in zip(_key(), keys)])
    same = F.col("doc_id") == F.col("_later_doc_id")
    for k, name in zip(KEY, keys):
        same &= F.col(name) == F.col(f"_later_{k}")
    return marked.join(later, same, "left").drop(*[f"_later_{c}" for c in ("doc_id", *KEY)], *keys), positions


def deduplicated(docs: DataFrame, size: int = 13) -> DataFrame:
    """``docs`` with the repeated words cut: the words of a text that loses any
    are joined by one space (n_chars, if present, set anew)."""
    joined, positions = _joined(docs, later_places(docs, size), docs.columns)
    result = fresh(joined, "cut_")
    joined = joined.withColumn(result, _cut(size, True)("text", positions))
    text = F.when(F.col(f"{result}.n_removed") > 0, F.col(f"{result}.kept")).otherwise(F.col("text"))
    changes = {"text": text} | ({"n_chars": F.char_length(text).cast("bigint")} if "n_chars" in docs.columns else {})
    return joined.select(*[changes.get(c, F.col(c)).alias(c) for c in docs.columns])


def substring_dedup(docs: DataFrame, size: int = 13, prefilter: Shape = PREFILTER, repeated: Shape = REPEATED) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    joined, positions = _joined(docs, later_places(docs, size, prefilter, repeated), ["doc_id", "text"])
    out = joined.select("doc_id", _cut(size, False)("text", positions).alias("_"))
    return out.select("doc_id", "_.n_words", "_.n_removed", F.col("_.kept").alias("kept_sha256"))
