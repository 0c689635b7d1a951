"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A text's features are counts of byte trigrams, hashed: once over character
shapes (letters as one class, capitals, digits, blanks, each mark as itself)
and once over the characters, plus its equal neighbouring words and its words
in repeated windows.  Counts are damped (log), weighted by inverse document
frequency and projected on the leading singular directions of a bounded
sample of labelled documents: the latent-semantic vectors.

The labelled vectors (at most ``max_labelled`` rows, the ones with the
smallest hash of their doc_id, times ``dims``) are broadcast; every document
is compared with all of them in exact blocks of cosine products; the
``neighbours`` nearest, and all that are as near as the last of them, vote with
their labels, weighted by similarity.  The
score is the share of label 1 among the votes, each class weighted to even
priors, so that a rare class is heard.

Learned only from labelled rows whose crc32(doc_id as text) mod 5 is not 0;
features are functions of the text alone.

Cases: a null or empty text (or one without trigrams) has a zero vector, is
equally near to all and scores the prior share 0.5; a null
doc_id is neither held out nor learned from; null labels and repeated label
rows of one document count once with the smaller label; without any usable
label every score is 0.5; repeated rows score alike; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .quality_rules import measure_piece
from .textkernel import Piece, pieces

SHAPE_BINS, CHAR_BINS = 512, 512
EXTRA = 2
TIE = np.float32(1e-6)      # cosines this close are equal but for rounding
BINS = SHAPE_BINS + CHAR_BINS + EXTRA
_SHAPE = np.arange(256, dtype=np.uint32)
_SHAPE[97:123] = _SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_CHAR = np.arange(256, dtype=np.uint32)
_CHAR[65:91] += 32


@dataclass(frozen=True)
class Settings:
    """Bounds and parameters of the classifier."""

    max_labelled: int = 4000
    dims: int = 48
    neighbours: int = 31
    sharpness: float = 8.0
    folds: int = 5
    threshold: float = 0.3


def _trigrams(piece: Piece, table: np.ndarray, bins: int) -> np.ndarray:
    out = np.zeros((piece.n, bins), dtype=np.float32)
    c = table[piece.data]
    if len(c) < 3:
        return out
    codes = ((c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]) * np.uint32(2654435761)
    codes >>= np.uint32(32 - bins.bit_length() + 1)
    row = np.repeat(np.arange(piece.n), np.diff(piece.offsets))
    inside = row[:-2] == row[2:]
    flat = row[:-2][inside] * bins + codes[inside]
    return np.bincount(flat, minlength=piece.n * bins).reshape(piece.n, bins).astype(np.float32)


def features(piece: Piece) -> np.ndarray:
    """Damped feature counts of every text of the piece: n x BINS."""
    n_words = np.diff(piece.words)
    of = np.repeat(np.arange(piece.n), n_words)
    words = piece.word_hashes(lower=True)
    twin = np.zeros(piece.n)
    if len(words) > 1:
        twin = np.bincount(of[1:][(words[1:] == words[:-1]) & (of[1:] == of[:-1])], minlength=piece.n)
    repeat = measure_piece(piece)[4]
    extra = np.stack([twin, repeat], axis=1).astype(np.float32)
    return np.log1p(np.concatenate([_trigrams(piece, _SHAPE, SHAPE_BINS), _trigrams(piece, _CHAR, CHAR_BINS), extra], axis=1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    weights: np.ndarray     # BINS: inverse document frequencies
    axes: np.ndarray        # BINS x dims
    vectors: np.ndarray     # labelled x dims, unit length
    votes: np.ndarray       # labelled x 2: class weights of the label

    def project(self, raw: np.ndarray) -> np.ndarray:
        return _unit(_unit(raw * self.weights) @ self.axes)

    def scores(self, raw: np.ndarray, settings: Settings, block: int = 512) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(raw), 0.5)
        near = min(settings.neighbours, len(self.vectors))
        out = []
        for i in range(0, len(raw), block):
            found = self.project(raw[i:i + block])
            cosine = found @ self.vectors.T
            last = np.partition(cosine, -near, axis=1)[:, -near]
            voters = cosine >= last[:, None] - TIE
            weight = np.where(voters, np.exp(settings.sharpness * (cosine - 1.0)), 0).astype(np.float64)
            votes = weight @ self.votes
            out.append(np.where(found.any(axis=1), votes[:, 1] / votes.sum(axis=1), 0.5))
        return np.clip(np.concatenate(out), 0.0, 1.0)


def train(raw: np.ndarray, labels: np.ndarray, dims: int) -> Model:
    """Latent-semantic axes and voters from labelled feature rows."""
    if not len(raw):
        return Model(np.ones(BINS, np.float32), np.zeros((BINS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros((0, 2)))
    weights = np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    x = _unit(raw * weights)
    _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = np.ascontiguousarray(axes[:, ::-1][:, :dims]).astype(np.float32)
    share = np.bincount(labels, minlength=2) / len(labels)
    votes = np.zeros((len(labels), 2))
    votes[np.arange(len(labels)), labels] = 1 / np.maximum(share[labels], 1e-9)
    return Model(weights, axes, _unit(x @ axes), votes)


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on the bounded sample of labelled documents outside fold 0."""
    known = (labels.where("quality in (0, 1) and doc_id is not null").where(fold(F.col("doc_id"), settings.folds) != 0)
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    known = known.join(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_semi")
    picked = materialise(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_labelled), "labelled")

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                rows = [r.astype(np.float16).tobytes() for r in features(piece)]
                yield pa.RecordBatch.from_arrays([*batch.select(["doc_id", "quality"]).slice(piece.first, piece.n).columns,
                                                  pa.array(rows, pa.binary())], ["doc_id", "quality", "raw"])

    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = (sample.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "text")
            .mapInArrow(raw, "doc_id long, quality int, raw binary").groupBy("doc_id", "quality").agg(F.min("raw").alias("raw")).collect())
    rows.sort(key=lambda r: r["doc_id"])
    matrix = np.array([np.frombuffer(r["raw"], dtype=np.float16) for r in rows], dtype=np.float32).reshape(len(rows), BINS)
    return train(matrix, np.array([r["quality"] for r in rows], dtype=np.int64), settings.dims)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    # Plain arrays: executors that do not have this package can unpickle them.
    held = docs.sparkSession.sparkContext.broadcast(tuple(vars(fit(docs, labels, settings)).values()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*held.value)
        for batch in batches:
            for piece in pieces(batch.column("text")):
                found = model.scores(features(piece), settings)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(piece.first, piece.n), pa.array(found, pa.float64())],
                                                 ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), settings.folds) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= settings.threshold).cast("int").alias("predicted"))
