"""Quality rules with thresholds learned from quantile sketches.

Every text is measured (words, symbols, capitals, punctuation, repeated lines
and windows).  The documents that pass the base rules feed one quantile sketch
per measure, language and source.  A sketch is a table of counts in
log-linear buckets (relative width 1/32, exact below 64): sketches merge by
adding counts, which Spark does with map-side partial sums, and the merged
sketches of a language and of the whole corpus stand in for sources and
languages with too few documents.  A document is rejected when one of its
rates lies beyond its group's fence: median + spread times the larger of the
distances from the median to the 10th and to the 75th centile (below, for word
length, also the mirror image).  These centiles stay with ordinary documents
while less than a quarter of a source is junk.  A least distance stands in only
where a group has hardly any variation.

All measures and thresholds are integers, so the result does not depend on
the order of summation.

Cases: a null or empty text has no words and fails the base rules; null
language or source values form groups of their own; repeated rows are judged
alike (and counted each); an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, log_cell, log_cell_floor, materialise
from .textkernel import Piece, covered, pieces, spans_hash, windows

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
REPEAT_WINDOW = 8
EXACT_BITS = 6

# The symbol characters, and the ASCII punctuation counted as marks.
SYMBOLS = "#*$%&|<>"
MARKS = "!\"'()+,-./:;=?@[\\]^_`{}~"


@dataclass(frozen=True)
class Rates:
    """Parameters of the adaptive rules.

    least: smallest distance (in the rate's unit) that counts as the spread of
    ordinary documents, so that a group without variation does not reject the
    first document that differs; wider for repetition, of which most documents
    have none and short ones at once a good share.
    """

    spread: int = 8
    min_group: int = 100
    least_rate: int = 4           # per thousand
    least_dup_lines: int = 50     # per thousand
    least_repeat: int = 30        # per thousand
    least_length: int = 10        # hundredths of a character

    def least(self, rate: str) -> int:
        return {"word_length": self.least_length, "dup_line_rate": self.least_dup_lines,
                "repeat_rate": self.least_repeat}.get(rate, self.least_rate)


RATES = ["symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "mark_rate", "word_length"]
_TABLE = {name: np.isin(np.arange(256), [ord(c) for c in chars]) for name, chars in
          (("symbols", SYMBOLS), ("marks", MARKS), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))}
_CODE_POINT = (np.arange(256) & 0xC0) != 0x80
_CODE_POINT[[0x20, *range(0x09, 0x0E)]] = False


def _per_text(piece: Piece, table: np.ndarray) -> np.ndarray:
    out = np.zeros(piece.n, dtype=np.int64)
    full = np.flatnonzero(piece.offsets[:-1] < piece.offsets[1:])
    if len(full):
        out[full] = np.add.reduceat(table[piece.data].view(np.uint8), piece.offsets[:-1][full], dtype=np.int64)
    return out


def measure_piece(piece: Piece) -> list[np.ndarray]:
    n_words = np.diff(piece.words)
    starts, ends, row = piece.lines()
    with_word = np.searchsorted(piece.starts, starts) < np.searchsorted(piece.starts, ends)
    starts, ends, row = starts[with_word], ends[with_word], row[with_word]
    line = spans_hash(piece.data, starts, ends)
    order = np.lexsort((line, row))
    again = (row[order][1:] == row[order][:-1]) & (line[order][1:] == line[order][:-1])
    n_dup = np.bincount(row[order][1:][again], minlength=piece.n)
    n_lines = np.bincount(row, minlength=piece.n)

    of = np.repeat(np.arange(piece.n, dtype=np.uint64), n_words)
    every = windows(piece.word_hashes(), REPEAT_WINDOW)
    n_repeat = np.zeros(piece.n, dtype=np.int64)
    if len(every):
        inside = of[: len(every)] == of[REPEAT_WINDOW - 1:]
        keys = (every ^ (of[: len(every)] * np.uint64(0x9E3779B97F4A7C15)))
        held = np.sort(keys[inside])
        twice = np.unique(held[1:][held[1:] == held[:-1]])
        if len(twice):
            marks = inside & (twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys)
            n_repeat = np.bincount(of[covered(marks, REPEAT_WINDOW)].astype(np.int64), minlength=piece.n)
    return [n_words, _per_text(piece, _CODE_POINT), _per_text(piece, _TABLE["symbols"]), n_dup, n_repeat, n_lines,
            _per_text(piece, _TABLE["upper"]), _per_text(piece, _TABLE["marks"])]


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measures(texts: pa.Array) -> pa.Array:
    """Measures of every text (null: as an empty text)."""
    found = [measure_piece(p) for p in pieces(texts)]
    columns = [np.concatenate(c) if found else np.zeros(0, dtype=np.int64) for c in (zip(*found) if found else [[]] * len(MEASURES))]
    return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=MEASURES)


def rates(m: str) -> dict[str, Column]:
    """Integer rates from the struct column ``m``."""
    per = lambda a, b, unit: F.floor(unit * F.col(f"{m}.{a}") / F.greatest(F.col(f"{m}.{b}"), F.lit(1)))
    return {"symbol_rate": per("n_symbols", "word_chars", 1000), "dup_line_rate": per("n_dup_lines", "n_lines", 1000),
            "repeat_rate": per("n_repeat_words", "n_words", 1000), "upper_rate": per("n_upper", "word_chars", 1000),
            "mark_rate": per("n_marks", "word_chars", 1000), "word_length": per("word_chars", "n_words", 100)}


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < 20) | (100 * F.col(f"{m}.n_repeat_words") > 30 * F.col(f"{m}.n_words"))


def sketches(measured: DataFrame, m: str) -> DataFrame:
    """(lang, source, rate, bucket, n): one mergeable sketch a group and rate."""
    r = rates(m)
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("rate"), r[k].alias("value")) for k in RATES])).alias("_")
    return (measured.where(~base_failed(m)).select("lang", "source", pairs)
            .groupBy("lang", "source", F.col("_.rate").alias("rate"), log_cell(F.col("_.value"), EXACT_BITS).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def _fences(cells: DataFrame, by: list[str], rules: Rates) -> DataFrame:
    """lo and hi fence of each sketch, after merging to the columns ``by``."""
    cells = cells.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "rate")
    cells = (cells.withColumn("upto", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("of", F.sum("n").over(group)))
    at = lambda centile: log_cell_floor(F.min(F.when(100 * F.col("upto") >= centile * F.col("of"), F.col("bucket"))), EXACT_BITS)
    q = cells.groupBy(*by, "rate").agg(F.max("of").alias("of"), at(10).alias("low"), at(50).alias("mid"), at(75).alias("high"))
    least = F.create_map(*[F.lit(x) for k in RATES for x in (k, rules.least(k))])[F.col("rate")]
    reach = rules.spread * F.greatest(F.col("mid") - F.col("low"), F.col("high") - F.col("mid"), least)
    return q.select(*by, "rate", "of", (F.col("mid") - reach).alias("lo"), (F.col("mid") + reach).alias("hi"))


def thresholds(cells: DataFrame, rules: Rates = Rates()) -> DataFrame:
    """One row per (lang, source): lo and hi of every rate, from the group's
    own sketch, else its language's, else the corpus's."""
    own, lang, every = (_fences(cells, by, rules) for by in (["lang", "source"], ["lang"], []))
    a, b, c = own.alias("a"), lang.alias("b"), every.alias("c")
    joined = (a.join(b, F.col("a.lang").eqNullSafe(F.col("b.lang")) & (F.col("a.rate") == F.col("b.rate")))
               .join(c, F.col("a.rate") == F.col("c.rate")))
    pick = lambda f: (F.when(F.col("a.of") >= rules.min_group, F.col(f"a.{f}"))
                       .when(F.col("b.of") >= rules.min_group, F.col(f"b.{f}")).otherwise(F.col(f"c.{f}")).alias(f))
    picked = joined.select("a.lang", "a.source", "a.rate", pick("lo"), pick("hi"))
    value = lambda k, f: F.max(F.when(F.col("rate") == k, F.col(f))).alias(f"{f}_{k}")
    return picked.groupBy("lang", "source").agg(*[value(k, f) for k in RATES for f in ("lo", "hi")])


def judged(measured: DataFrame, m: str, limits: DataFrame, verdict: str) -> DataFrame:
    """``measured`` with boolean column ``verdict``.

    The thresholds are joined per (lang, source).  They are a written table,
    so Spark broadcasts it when it is small, and else splits a hot source's
    partitions in a join of two plain shuffles."""
    t = limits.select(F.struct(*limits.columns).alias(fresh(measured, "limits")))
    name = t.columns[0]
    joined = measured.join(t, F.col("lang").eqNullSafe(F.col(f"{name}.lang")) & F.col("source").eqNullSafe(F.col(f"{name}.source")), "left")
    r = rates(m)
    inside = ~base_failed(m)
    for k in RATES:
        inside &= F.coalesce(r[k] <= F.col(f"{name}.hi_{k}"), F.lit(True))
    inside &= F.coalesce(r["word_length"] >= F.col(f"{name}.lo_word_length"), F.lit(True))
    return joined.withColumn(verdict, inside).drop(name)


def learn(docs: DataFrame, rules: Rates = Rates()) -> DataFrame:
    """The written threshold table of ``docs`` (columns text, lang, source)."""
    measured = docs.select("lang", "source", measures("text").alias("m"))
    return materialise(thresholds(materialise(sketches(measured, "m"), "sketches"), rules), "thresholds")


def filtered(docs: DataFrame, rules: Rates = Rates()) -> DataFrame:
    """The documents that pass, with the columns of ``docs``; the text is read
    twice and never shuffled while the threshold table is small."""
    m, verdict = fresh(docs, "measures_"), fresh(docs, "kept_")
    measured = docs.withColumn(m, measures("text"))
    return judged(measured, m, learn(docs, rules), verdict).where(F.col(verdict)).select(*docs.columns)


def quality_rules(docs: DataFrame, rules: Rates = Rates()) -> DataFrame:
    """Per document: doc_id, the measures, base_failed and kept."""
    measured = materialise(docs.select("doc_id", "lang", "source", measures("text").alias("m")), "measures")
    limits = materialise(thresholds(materialise(sketches(measured, "m"), "sketches"), rules), "thresholds")
    out = judged(measured, "m", limits, "kept")
    return out.select("doc_id", *[F.col(f"m.{c}").alias(c) for c in MEASURES[:5]],
                      base_failed("m").alias("base_failed"), "kept", *[F.col(f"m.{c}").alias(c) for c in MEASURES[5:]])
