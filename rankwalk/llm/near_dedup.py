"""Near-duplicate groups by bottom-k sketches from one hash function.

A document's set holds its distinct 5-word shingles (A-Z lower-cased), each as
a 64-bit hash.  Two documents link when 100 * intersection >= 85 * union; the
result is every document's component under these links, of which the row with
the smallest doc_id is kept.  Documents with equal sets are one node.

Sketches.  A node's sketch is the ``K`` smallest hashes of its set (the whole
set if it has fewer).  Of two nodes, the K smallest of both sketches together
are the sketch of their union, an even sample of it: for a linked pair the
number of shared values among them is at least binomial(K, 0.85).  ``LEAST`` is
the count that such a sample stays below with a chance of at most ``MISS`` a
pair; sketches that are whole sets share exactly what the sets share.

Candidates.  A node that has fewer values in common with all others together
than a link needs drops out first, by a merged count-min sketch of the values.
Of the few nodes that are left the full sets are written, and the rest uses
their ``WIDE`` smallest hashes.  Inverted lists hold the values that two wide
sketches retain.  Nodes that must share r values share ``m`` of them among the
S - r + m rarest of their S listed ones, so each node enters only these lists,
and those with S < r none; r is larger for the smaller of two nodes.  A list's
common places and the sizes bound what two nodes can share at all.  Pairs are
estimated by the union's sketch, and those that pass are verified by the exact
Jaccard similarity of their full sets.

No group is expanded into all its pairs.  Two rounds compare a node with one
other node of its lists (first the one with the most listed values, as an
original among its copies; then one at random) that it meets in m lists, linear
in the lists; the last
round takes pairs only between different components of the links found so far,
and all of them.  A link inside a component cannot change it.  While lists hold
many more pairs between components than members and a round still finds links
for a good part of its nodes, further such rounds (``MOST_ROUNDS`` in all) come
before the last one.  In that one the members of a list outside its largest
component meet the others at the first value they share only, and only where
the parity bits of their full sets allow a link: bits that differ are values
that differ, so this bound is exact and leaves few pairs that do not link.

Scale: value counts, lists and pairs are shuffled on even keys, hot lists meet
written tables only (so that Spark can split them), and only full sets of nodes
that stand in some list are written.  The count-min sketch and the filters have
fixed sizes; beyond them more nodes reach the exact counts (raise ``log2``).

Cases: null and empty texts have empty sets and link with nothing (their
component is their own doc_id, and they are kept); a text of fewer than five
words is one shingle; a row with a null doc_id takes part, and its component_id
is null only if all of a component are null (it is kept then); repeated rows
are equal sets; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise
from .components import components
from .countmin import Filter, Shape, repeated_bits, seen_bits, sketch
from .textkernel import mix, pieces, shingle_sets

SHINGLE, SHARE = 5, 85
K, WIDE, MEET, MISS = 128, 512, 8, 1e-12
ROUNDS, MOST_ROUNDS, CROSSING, VAIN = 2, 8, 8, 10
BEFORE = 8
PARITY_LOG2 = 10
WORDS = [f"odd{i}" for i in range(1 << PARITY_LOG2 - 6)]
RETAINED = Shape(depth=2, log2=27)
INVOLVED = Shape(depth=2, log2=24)


def least_shared(k: int, miss: float) -> int:
    """The largest count that binomial(k, SHARE %) falls short of with a chance of at most ``miss``."""
    p, total = SHARE / 100, 0.0
    for count in range(k + 1):
        total += comb(k, count) * p**count * (1 - p) ** (k - count)
        if total > miss:
            return count
    return k


LEAST, LEAST_WIDE = least_shared(K, MISS), least_shared(WIDE, MISS)


def set_digest(hashes: np.ndarray) -> bytes:
    """128-bit identity of a set given as sorted distinct hashes."""
    return hashlib.md5(hashes.tobytes()).digest()


def parity_bits(hashes: np.ndarray) -> np.ndarray:
    """2**PARITY_LOG2 bits as words: has a cell an odd number of the hashes?
    Two sets differ in at least as many values as their bits differ."""
    cells = (mix(hashes ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PARITY_LOG2)).astype(np.int64)
    odd = np.bincount(cells, minlength=1 << PARITY_LOG2).astype(np.uint8) & np.uint8(1)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    return pa.LargeListArray.from_arrays(np.cumsum([0, *map(len, arrays)]), np.concatenate([np.zeros(0, np.int64), *arrays])).cast(pa.list_(pa.int64()))


def _signed(hashes: np.ndarray) -> np.ndarray:
    """Moved so that the order as signed numbers is that of the hashes."""
    return (hashes ^ np.uint64(1 << 63)).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, nr, n, digest, sketch) of every row, written; nr is unique."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                sets = list(shingle_sets(piece, SHINGLE))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(piece.first, piece.n), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_digest(s) for s in sets], pa.binary()), _lists([_signed(s[:K]) for s in sets])],
                    ["doc_id", "n", "digest", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        describe, "doc_id long, n long, digest binary, sketch array<long>")
    return materialise(rows.withColumn("nr", F.monotonically_increasing_id()), "sketches")


def as_larger(n: Column) -> Column:
    """Wide sketch values that a node of n shingles shares at least with a
    linked node that is not larger: of whole sets SHARE % of it."""
    return F.when(n <= WIDE, F.ceil(n * SHARE / 100)).otherwise(F.lit(LEAST_WIDE)).cast("int")


def as_smaller(n: Column) -> Column:
    """The same with a linked node that is not smaller (intersection >= 85/185
    of both sizes together, if that one's sketch is a whole set too)."""
    return F.when(n <= WIDE * SHARE // 100, F.ceil(2 * SHARE * n / (100 + SHARE))).otherwise(F.lit(LEAST_WIDE)).cast("int")


def survivors(rows: DataFrame, ids: DataFrame, retained: Shape, involved: Shape) -> DataFrame:
    """(node, n, doc_id, digest) of the nodes that may hold r values which other nodes
    retain too, by a merged count-min sketch of the values; written.  Both
    filters only thin out: a row passes as the node's own or a value as
    repeated too often at most, and both are settled exactly behind them."""
    spark, least = rows.sparkSession, LEAST
    own = lambda column: mix(column.to_numpy().view(np.uint64))
    held = Filter(spark, involved, sketch(ids.select("node"), lambda b: [own(b.column(0))], involved, seen_bits))

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = held.open()
        for batch in batches:
            yield batch.filter(pa.array(passes(own(batch.column("node")))))

    values = lambda column: column.flatten().to_numpy().view(np.uint64)
    first = rows.where("n > 0").select(F.col("nr").alias("node"), "n", "sketch").mapInArrow(owners, "node long, n long, sketch array<long>")
    likely = Filter(spark, retained, sketch(first.select("sketch"), lambda b: [values(b.column(0))], retained, repeated_bits))

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes, whole = likely.open(), K * SHARE // 100
        for batch in batches:
            n = batch.column("n").to_numpy()
            row = np.repeat(np.arange(len(n)), batch.column("sketch").value_lengths().to_numpy())
            found = np.bincount(row, weights=passes(values(batch.column("sketch"))), minlength=len(n))
            yield batch.filter(pa.array(found >= np.where(n <= whole, -(-n * SHARE // 100), least)))

    kept = first.mapInArrow(enough, "node long, n long, sketch array<long>").select("node", "n")
    return materialise(kept.join(ids, "node"), "survivors")


def listed(sets: DataFrame) -> DataFrame:
    """The inverted lists of the sets' wide sketches: (value, node, n, r, rs, m,
    place, size); place: 1 for the rarest of the node's ``size`` values that
    other nodes retain too; r, rs: how many a link needs as the larger or
    smaller of two."""
    values = sets.select("node", "n", F.explode(F.slice("shingles", 1, WIDE)).alias("value"))
    shared = materialise(values.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "shared-values")
    rows = values.join(shared, "value").withColumns({"r": as_larger(F.col("n")), "rs": as_smaller(F.col("n"))})
    mine = Window.partitionBy("node")
    rows = rows.withColumns({"place": F.row_number().over(mine.orderBy("held", "value")), "size": F.count(F.lit(1)).over(mine).cast("int"),
                             "m": F.least(F.lit(MEET), "r", "rs")})
    found = materialise(rows.where("place <= size - least(r, rs) + m and size >= least(r, rs)").drop("held"), "lists")
    discard(shared)
    return found


def _possible(a: str, b: str, upto: Column | None = None) -> Column:
    """Can the nodes of two entries (columns with suffix a and b) of a list link
    that share at most ``upto`` of their values up to this one?"""
    c = lambda name, side: F.col(name + side)
    upto = F.least(c("place", a), c("place", b)) if upto is None else upto
    most = upto + F.least(c("size", a) - c("place", a), c("size", b) - c("place", b))
    whole = F.greatest(c("n", a), c("n", b)) <= WIDE
    return ((100 * c("n", a) >= SHARE * c("n", b)) & (100 * c("n", b) >= SHARE * c("n", a)) & (c("root", a) != c("root", b))
            & (most >= F.when(whole, F.ceil(SHARE * (c("n", a) + c("n", b)) / (100 + SHARE))).otherwise(LEAST_WIDE)))


def _met(entries: DataFrame) -> DataFrame:
    """(a, b, met) of entries that meet in enough lists."""
    return (entries.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.min("enough").alias("enough"))
            .where("met >= enough").select("a", "b", "met"))


def _star_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """One partner at most for each node: of the nodes chosen by its lists (one
    each), the one that most of them chose."""
    weight = F.xxhash64("node", F.lit(turn))
    if not turn:
        weight = F.shiftleft(F.col("size").cast("long"), 48) + F.shiftrightunsigned(weight, 16)
    chosen = lists.withColumn("w", weight).groupBy("value").agg(
        *[F.max_by(c, "w").alias(f"{c}_b") for c in ("node", "n", "m", "place", "size", "root")])
    entries = lists.join(materialise(chosen, "chosen"), "value").where(_possible("", "_b"))
    met = _met(entries.select(F.col("node").alias("a"), F.col("node_b").alias("b"), F.least("m", "m_b").alias("enough")))
    return met.groupBy("a").agg(F.max_by("b", "met").alias("b"))


def _parity_allows() -> Column:
    """Do the bits of the nodes a and b differ in no more than the shingles of linked sets?"""
    differ = sum((F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in WORDS[1:]),
                 F.bit_count(F.col(f"{WORDS[0]}_a").bitwiseXOR(F.col(f"{WORDS[0]}_b"))))
    both = F.col("n_a") + F.col("n_b")
    return differ <= both - 2 * F.ceil(SHARE * both / (100 + SHARE))


def _list_roots(lists: DataFrame) -> DataFrame:
    """(value, root, c): members of each component in each list at whose place
    the first value that linked nodes share can stand."""
    return materialise(_beginnings(lists).groupBy("value", "root").agg(F.count(F.lit(1)).alias("c")), "list-roots")


def _beginnings(lists: DataFrame) -> DataFrame:
    return lists.where("size >= least(r, rs) and place <= size - least(r, rs) + 1")


def _crowded(held: DataFrame) -> bool:
    """Do the lists hold more than ``CROSSING`` pairs between components for each member?"""
    lists = held.groupBy("value").agg(F.sum("c").cast("double").alias("c"), F.sum(F.col("c") * F.col("c")).cast("double").alias("inside"))
    crossing, members = lists.agg(F.sum((F.col("c") * F.col("c") - F.col("inside")) / 2), F.sum("c")).first()
    return (crossing or 0) > CROSSING * (members or 0)


def _open_pairs(lists: DataFrame, held: DataFrame, sets: DataFrame) -> DataFrame:
    """All candidates between different components: of each list the members
    outside its largest component meet all others of the list."""
    split = held.groupBy("value").agg(F.max_by("root", "c").alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1").drop("roots")
    split = materialise(split, "open-values")
    rows = _beginnings(lists).join(split, "value").select("value", "node", "n", "place", "size", "root", "main")
    earlier = Window.partitionBy("node").orderBy("place").rowsBetween(-BEFORE, -1)
    rows = (rows.withColumn("before", F.collect_list("value").over(earlier))
            .join(sets.select("node", *[F.col("parity")[i].alias(w) for i, w in enumerate(WORDS)]), "node"))
    rows = materialise(rows, "open-lists")
    side = lambda x: rows.select("value", *[F.col(c).alias(c + x) for c in rows.columns if c != "value"])
    once = (F.col("root_b") == F.col("main_b")) | (F.col("node_a") < F.col("node_b"))
    # Linked nodes share nothing before the first value that they share; lists
    # further on, as far back as BEFORE tells, only repeat the pair.
    first = _possible("_a", "_b", F.lit(1)) & _parity_allows() & ~F.arrays_overlap("before_a", "before_b")
    met = side("_a").where("root_a <> main_a").join(side("_b"), "value").where(once & first)
    pairs = materialise(met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct(), "pairs")
    discard(split, rows)
    return pairs


def _beside(pairs: DataFrame, arrays: DataFrame, column: Column) -> DataFrame:
    """(a, b, x, y): for each pair the array of both its nodes, each moved once."""
    ends = pairs.select("a", "b", F.posexplode(F.array("a", "b")).alias("end", "node"))
    held = arrays.select("node", column.alias("array")).join(ends, "node")
    at = lambda end, name: F.first(F.when(F.col("end") == end, F.col("array")), ignorenulls=True).alias(name)
    return held.groupBy("a", "b").agg(at(0, "x"), at(1, "y"))


def estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose union's wide sketch allows a link."""
    rows = _beside(pairs, sets, F.slice("shingles", 1, WIDE)).withColumn("union", F.slice(F.array_sort(F.array_union("x", "y")), 1, WIDE))
    shared = F.size(F.array_intersect("union", F.array_intersect("x", "y")))
    return rows.where(F.when(F.size("union") < WIDE, 100 * shared >= SHARE * F.size("union")).otherwise(shared >= LEAST_WIDE)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link by their full sets."""
    both = F.size(F.array_intersect("x", "y"))
    rows = _beside(pairs, sets, F.col("shingles")).select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sizes"))
    return rows.where(100 * F.col("both") >= SHARE * (F.col("sizes") - F.col("both"))).select("a", "b")


def full_sets(docs: DataFrame, nodes: DataFrame, involved: Shape) -> DataFrame:
    """(node, n, shingles) of the nodes (node, n, doc_id, digest), the shingles in order: the texts with
    their doc_ids are read again.  The filter only thins out; the join decides."""
    ids = lambda column: mix(column.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64))
    held = Filter(docs.sparkSession, involved, sketch(nodes.select("doc_id"), lambda b: [ids(b.column(0))], involved, seen_bits))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = held.open()
        for batch in batches:
            for piece in pieces(batch.column("text").filter(pa.array(passes(ids(batch.column("doc_id")))))):
                sets = list(shingle_sets(piece, SHINGLE))
                yield pa.RecordBatch.from_arrays([pa.array([set_digest(s) for s in sets], pa.binary()), _lists([_signed(s) for s in sets]),
                                                  _lists([parity_bits(s) for s in sets])], ["digest", "shingles", "parity"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, "digest binary, shingles array<long>, parity array<long>")
    return materialise(rows.join(nodes.select("digest", "node", "n"), "digest").select("node", "n", "shingles", "parity").dropDuplicates(["node"]), "sets")


def near_duplicates(docs: DataFrame, retained: Shape = RETAINED, involved: Shape = INVOLVED) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    described = sketches(docs)
    ids = materialise(described.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min("nr").alias("node")), "nodes")
    nodes = survivors(described, ids, retained, involved)
    rows = materialise(described.select("doc_id", "n", "digest"), "rows")
    discard(described)
    sets = full_sets(docs, nodes, involved)
    lists = listed(sets)
    links, labels, vain = None, None, False
    for turn in range(MOST_ROUNDS + 1):
        at = lists.withColumn("root", F.col("node"))
        if labels is not None:
            at = materialise(lists.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")), "labelled-lists")
        held = _list_roots(at) if turn >= ROUNDS else None
        last = held is not None and (vain or turn == MOST_ROUNDS or not _crowded(held))
        met = _open_pairs(at, held, sets) if last else materialise(_star_pairs(at, turn), "pairs")
        pairs = materialise(estimated(met, sets), "candidates")
        more = materialise(verified(pairs, sets), "links-found")
        vain = VAIN * more.count() < met.count()
        discard(met, pairs, *([] if labels is None else [at]), *([] if held is None else [held]))
        links = more if links is None else links.union(more)
        labels = components(links)
        if last:
            break
    discard(sets, lists)
    of_root = labels.join(ids, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    grouped = materialise(labels.join(materialise(of_root, "roots"), "root").select("node", "component_id", F.lit(True).alias("linked")), "grouped-nodes")
    # Of a component whose ids are all null the id is null, not its member's.
    every = materialise(ids.join(grouped, "node", "left").select(
        "digest", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), "components")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest")).join(every, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
