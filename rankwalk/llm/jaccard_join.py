"""Documents linked by the Jaccard similarity of their word shingles.

A document's set holds its distinct 5-word shingles (A-Z lower-cased).  Two
documents link when 100 * intersection >= 80 * union; the result is every
document's component under these links.  Documents with equal sets are one
node from the start.

Adaptive multi-match prefixes.  All shingles have one global order, rare ones
first, by a merged count-min sketch over the whole corpus.  Linked documents
share at least ceil(4n/5) shingles of either, so the first n - ceil(4n/5) + k
of both hold k common ones, for any k.  Each document picks its own k, from 1
to ``most``, at the least estimated cost: the postings it meets in that prefix
plus the candidates to verify, of which there are at most postings / k.  Two
documents are candidates when their prefixes share min(k, k') shingles and
their sizes and the places of the common shingles allow a link: what two
ordered lists share is at most what they shared up to a common shingle and
the shorter rest behind it, and of what stands before it only shingles that
other prefixes hold can be shared.  At the first shingle that a pair shares
nothing before it counts at all, and one such meeting is enough to list it.

Links are found without listing all pairs of a group.  Two rounds compare each
node with one other node of a prefix shingle (first the one with the most
shared shingles, as an original among its copies; then one at random): linear
in the postings.  Then candidates are formed only between different components
of the links so far, first as pairs of components and only then of nodes, and
all of them are verified.  A link inside a component cannot change it, so no
component is missed and none is joined wrongly.  Shingles that stand in the
prefix of one component only drop out by then, so a group of thousands of
copies costs its size and not its square.

Nodes and shingles are known by 64-bit fingerprints; verification intersects
the fingerprint sets.

Cases: null and empty texts have empty sets and link with nothing (their
component is their own doc_id); a text of fewer than five words is one
shingle; a null doc_id takes part, and is nobody's component_id unless all of
a component are null; repeated rows are equal sets; an empty table gives an
empty result; other columns pass through ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, fresh, materialise, row_key
from .components import components
from .countmin import Filter, Shape, loaded, magnitude, magnitudes_at, repeated_bits, seen_bits, sketch
from .textkernel import mix, pieces, shingle_sets

SHINGLE = 5
FREQUENCY = Shape(depth=1, log2=26)
PREFIX = Shape(depth=2, log2=27)
INVOLVED = Shape(depth=2, log2=24)
MOST = 8
VERIFY_COST, POSTING_COST = 20.0, 1.0
ROUNDS = 2
PAIRS_BROADCAST = 250_000
BEFORE = 8


def needed(n: int) -> int:
    """Shingles that a document of n shares at least with a linked one."""
    return -(-4 * n // 5)


def set_digest(hashes: np.ndarray) -> int:
    """64-bit fingerprint of a set of shingles."""
    total = np.sum(mix(hashes ^ np.uint64(0x51ED270B0F2C6E93)), dtype=np.uint64) + np.uint64(len(hashes))
    return int(mix(np.array([total], dtype=np.uint64))[0].view(np.int64))


def prefix_of(hashes: np.ndarray, digits: np.ndarray, most: int) -> tuple[int, np.ndarray]:
    """(k, prefix): hashes sorted by value, digits their frequency class."""
    order = np.argsort(digits, kind="stable")
    n, t = len(hashes), needed(len(hashes))
    met = np.cumsum(np.ldexp(1.0, digits[order].astype(np.int64) - 1) - 0.5)
    k = np.arange(1, min(most, t) + 1)
    length = n - t + k
    cost = met[length - 1] * (1 + VERIFY_COST / k) + POSTING_COST * length
    best = int(np.argmin(cost))
    return int(k[best]), hashes[order[: length[best]]]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def prefixes(docs: DataFrame, most: int = MOST, frequency: Shape = FREQUENCY) -> DataFrame:
    """(row_key, doc_id, n, node, k, prefix) of every row; node is null for an empty set."""
    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for piece in pieces(batch.column(0)):
            yield from shingle_sets(piece, SHINGLE)

    counts = docs.sparkSession.sparkContext.broadcast(sketch(docs.select("text"), hashes, frequency, magnitude))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = loaded(frequency, counts.value, 4)[0]
        for batch in batches:
            for piece in pieces(batch.column("text")):
                n, node, level, kept = [], [], [], []
                for s in shingle_sets(piece, SHINGLE):
                    n.append(len(s))
                    node.append(set_digest(s) if len(s) else None)
                    k, prefix = prefix_of(s, magnitudes_at(table, frequency.cells(s, 0)), most) if len(s) else (0, s)
                    level.append(k)
                    kept.append(prefix.view(np.int64))
                rows = batch.slice(piece.first, piece.n)
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, kept)]).astype(np.int32), np.concatenate(kept))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row_key"), rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                     pa.array(level, pa.int32()), lists], ["row_key", "doc_id", "n", "node", "k", "prefix"])

    return materialise(docs.select(row_key().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        choose, "row_key string, doc_id long, n long, node long, k int, prefix array<long>"), "prefixes")


def _doc_ids(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)


def _one_of_node(spark: SparkSession, nodes: DataFrame, involved: Shape):
    """For mapInArrow: the rows whose (node, doc_id) is likely in ``nodes``, so
    of documents with equal sets mostly one."""
    key = lambda node, ids: node.to_numpy().view(np.uint64) ^ mix(_doc_ids(ids))
    held = Filter(spark, involved, sketch(nodes.select("node", "doc_id"), lambda b: [key(b.column(0), b.column(1))], involved, seen_bits))

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = held.open()
        for batch in batches:
            hit = passes(key(batch.column("node"), batch.column("doc_id")))
            yield batch.select(["node", "n", "k", "prefix"]).filter(pa.array(hit))

    return only


def _postings(found: DataFrame, nodes: DataFrame, prefix: Shape, involved: Shape) -> DataFrame:
    """(token, node, n, k, rest, upto, weight) of prefix shingles that stand in two nodes'
    prefixes; rest: the node's shingles behind this one in the global order,
    upto: its shared prefix shingles up to this one; weight: all of them.  The
    filters only thin out: a document passes for its node and a shingle for
    repeated too often at most, and both are settled exactly behind them.
    ``found`` is deleted once its postings stand."""
    originals = found.where("node is not null").select("node", "doc_id", "n", "k", "prefix").mapInArrow(
        _one_of_node(found.sparkSession, nodes, involved), "node long, n long, k int, prefix array<long>")
    lists = lambda b: [b.column(0).flatten().to_numpy().view(np.uint64)]
    likely = Filter(found.sparkSession, prefix, sketch(originals.select("prefix"), lists, prefix, repeated_bits))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = likely.open()
        for batch in batches:
            tokens = batch.column("prefix").flatten().to_numpy()
            lengths = batch.column("prefix").value_lengths().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), lengths)
            pos = (np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            hit = passes(tokens.view(np.uint64))
            rest = batch.select(["node", "n", "k"]).take(pa.array(row[hit]))
            yield pa.RecordBatch.from_arrays([pa.array(tokens[hit]), *rest.columns, pa.array(pos[hit])], ["token", "node", "n", "k", "pos"])

    rows = originals.mapInArrow(explode, "token long, node long, n long, k int, pos int")
    every = rows = materialise(rows.distinct(), "postings")
    discard(found)
    shared = materialise(rows.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token"), "shared-tokens")
    order = Window.partitionBy("node").orderBy("pos")
    rows = rows.join(shared, "token", "left_semi").withColumn("upto", F.row_number().over(order))
    rows = rows.withColumn("weight", F.count(F.lit(1)).over(Window.partitionBy("node")))
    rows = materialise(rows.select("token", "node", "n", "k", (F.col("n") - F.col("pos") - 1).alias("rest"), "upto", "weight"), "shared-postings")
    discard(every, shared)
    return rows


def _sets(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, involved: Shape) -> DataFrame:
    """(node, shingles) of the pairs' nodes and a few others: the texts are read
    again, those with the doc_id of such a node.  Nothing is kept or shuffled;
    rows that share doc_id and text give equal rows."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialise(nodes.join(ends, "node", "left_semi").select("doc_id"), "involved")
    held = Filter(docs.sparkSession, involved, sketch(wanted, lambda b: [mix(_doc_ids(b.column(0)))], involved, seen_bits))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = held.open()
        for batch in batches:
            hit = passes(mix(_doc_ids(batch.column("doc_id"))))
            for piece in pieces(batch.column("text").filter(pa.array(hit))):
                kept = [s for s in shingle_sets(piece, SHINGLE) if len(s)]
                if kept:
                    lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, kept)]).astype(np.int32), np.concatenate(kept).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([set_digest(s) for s in kept], pa.int64()), lists], ["node", "shingles"])

    return _texts(docs).mapInArrow(sets, "node long, shingles array<long>")


def _together(pairs: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """(a, b, x, y): for each pair the array ``column`` of both its nodes.  Only
    the arrays of the pairs' own nodes are moved, once a pair; ``nodes`` is read
    once.  The pairs are broadcast while a count shows them few (50 bytes each)."""
    end = lambda key, first: F.struct(F.col(key).alias("node"), "a", "b", F.lit(first).alias("is_a"))
    ends = pairs.select(F.inline(F.array(end("a", True), end("b", False))))
    if pairs.limit(PAIRS_BROADCAST + 1).count() <= PAIRS_BROADCAST:
        ends = F.broadcast(ends)
    side = nodes.join(ends, "node").select("a", "b", F.when(F.col("is_a"), F.col(column)).alias("x"), F.when(~F.col("is_a"), F.col(column)).alias("y"))
    return side.groupBy("a", "b").agg(F.first("x", ignorenulls=True).alias("x"), F.first("y", ignorenulls=True).alias("y"))


def _verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, involved: Shape) -> DataFrame:
    """The pairs (a, b) that link."""
    sets = _sets(docs, pairs, nodes, involved)
    both = F.size(F.array_intersect("x", "y"))
    rows = _together(pairs, sets, "shingles").select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sizes"))
    return rows.where(100 * F.col("both") >= 80 * (F.col("sizes") - F.col("both"))).select("a", "b")


def _possible(upto: Column, n: str, m: str, rest_n: str, rest_m: str) -> Column:
    """Can sets of n and m shingles link that share at most ``upto`` up to a
    common one and have rest_n and rest_m behind it?  (Linked: 9 * intersection
    >= 4 * (n + m).)"""
    rest = F.least(rest_n, rest_m)
    return (9 * (upto + rest) >= 4 * (F.col(n) + F.col(m))) & (5 * F.col(n) >= 4 * F.col(m)) & (5 * F.col(m) >= 4 * F.col(n))


def _star_pairs(postings: DataFrame, turn: int) -> DataFrame:
    """One partner (a, b) at most for each node: of the nodes chosen by its
    shingles (one each), the one that most of them chose, if at least k did:
    fewer seldom make a link, and what is left out here is met later.  Shingles
    within one component choose none."""
    ends, several = [], F.lit(True)     # at first every node is a component and every shingle has several
    if turn:
        postings = postings.withColumn("weight", F.xxhash64("node", F.lit(turn)))
        ends, several = [F.min("root").alias("lo"), F.max("root").alias("hi")], F.col("lo") != F.col("hi")
    chosen = materialise(postings.groupBy("token").agg(
        F.max_by("node", "weight").alias("b"), F.max_by("n", "weight").alias("m"), F.max_by("rest", "weight").alias("b_rest"), F.max_by("upto", "weight").alias("b_upto"),
        F.max_by("root", "weight").alias("b_root"), *ends).where(several).drop("lo", "hi"), "chosen")
    met = (postings.join(chosen, "token").where((F.col("root") != F.col("b_root")) & _possible(F.least("upto", "b_upto"), "n", "m", "rest", "b_rest"))
           .groupBy(F.col("node").alias("a"), "b", "k").agg(F.count(F.lit(1)).alias("c")).where("c >= k"))
    pairs = materialise(met.groupBy("a").agg(F.max_by("b", "c").alias("b")), "pairs")
    discard(chosen)
    return pairs


def _open_pairs(postings: DataFrame) -> DataFrame:
    """All candidates (a, b) between different components; ``postings`` and
    every table written here are deleted once the next one stands."""
    # What a node can share caps its partner's size; without one as small among
    # the shingle's nodes the posting is of no use.
    largest = F.floor((9 * (F.col("upto") + F.col("rest")) - 4 * F.col("n")) / 4)
    split = postings.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least_n"), F.min("k").alias("least_k"))
    split = materialise(split.where("lo <> hi").select("token", "least_n", "least_k"), "split-tokens")
    # Candidates share min(k, k') shingles, so behind the first of them both
    # still have min(k, k') - 1, and all that they share but that one lies
    # behind it: further back no pair begins.
    rows = postings.join(split, "token").where(largest >= F.col("least_n")).withColumn("after", F.col("weight") - F.col("upto"))
    begins = (F.col("after") + 1 >= F.least("k", "least_k")) & (45 * (F.col("rest") + 1) >= 20 * F.col("n") + 4 * F.greatest(5 * F.col("least_n"), 4 * F.col("n")))
    rows = rows.withColumn("begins", begins).drop("least_n", "least_k", "weight")
    rows = materialise(rows, "open-postings")
    discard(postings, split)
    held = materialise(rows.where("begins").groupBy("token", "root").agg(
        F.count(F.lit(1)).alias("c"), F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("rest").alias("rest"),
        F.max("after").alias("after"), F.min("k").alias("k")), "token-roots")
    other = held.select("token", *[F.col(c).alias(f"{c}_b") for c in held.columns if c != "token"])
    # Each pair of components once, the one with fewer members at the shingle
    # first: its members are listed, the other's only met with them.
    begin = lambda x, y: F.least(f"after{x}", f"after{y}") + 1 >= F.least(f"k{x}", f"k{y}")
    two = held.join(other, "token").where(
        begin("", "_b") & (F.struct("c", "root") < F.struct("c_b", "root_b")) & (9 * (1 + F.least("rest", "rest_b")) >= 4 * (F.col("n0") + F.col("n0_b")))
        & (5 * F.col("n1") >= 4 * F.col("n0_b")) & (5 * F.col("n1_b") >= 4 * F.col("n0")))
    two = materialise(two.select("token", "root", "root_b", "n0_b", "n1_b", F.col("rest_b").alias("most_rest")), "component-pairs")
    discard(held)
    # Shingles that stand for no pair of components are of no more use to their
    # nodes: linked nodes pass the bounds at each shingle they share.
    useful = two.select("token", "root").distinct().union(two.select("token", F.col("root_b").alias("root")).distinct())
    useful = materialise(useful, "useful-roots")
    # The useful shingles of a node just before this one, as far back as BEFORE tells.
    earlier = Window.partitionBy("node").orderBy("upto").rowsBetween(-BEFORE, -1)
    told = rows.where("begins").join(useful, ["token", "root"], "left_semi").withColumn("before", F.collect_list("token").over(earlier))
    told = materialise(told, "told-postings")
    discard(useful)
    side = lambda x, root: told.select("token", F.col("root").alias(root), *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "k", "rest", "after", "before")])
    # A member of the first component that can meet some member of the second.
    some = ((9 * (1 + F.least("rest_a", "most_rest")) >= 4 * (F.col("n_a") + F.col("n0_b")))
            & (5 * F.col("n_a") >= 4 * F.col("n0_b")) & (5 * F.col("n1_b") >= 4 * F.col("n_a")))
    # A pair is taken at the first open shingle its nodes share; one that lies
    # further back than BEFORE only repeats the pair.  Linked nodes pass the
    # bounds at each shingle they share, so at the first one too.
    first = begin("_a", "_b") & ~F.arrays_overlap("before_a", "before_b")
    met = two.join(side("a", "root"), ["token", "root"]).where(some).join(side("b", "root_b"), ["token", "root_b"])
    met = met.where(_possible(F.lit(1), "n_a", "n_b", "rest_a", "rest_b") & first)
    pairs = materialise(met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "met-pairs")
    discard(two, told)
    # Shared prefix shingles of each pair: at least min(k, k'), and enough to
    # link with the longer of what lies behind the prefixes.
    lists = materialise(rows.groupBy("node").agg(F.collect_list("token").alias("tokens"), F.first("n").alias("n"), F.first("k").alias("k")), "node-tokens")
    discard(rows)
    short = lists
    lists = lists.select("node", F.concat(F.array(F.col("n"), F.col("k").cast("bigint")), "tokens").alias("tokens"))
    tail = lambda c: F.slice(c, 3, F.size(c))
    behind = lambda c: F.ceil(4 * F.col(c)[0] / 5) - F.col(c)[1]
    counted = _together(pairs, lists, "tokens").withColumn("c", F.size(F.array_intersect(tail("x"), tail("y"))))
    enough = 9 * (F.col("c") + F.greatest(behind("x"), behind("y"))) >= 4 * (F.col("x")[0] + F.col("y")[0])
    counted = materialise(counted.where((F.col("c") >= F.least(F.col("x")[1], F.col("y")[1])) & enough).select("a", "b"), "pairs")
    discard(pairs, short)
    return counted


def linked_components(docs: DataFrame, most: int = MOST, frequency: Shape = FREQUENCY, prefix: Shape = PREFIX,
                      involved: Shape = INVOLVED) -> DataFrame:
    """(row_key, doc_id, n, root, component_id) of every row; root: the
    component's node, null for an empty set."""
    found = prefixes(docs, most, frequency)
    rows = materialise(found.select("row_key", "doc_id", "n", "node"), "rows")
    nodes = materialise(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")
    postings = _postings(found, nodes, prefix, involved)
    links, labels = None, None
    for turn in range(ROUNDS + 1):
        at = postings.withColumn("root", F.col("node")) if labels is None else (
            postings.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")))
        at = materialise(at, "labelled-postings") if labels is not None else at
        if turn == ROUNDS:
            discard(postings)
        pairs = _star_pairs(at, turn) if turn < ROUNDS else _open_pairs(at)
        if 0 < turn < ROUNDS:
            discard(at)
        more = materialise(_verified(docs, pairs, nodes, involved), "verified")
        links = more if links is None else links.union(more)
        labels = components(links)
    ids = labels.join(nodes, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = materialise(labels.join(materialise(ids, "component-ids"), "root").select("node", "root", "component_id"), "node-components")
    every = materialise(nodes.join(ids, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "doc_id").alias("component_id")), "all-components")
    return (rows.join(every, "node", "left")
            .select("row_key", "doc_id", "n", "root", F.coalesce("component_id", F.when(F.col("root").isNull(), F.col("doc_id"))).alias("component_id")))


def jaccard_components(docs: DataFrame, **shapes) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return linked_components(docs, **shapes).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, **shapes) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id
    (nulls last; of rows that share it the smallest row key; of equal rows
    one).  Rows with an empty set all stay."""
    rows = linked_components(docs, **shapes).where("root is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    keep = materialise(rows.groupBy("root").agg(first.alias("first")).select(F.col("first.row_key").alias("row_key")), "kept-rows")
    key = fresh(docs, "row_key_")
    words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = (docs.where(words).withColumn(key, row_key()).join(keep.withColumnRenamed("row_key", key), key, "left_semi")
            .dropDuplicates([key]).select(*docs.columns))
    return kept.unionByName(docs.where(~words))
