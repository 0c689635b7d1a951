"""Merkle manifest of a dataset, with a proof for every row.

Each row is a leaf, the SHA-256 of its doc_id, source, lang, n_chars and text;
within a lang the leaves stand by doc_id, and every two consecutive nodes (the
last run may have one) become the next level's node until one is left, the
lang's subroot.  The subroots, by lang, make the root the same way.

Built levels are stored as node rows linked to their parents, ``STRIDE``
levels at a time: 2**STRIDE consecutive nodes meet in one group, which folds
its levels up to one node, the parent, and gives every member the siblings on
its way there.  A recursive query then starts at each leaf with its own row's
siblings, joins the parent's row, appends that row's siblings and folds the
(tampered) hash over them, until the row above the subroots is passed.

Scale.  Positions come from a range split and prefix sums, so a lang that
holds all rows is spread over all tasks.  A group has 2**STRIDE nodes at most.
A node row is stored once for each block of ``2**BLOCK`` leaves below it (at
most N / 2**BLOCK rows a stride), and the climb joins on the block too: no key
has more than 2**BLOCK climbing rows, and the last joins, which all rows make
with a few nodes, are as spread as the first.  The recursion runs one step for
each stride and one for each stride above the subroots (five at 10**10 rows).
Everything is DataFrame and SQL functions; hashes travel as 32 bytes.

Spark's row limit for recursion is lifted while the climb is written, and put
back then.

Cases: nulls in any column are hashed as ``-``; a null lang is a lang of its
own, the first; rows with a null doc_id come last in their lang and are never
tampered with; rows that share a doc_id stand by their leaf (equal ones are
interchangeable); a lang of one row has its leaf as subroot, a table of one
lang its subroot as root, with no siblings (the proof is the digest of the
empty string); empty and very long texts are hashed whole; other columns are
not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, with_global_position

STRIDE, BLOCK = 8, 9
TAMPERED = 7
RECURSION = {"spark.sql.cteRecursionRowLimit": "-1"}


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts in a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def text_of(hash_: Column) -> Column:
    """A 32-byte digest as lower-case hex."""
    return F.lower(F.hex(hash_))


def leaf_hash(n_chars: Column) -> Column:
    """The leaf of a row, with ``n_chars`` in place of its own."""
    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))
    return digest(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(n_chars), field(F.col("text")))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered) of every row; tree orders the langs (null
    first), tampered: the leaf with 1 added to n_chars, for every seventh row."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    docs = docs.select(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    return docs.select(F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("lang"))).alias("tree"),
                       F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(F.col("n_chars")).alias("leaf"),
                       F.when(chosen, leaf_hash(F.col("n_chars").cast("decimal(20,0)") + 1)).alias("tampered"))


def _above(level: Column) -> Column:
    """The next level of an array of digests."""
    def node(i: Column) -> Column:
        two = F.transform(F.slice(level, 2 * i + 1, F.lit(2)), text_of)
        return digest(F.array_join(two, ""))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), node)


def _grouped(nodes: DataFrame, *carried: str) -> DataFrame:
    """Nodes (tree, n, idx, hash, ...carried), n being the level's length, in
    groups: the member's columns, ``parent`` and ``siblings``, one
    (hash, left) for each level of the group in which it has any, and the
    group's ``top`` digest."""
    members = (nodes.groupBy("tree", "n", F.shiftrightunsigned("idx", STRIDE).alias("parent"))
               .agg(F.sort_array(F.collect_list(F.struct("idx", "hash", *carried))).alias("m")))
    # The last group of a tree folds until one node of the whole tree is left.
    levels = F.least(F.lit(STRIDE), F.length(F.bin(F.col("n") - 1)) * (F.col("n") > 1).cast("int"))
    rows = members.withColumns({"_levels": levels, "_0": F.col("m.hash")})
    for k in range(STRIDE):
        rows = rows.withColumn(f"_{k + 1}", F.when(F.col("_levels") > k, _above(F.col(f"_{k}"))).otherwise(F.col(f"_{k}")))
    place = (F.col("m1.idx") % (1 << STRIDE)).cast("int")

    def sibling(k: int) -> Column:
        at = F.shiftright(place, k)
        # try_element_at: null behind the end, where the node stands alone.
        return F.when(F.col("_levels") > k, F.try_element_at(f"_{k}", at.bitwiseXOR(F.lit(1)) + 1))

    rows = rows.select("tree", "n", "parent", "_levels", *[f"_{k}" for k in range(STRIDE + 1)], F.explode("m").alias("m1"))
    steps = F.array(*[F.when(F.col("_levels") > k, F.struct(sibling(k).alias("hash"), (F.shiftright(place, k) % 2 == 1).alias("left")))
                      for k in range(STRIDE)])
    return rows.select("tree", "n", "m1.*", "parent", F.filter(steps, lambda s: s.isNotNull()).alias("siblings"),
                       F.col(f"_{STRIDE}")[0].alias("top"))


def _strides(nodes: DataFrame, name: str, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """All strides of the trees whose level 0 is ``nodes``, each written, and
    (tree, hash) of their tops.  A tree that is done drops out of the next."""
    written, tops = [], None
    while True:
        at = materialise(_grouped(nodes, *(carried if not written else ())), f"{name}-{len(written)}")
        written.append(at)
        above = at.where(F.col("idx") % (1 << STRIDE) == 0).select("tree", "n", F.col("parent").alias("idx"), F.col("top").alias("hash"))
        done = above.where(F.col("n") <= 1 << STRIDE).select("tree", "hash")
        tops = done if tops is None else tops.union(done)
        nodes = (above.where(F.col("n") > 1 << STRIDE)
                 .select("tree", F.shiftrightunsigned(F.col("n") + (1 << STRIDE) - 1, STRIDE).alias("n"), "idx", "hash"))
        if not nodes.take(1):
            return written, tops


def _blocked(rows: DataFrame, span: Column, first: Column, n: Column) -> DataFrame:
    """One row for each block of leaves below: of the ``span`` leaves from
    ``first`` on, as far as the lang has leaves (n)."""
    last = F.least(first + span, n) - 1
    return rows.withColumn("block", F.explode(F.sequence(F.shiftright(first, BLOCK), F.shiftright(last, BLOCK))))


@contextmanager
def _unlimited(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in RECURSION}
    for k, v in RECURSION.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# SQL of one step: the digest folded over a row's siblings, and these as bytes.
FOLD = """aggregate({siblings}, {start}, (h, s) -> unhex(sha2(CAST(CASE WHEN s.hash IS NULL THEN lower(hex(h))
    WHEN s.left THEN lower(hex(s.hash)) || lower(hex(h)) ELSE lower(hex(h)) || lower(hex(s.hash)) END AS BINARY), 256)))"""
GATHER = "aggregate({siblings}, {start}, (p, s) -> concat(p, coalesce(s.hash, X'')))"


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    spark = docs.sparkSession
    # n: the lang's number of leaves; idx: the leaf's place among them.
    one = leaves(docs).withColumns({"one": F.lit(1), "hash": F.col("leaf")})
    placed = with_global_position(one, ["doc_id", "leaf"], {"idx": "one"}, "leaves", "tree")
    placed = placed.select("tree", F.col("idx_total").alias("n"), "idx", "hash", "doc_id", "tampered")
    levels, tops = _strides(placed, "nodes", "doc_id", "tampered")
    leaf_rows = levels[0].withColumn("size", F.col("n")).withColumn("block", F.shiftright("idx", BLOCK))
    tops = materialise(tops, "subroots")

    # Node rows: (tree, level, idx, block) -> siblings, and the parent (level + 1, parent);
    # the lang's last stride leads to the strides above its subroot (idx 0 there).
    sizes = levels[0].where("idx = 0").select("tree", F.col("n").alias("leaves"))
    rows = []
    for k, at in enumerate(levels[1:], 1):
        first = F.shiftleft("idx", STRIDE * k)
        rows.append(_blocked(at.join(sizes, "tree"), F.lit(1 << STRIDE * k), first, F.col("leaves")).select(
            "tree", F.lit(k).alias("level"), "idx", "block", "siblings", "parent", F.lit(False).alias("last"),
            F.when(F.col("n") <= 1 << STRIDE, F.col("top")).alias("subroot"), F.lit(None).cast("binary").alias("root")))
    langs = with_global_position(tops.withColumn("one", F.lit(1)), ["tree"], {"idx": "one"}, "langs")
    upper, root = _strides(langs.select(F.lit("").alias("tree"), F.col("idx_total").alias("n"), "idx", "hash", F.col("tree").alias("lang")),
                           "upper", "lang")
    strides = F.lit(1) + reduce(lambda a, k: a + (F.col("leaves") > 1 << STRIDE * k).cast("int"), range(1, len(levels)), F.lit(0))
    way = upper[0].select(F.col("lang").alias("tree"), F.col("idx").alias("at"), F.col("hash").alias("subroot")).join(sizes, "tree")
    way, end = materialise(way.withColumn("strides", strides), "ways"), root.select(F.col("hash").alias("root"))
    for k, up in enumerate(upper):
        up = up.select(F.col("idx").alias("up"), "siblings")
        here = way.withColumn("up", F.shiftright("at", STRIDE * k)).join(up, "up")
        last = k == len(upper) - 1
        rows.append(_blocked(here, F.col("leaves"), F.lit(0).cast("long"), F.col("leaves")).select(
            "tree", (F.col("strides") + k).alias("level"), F.lit(0).cast("long").alias("idx"), "block", "siblings", F.lit(0).cast("long").alias("parent"),
            F.lit(last).alias("last"), "subroot", (end.scalar() if last else F.lit(None).cast("binary")).alias("root")))
    nodes = materialise(reduce(DataFrame.unionByName, rows), "node-rows")

    climbed = spark.sql(f"""
        WITH RECURSIVE climb AS (
          SELECT tree, 1 AS level, parent AS idx, block, doc_id, hash AS leaf, {FOLD.format(siblings="siblings", start="coalesce(tampered, hash)")} AS folded,
                 {GATHER.format(siblings="siblings", start="X''")} AS proof, CASE WHEN size <= {1 << STRIDE} THEN top END AS subroot,
                 CAST(NULL AS BINARY) AS root, false AS done
          FROM {{leaf_rows}}
          UNION ALL
          SELECT c.tree, c.level + 1, n.parent, c.block, c.doc_id, c.leaf, {FOLD.format(siblings="n.siblings", start="c.folded")},
                 {GATHER.format(siblings="n.siblings", start="c.proof")}, coalesce(c.subroot, n.subroot), n.root, n.last
          FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.level = n.level AND c.idx = n.idx AND c.block = n.block
          WHERE NOT c.done)
        SELECT doc_id, leaf, subroot, root, proof, folded FROM climb WHERE done""", leaf_rows=leaf_rows, nodes=nodes)
    with _unlimited(spark):
        climbed = materialise(climbed, "climbed")
    return climbed.select("doc_id", *[text_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                          F.sha2(text_of(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
                          text_of(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
