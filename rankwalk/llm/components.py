"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b: long, not null).

    Each round hooks every node to its smallest neighbour if that is smaller,
    flattens the trees by pointer jumping, and carries the links between
    different trees over to their roots; a tree takes in every node that has a
    link, so the number of nodes at least halves.  All tables are written, so
    every join is one of two plain shuffles (a hot root's partition is split)
    and nothing is gathered but a count.  Without links the result is empty.
    """
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    links = materialise(links.where("a <> b").select(*pair("a", "b")).distinct(), "links")
    labels = None
    while True:
        both = links.select("a", "b").union(links.select("b", "a"))
        trees = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                            .select("node", F.least("node", "m").alias("root")), "trees")
        if labels is None:
            labels = trees
        if not trees.take(1):
            return labels
        while True:
            up = trees.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = materialise(trees.join(up, "root").select("node", "root", "above"), "trees")
            trees = jumped.select("node", F.col("above").alias("root"))
            if not jumped.where("root <> above").take(1):
                break
        step = trees.select(F.col("node").alias("root"), F.col("root").alias("above"))
        labels = materialise(labels.select("node", F.col("root")).join(step, "root", "left")
                             .select("node", F.coalesce("above", "root").alias("root")), "labels")
        at = lambda c: trees.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
        links = materialise(links.join(at("a"), "a").join(at("b"), "b").where("ra <> rb").select(*pair("ra", "rb")).distinct(), "links")
