"""Traversals of a link graph: distances, strongly connected components and
the structure of the chain that walks it.

All of them move one value a node along the links until nothing changes, over
the tables that :func:`pagerank.prepare` builds once: ``links`` partitioned by
source, the links of hubs spread over (source, salt) buckets, and a state with
a row for each node that stays partitioned by id.  A step joins the active
rows of the state with the links where they lie, combines what arrives at a
node map-side, and shuffles only that; the links never move again.  The new
state is a reliable checkpoint, and the state before it is deleted.

Cases: a graph without nodes gives an empty result; a node without links is
its own component and reachable only from itself; links that lead to their own
source count as cycles of length one; ids are compared as strings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pagerank as pr
from .graph import Graph


class Walk:
    """A state (id, ... one row a node) stepped over one or more prepared graphs."""

    def __init__(self, state: DataFrame, partitions: int) -> None:
        self.spark, self.partitions = state.sparkSession, partitions
        self.view = f"rankwalk_walk_{uuid.uuid4().hex[:12]}"
        self.state = None
        self._keep(state)

    def _keep(self, state: DataFrame) -> None:
        old = self.state
        self.state = pr.cut_lineage(state, partitions=self.partitions)
        self.state.createOrReplaceTempView(self.view)
        if old is not None:
            pr.drop_checkpoint(old)

    def close(self) -> None:
        self.spark.catalog.dropTempView(self.view)

    def sent(self, prepared: pr.PreparedGraph, salts: str, active: str, value: str, edge: str = "r.v", fold: str = "min") -> str:
        """SQL of (dst, x): ``fold`` over what the ``active`` rows send along
        their links; ``edge`` makes it from r.v, their ``value``, and the link l."""
        flows = f"""
            SELECT /*+ SHUFFLE_HASH(r) */ l.dst, {edge} AS x FROM {prepared.view("links")} l
            JOIN (SELECT id AS src, {value} AS v FROM {self.view} WHERE {active}) r ON l.src = r.src"""
        if prepared.hub_links is not None:
            flows += f"""
            UNION ALL
            SELECT /*+ SHUFFLE_HASH(r) */ l.dst, {edge} AS x FROM {prepared.view("hub_links")} l
            JOIN (SELECT id AS src, explode(sequence(0, {salts} - 1)) AS salt, {value} AS v
                  FROM {self.view} WHERE {salts} > 1 AND ({active})) r ON l.src = r.src AND l.salt = r.salt"""
        return f"SELECT dst, {fold}(x) AS x FROM ({flows}) f GROUP BY dst"

    def step(self, columns: str, *sent: str) -> None:
        """The next state: ``columns`` over the state s and what was sent (c0, c1)."""
        joins = "\n".join(f"LEFT JOIN ({q}) c{i} ON s.id = c{i}.dst" for i, q in enumerate(sent))
        hints = "".join(f" SHUFFLE_HASH(c{i})" for i in range(len(sent)))
        hints = f"/*+{hints} */" if sent else ""
        self._keep(self.spark.sql(f"SELECT {hints} {columns} FROM {self.view} s {joins}"))

    def one(self, what: str):
        """A single value of the state."""
        return self.spark.sql(f"SELECT {what} FROM {self.view}").first()[0]


def _relaxed(prepared: pr.PreparedGraph, starts: DataFrame, cost: str, width: float) -> DataFrame:
    """(id, dist) by bucketed relaxation from the nodes of ``starts`` (id)."""
    at = starts.select("id", F.lit(0.0).alias("dist"))
    state = prepared.vertices.join(at, "id", "left").select("id", "nsalt", "dist", F.col("dist").isNotNull().alias("open"))
    walk = Walk(state, prepared.partitions)
    try:
        while (low := walk.one("min(dist) FILTER (WHERE open)")) is not None:
            limit = (low // width + 1) * width
            limit = limit if limit > low else float("inf")      # width lost in rounding
            now = f"(s.open AND s.dist < {pr.double_literal(limit)})"
            walk.step(f"""s.id, s.nsalt, least(s.dist, c0.x) AS dist,
                          (s.open AND NOT {now}) OR (c0.x IS NOT NULL AND (s.dist IS NULL OR c0.x < s.dist)) AS open""",
                      walk.sent(prepared, "nsalt", now.replace("s.", ""), "dist", f"r.v + {cost}"))
    finally:
        walk.close()
    return walk.state.select("id", "dist")


def distances(graph: Graph, starts: DataFrame | None = None, cost: str = "1D", width: float = 1.0,
              salt_chunk: int = pr.DEFAULT_SALT_CHUNK) -> DataFrame:
    """(id, dist): the least total cost of a path from a node of ``starts``
    (id; the smallest id if not given) to every node, null where none leads.

    ``cost`` is SQL over the link l (l.cnt is its multiplicity) and must not be
    negative.  Nodes are settled in buckets of ``width``: a step relaxes the
    links of all nodes of the lowest bucket that were improved since their last
    turn.  With cost and width 1 that is breadth-first search, each node having
    one turn; a smaller width makes more steps, a larger one more repeated turns.
    """
    prepared = pr.prepare(graph, salt_chunk)
    try:
        if starts is None:
            starts = prepared.vertices.agg(F.min("id").alias("id")).where("id is not null")
        return _relaxed(prepared, starts.select(F.col("id").cast("string").alias("id")).distinct(), cost, width)
    finally:
        prepared.release()


def hop_distances(graph: Graph, starts: DataFrame | None = None, salt_chunk: int = pr.DEFAULT_SALT_CHUNK) -> DataFrame:
    """(id, hops): links on the shortest way from the smallest id (or ``starts``)."""
    return distances(graph, starts, salt_chunk=salt_chunk).select("id", F.col("dist").cast("bigint").alias("hops"))


def _reversed(graph: Graph) -> Graph:
    return Graph(graph.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "cnt"), graph.extra_ids, graph.stored)


def strong_components(graph: Graph, salt_chunk: int = pr.DEFAULT_SALT_CHUNK) -> DataFrame:
    """(id, component): the smallest id of the node's strongly connected component.

    Rounds over the nodes that have no component yet.  Trimming: a node that
    none of them links to, or that links to none, is a component of its own;
    repeated while it finds any.  Colouring: every node takes the smallest id
    that reaches it, its colour.  A node whose colour is its own id has as
    component those nodes of its colour that reach it, found by walking the
    links backwards inside the colour: along a link v -> w the colour of w is
    never above that of v, so the largest colour that arrives backwards tells
    whether any equals the receiver's.
    """
    graph = graph if graph.stored else graph.once()
    forth = pr.prepare(graph, salt_chunk)
    back = None
    try:
        back = pr.prepare(_reversed(graph), salt_chunk, partitions=forth.partitions)
        state = forth.vertices.select("id", "nsalt").join(back.vertices.select("id", F.col("nsalt").alias("bsalt")), "id")
        none = F.lit(None).cast("string")
        walk = Walk(state.select("id", "nsalt", "bsalt", none.alias("component"), none.alias("colour"), F.lit(False).alias("moved")),
                    forth.partitions)
        keys, left = "s.id, s.nsalt, s.bsalt", walk.one("count(*)")
        try:
            while left:
                while left:
                    walk.step(f"{keys}, CASE WHEN s.component IS NULL AND (c0.x IS NULL OR c1.x IS NULL) THEN s.id ELSE s.component END AS component, s.id AS colour, true AS moved",
                              walk.sent(forth, "nsalt", "component IS NULL", "true", fold="max"),
                              walk.sent(back, "bsalt", "component IS NULL", "true", fold="max"))
                    before, left = left, walk.one("count(*) FILTER (WHERE component IS NULL)")
                    if left == before:
                        break
                while left and walk.one("max(moved AND component IS NULL)"):
                    walk.step(f"{keys}, s.component, least(s.colour, c0.x) AS colour, coalesce(c0.x < s.colour, false) AS moved",
                              walk.sent(forth, "nsalt", "component IS NULL AND moved", "colour"))
                # From here on moved: reached backwards in the last step.
                walk.step(f"{keys}, CASE WHEN s.component IS NULL AND s.colour = s.id THEN s.id ELSE s.component END AS component, "
                          "CASE WHEN s.component IS NULL THEN s.colour END AS colour, s.component IS NULL AND s.colour = s.id AS moved")
                while left and walk.one("max(moved)"):
                    joins = "s.component IS NULL AND coalesce(c0.x = s.colour, false)"
                    walk.step(f"{keys}, CASE WHEN {joins} THEN s.colour ELSE s.component END AS component, s.colour, {joins} AS moved",
                              walk.sent(back, "bsalt", "moved", "colour", fold="max"))
                left = walk.one("count(*) FILTER (WHERE component IS NULL)")
        finally:
            walk.close()
        return walk.state.select("id", "component")
    finally:
        forth.release()
        if back is not None:
            back.release()


def _gcds(values: DataFrame) -> DataFrame:
    """(component, period): the greatest common divisor of each component's
    whole numbers d > 0, by Euclid's rounds on the distinct ones."""
    rest = pr.cut_lineage(values.distinct(), mode="parquet")
    while True:
        least = pr.cut_lineage(rest.groupBy("component").agg(F.min("d").alias("period"), F.max("d").alias("most")), mode="parquet")
        if not least.where("period < most").take(1):
            return least.select("component", "period")
        both = rest.join(least, "component")
        rest = pr.cut_lineage(both.select("component", F.explode(F.array_distinct(F.array("period", F.col("d") % F.col("period")))).alias("d"))
                              .where("d > 0").distinct(), mode="parquet")


def chain_structure(graph: Graph, salt_chunk: int = pr.DEFAULT_SALT_CHUNK) -> DataFrame:
    """(component, size, closed, period) of the chain that follows the links.

    ``closed``: no link leaves the component, so a walk stays in it; the chain
    is irreducible if there is one component.  ``period``: the greatest common
    divisor of the lengths of all its cycles (1: aperiodic; null: it has none),
    which is that of level(u) + 1 - level(v) over its links u -> v, the level
    being the distance from the component's smallest id inside the component.
    """
    edges = pr.cut_lineage(graph.edges.select("src", "dst", "cnt"), mode="parquet")
    graph = Graph(edges, graph.extra_ids, stored=True)
    labels = pr.cut_lineage(strong_components(graph, salt_chunk), mode="parquet")

    def at_ends(links: DataFrame, values: DataFrame, name: str) -> DataFrame:
        end = lambda c: values.select(F.col("id").alias(c), F.col(name).alias(f"{c}_{name}"))
        return links.join(end("src"), "src").join(end("dst"), "dst")

    known = pr.cut_lineage(at_ends(edges, labels, "component"), mode="parquet")
    inside = known.where("src_component = dst_component").select("src", "dst", "cnt", F.col("src_component").alias("component"))
    levels = distances(Graph(inside.select("src", "dst", "cnt"), labels.select("id")),
                       labels.where("id = component"), salt_chunk=salt_chunk)
    levels = pr.cut_lineage(levels.select("id", F.col("dist").cast("bigint").alias("level")), mode="parquet")
    steps = at_ends(inside, levels, "level").select("component", (F.col("src_level") + 1 - F.col("dst_level")).alias("d"))
    # A difference of 0 says nothing of the divisor, but a component has a
    # cycle only if some difference is not 0.
    periods = _gcds(steps.select("component", F.abs("d").alias("d")).where("d > 0"))
    open_ = known.where("src_component <> dst_component").select(F.col("src_component").alias("component")).distinct().withColumn("leaves", F.lit(True))
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return (sizes.join(open_, "component", "left").join(periods, "component", "left")
            .select("component", "size", F.col("leaves").isNull().alias("closed"), "period"))
