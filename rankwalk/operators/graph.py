"""Graph construction: vertex and weighted edge tables.

A graph is two DataFrames:

* ``edges``    (src STRING, dst STRING, cnt BIGINT) - one row per (src, dst),
  ``cnt`` > 0 is the link multiplicity;
* ``vertices`` (id STRING) - every node: link sources, link targets and
  sources whose link list is empty.

Everything is expressed with DataFrame operators so Catalyst plans it; the
only shuffles are the ones the semantics require (distinct ids, per-source
sums), each combined map-side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Column
from pyspark.sql import functions as F

from ..session import FREED_CONF, scratch_path, session_conf
from .sequence import numbered, tasks_for

SALT_CHUNK = 1_000_000              # edges of one source that a task gets at most
HUB_BROADCAST_MAX = 100_000         # sources with more are broadcast only below this count


def written(df: DataFrame, name: str, folders: list[str] | None = None) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: evaluated once, and
    on either side of a join Spark can split a hot key's partition.  Its
    shuffles are freed at once; ``folders`` gets the folder, for who deletes it."""
    path = scratch_path(df.sparkSession, name)
    if folders is not None:
        folders.append(path)
    with session_conf(df.sparkSession, FREED_CONF):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Graph:
    """``edges`` (src, dst, cnt) plus optional ``extra_ids`` (id): nodes that
    must exist even without any link (records with an empty link list).
    ``stored``: the edges are a written table, which costs little to read again."""
    edges: DataFrame
    extra_ids: DataFrame | None = None
    stored: bool = False

    @property
    def vertices(self) -> DataFrame:
        return vertices_of(self.edges, self.extra_ids)

    def once(self) -> "Graph":
        """The same graph with its edges written, so that an operator which
        reads them several times evaluates their source once."""
        return Graph(written(self.edges.select("src", "dst", "cnt"), "edges"), self.extra_ids, stored=True)


def _id(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def edges_from_pairs(df: DataFrame, src: str | Column = "src", dst: str | Column = "dst",
                     cnt: str | Column | None = None) -> DataFrame:
    """(src, dst[, cnt]) rows -> one edge per pair, multiplicity summed.

    Without ``cnt`` each input row is one link.  Pairs with a total count
    <= 0 are dropped (a node whose links all count 0 becomes a sink).
    """
    weight = F.lit(1).cast("bigint") if cnt is None else (
        (F.col(cnt) if isinstance(cnt, str) else cnt).cast("bigint"))
    return (df.select(_id(src).alias("src"), _id(dst).alias("dst"), weight.alias("cnt"))
              .where(F.col("src").isNotNull() & F.col("dst").isNotNull())
              .groupBy("src", "dst").agg(F.sum("cnt").alias("cnt"))
              .where(F.col("cnt") > 0))


def edges_from_records(records: DataFrame, node: str = "node", links: str = "links") -> DataFrame:
    """Adjacency records (node, links MAP<STRING,INT>) -> edge table.

    Records for the same node are merged as *sets* of (dst, cnt) pairs: an
    identical pair repeated on two lines counts once, different counts for
    the same target add up.  Counts <= 0 are dropped.  The exploded pairs are
    written (parsed once), and shuffled once on (src, dst); the set merge and
    the sum then both run inside that partitioning (one exchange instead of two).
    """
    return _merged(written(records.select(F.col(node).cast("string").alias("src"), F.explode(F.col(links)).alias("dst", "cnt")), "record-links"))


def _merged(links: DataFrame) -> DataFrame:
    """Exploded record links (src, dst, cnt), a written table -> edge table.
    The partitions follow the number of pairs."""
    pairs = (links.select("src", "dst", F.col("cnt").cast("bigint").alias("cnt"))
                  .where(F.col("src").isNotNull() & F.col("dst").isNotNull()))
    return (pairs.repartition(tasks_for(links), "src", "dst").distinct()
                 .groupBy("src", "dst").agg(F.sum("cnt").alias("cnt"))
                 .where(F.col("cnt") > 0))


def vertices_of(edges: DataFrame, record_ids: DataFrame | None = None) -> DataFrame:
    """All node ids: both edge endpoints plus ids of (possibly empty) records."""
    ids = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id")))
    if record_ids is not None:
        ids = ids.unionByName(record_ids.select(F.col(record_ids.columns[0]).cast("string").alias("id")))
    return ids.distinct()


def graph_from_pairs(df: DataFrame, src="src", dst="dst", cnt=None) -> Graph:
    return Graph(edges_from_pairs(df, src, dst, cnt))


def graph_from_records(records: DataFrame, node: str = "node", links: str = "links") -> Graph:
    """Every record id is a node (an empty link list makes a sink), and so is
    every target named with a count <= 0 (its link is dropped, the node stays).

    The records are read and parsed once: one exploded table, with a row of a
    null target for an empty record, gives the edges, the record ids and the
    targets without a link.
    """
    every = written(records.select(F.col(node).cast("string").alias("src"), F.explode_outer(F.col(links)).alias("dst", "cnt")), "record-links")
    ids = every.select(F.col("src").alias("id")).unionByName(every.where("cnt <= 0").select(F.col("dst").alias("id")))
    return Graph(_merged(every), ids.where("id is not null").distinct())


def out_degree(edges: DataFrame) -> DataFrame:
    """Per source: out-degree with multiplicity and number of distinct targets."""
    return edges.groupBy("src").agg(F.sum("cnt").alias("out_degree"),
                                    F.count(F.lit(1)).alias("n_targets"))


def in_degree(edges: DataFrame) -> DataFrame:
    """Per target: in-degree with multiplicity."""
    return edges.groupBy("dst").agg(F.sum("cnt").alias("in_degree"))


def with_source_totals(edges: DataFrame, salt_chunk: int = SALT_CHUNK) -> DataFrame:
    """Every edge with its source's ``out_degree`` and ``n_targets``, in two
    phases, so that no task gets more than ``salt_chunk`` edges of one source.

    Edges and totals are written once.  Sources with more than ``salt_chunk``
    targets (at most E / salt_chunk) meet their edges where these lie, by a
    broadcast after a count shows at most ``HUB_BROADCAST_MAX`` of them; all
    other sources are joined by a shuffle on the source.  More hubs than that
    are shuffled too, between two plain tables, which Spark splits by size.
    """
    edges = written(edges.select("src", "dst", "cnt"), "edges")
    totals = written(out_degree(edges), "totals")
    hubs = totals.where(F.col("n_targets") > salt_chunk)
    n_hubs = hubs.limit(HUB_BROADCAST_MAX + 1).count()
    if not n_hubs:
        return edges.join(totals, "src")
    hubs = F.broadcast(hubs) if n_hubs <= HUB_BROADCAST_MAX else written(hubs, "hubs")
    few = totals.where(F.col("n_targets") <= salt_chunk)
    return (edges.join(hubs.select("src"), "src", "left_anti").join(few, "src")
            .unionByName(edges.join(hubs, "src")))


def transition_weights(edges: DataFrame, salt_chunk: int = SALT_CHUNK) -> DataFrame:
    """(src, dst, w) with ``w = cnt / sum(cnt) over src``; a hot source is split."""
    return with_source_totals(edges, salt_chunk).select("src", "dst", (F.col("cnt") / F.col("out_degree")).alias("w"))


def dangling(graph: Graph) -> DataFrame:
    """Nodes without an out-link (left anti join of vertices on sources)."""
    return graph.vertices.join(graph.edges.select(F.col("src").alias("id")).distinct(),
                               "id", "left_anti")


def vertex_table(graph: Graph) -> DataFrame:
    """(id, out_degree, n_targets, dangling) for every node."""
    deg = out_degree(graph.edges).withColumnRenamed("src", "id")
    return (graph.vertices.join(deg, "id", "left")
                 .select("id",
                         F.coalesce("out_degree", F.lit(0)).cast("bigint").alias("out_degree"),
                         F.coalesce("n_targets", F.lit(0)).cast("bigint").alias("n_targets"),
                         F.col("out_degree").isNull().alias("dangling")))


def init_graph(graph: Graph) -> DataFrame:
    """One row per node with its initial rank 1/N, the dangling flag and the
    out-degree.  N is a scalar subquery over the vertex table (no driver round
    trip, no join)."""
    vt = vertex_table(graph.once())
    n = vt.agg(F.count(F.lit(1)).cast("double")).scalar()
    return vt.select("id", "dangling", "out_degree", (F.lit(1.0) / n).alias("rank"))


def adjacency_list(graph: Graph) -> DataFrame:
    """(id, position, neighbor, count): each node's targets in order, one row a
    target under the node's own key, whatever its degree; a sink has one row
    at position 0 without a neighbour.  No row or task holds a whole list."""
    graph = graph.once()
    listed = numbered(graph.edges.select(F.col("src").alias("id"), F.col("dst").alias("neighbor"), F.col("cnt").alias("count")),
                      "id", ["neighbor"])
    none = [F.lit(0).cast("bigint").alias("position"), F.lit(None).cast("string").alias("neighbor"), F.lit(None).cast("bigint").alias("count")]
    return listed.select("id", "position", "neighbor", "count").unionByName(dangling(graph).select("id", *none))
