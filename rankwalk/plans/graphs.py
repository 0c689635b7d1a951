"""Link graphs derived from the driver tables.

* ``trade``  customer -> part (orders join lineitem) and part -> supplier
  (lineitem); ``cnt`` = number of line items; ids ``C<custkey>``,
  ``P<partkey>``, ``S<suppkey>``; suppliers are sinks.
* ``seq``    part -> next part inside an order (by line number, part, supplier).
* ``web``    page_id -> every ``href`` of its html; repeated links count.
* ``states`` event type -> next event type of the same user (by ts, event_id).
* ``relay``  the two heaviest links of every part in ``seq``.
* ``chain``  ``relay``, and customer <-> nation beside it.

All read whole tables; only the columns needed reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import Graph, edges_from_pairs
from ..operators.sequence import consecutive_pairs, tasks_for

HREF_PATTERN = 'href="([^"]*)"'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prefixed(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst, cnt) of the trade graph.

    Counting happens on the numeric keys; the string ids are built only for
    the aggregated pairs.  The two edge families have disjoint id prefixes,
    so their union needs no further aggregation.  Pairs seldom repeat, so they
    are shuffled as they are, to partitions that follow the number of line items.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    parts = tasks_for(lineitem)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # Line items counted per (order, part) before the join: the join then
    # moves counted pairs, and a hot order key is split by AQE skew handling.
    per_order = (lineitem.select("l_orderkey", "l_partkey").repartition(parts, "l_orderkey", "l_partkey")
                 .groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("n")))
    cust_part = (per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
                 .select("o_custkey", "l_partkey", "n").repartition(parts, "o_custkey", "l_partkey")
                 .groupBy("o_custkey", "l_partkey").agg(F.sum("n").alias("cnt"))
                 .select(_prefixed("C", "o_custkey").alias("src"),
                         _prefixed("P", "l_partkey").alias("dst"), "cnt"))
    part_supp = (lineitem.select("l_partkey", "l_suppkey").repartition(parts, "l_partkey", "l_suppkey").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("cnt"))
                 .select(_prefixed("P", "l_partkey").alias("src"),
                         _prefixed("S", "l_suppkey").alias("dst"), "cnt"))
    return cust_part.unionByName(part_supp)


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One adjacency record per order: (node = customer, links = part -> number
    of line items).  An order without line items has an empty map, a customer
    with several orders several records.  A map is bounded by its order."""
    items = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("l_orderkey").agg(F.collect_list(F.struct(_prefixed("P", "l_partkey").alias("k"), "n")).alias("parts")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    none = F.array().cast("array<struct<k:string,n:bigint>>")
    return (orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
            .select(_prefixed("C", "o_custkey").alias("node"), F.map_from_entries(F.coalesce("parts", none)).alias("links")))


def trade_graph(spark: SparkSession, sf_dir: str) -> Graph:
    return Graph(trade_edges(spark, sf_dir))


def trade_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, title) for every customer, part and supplier."""
    return (table(spark, sf_dir, "customer").select(_prefixed("C", "c_custkey").alias("id"),
                                                    F.col("c_name").alias("title"))
            .unionByName(table(spark, sf_dir, "part").select(_prefixed("P", "p_partkey").alias("id"),
                                                             F.col("p_name").alias("title")))
            .unionByName(table(spark, sf_dir, "supplier").select(_prefixed("S", "s_suppkey").alias("id"),
                                                                 F.col("s_name").alias("title"))))


def seq_graph(spark: SparkSession, sf_dir: str) -> Graph:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    pairs = consecutive_pairs(lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"],
                              "l_partkey")
    return Graph(edges_from_pairs(pairs, "src", "dst", "cnt"))


def web_graph(spark: SparkSession, sf_dir: str) -> Graph:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    links = pages.select(F.col("page_id").cast("string").alias("src"),
                         F.explode(F.regexp_extract_all("html", F.lit(HREF_PATTERN), 1)).alias("dst"))
    edges = edges_from_pairs(links, "src", "dst")
    # Every page is a record, even one without links (it is then a sink).
    return Graph(edges, pages.select(F.col("page_id").cast("string").alias("id")))


def states_graph(spark: SparkSession, sf_dir: str) -> Graph:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    pairs = consecutive_pairs(events, "user_id", ["ts", "event_id"], "event_type")
    return Graph(edges_from_pairs(pairs, "src", "dst", "cnt"))


def relay_edges(spark: SparkSession, sf_dir: str, most: int = 2) -> DataFrame:
    """The ``most`` heaviest links of every part in the sequence graph (of equal
    ones the smallest targets); Spark limits each group before its shuffle."""
    heaviest = Window.partitionBy("src").orderBy(F.desc("cnt"), "dst")
    return (seq_graph(spark, sf_dir).edges.withColumn("_nr", F.row_number().over(heaviest))
            .where(F.col("_nr") <= most).drop("_nr"))


def relay_graph(spark: SparkSession, sf_dir: str) -> Graph:
    return Graph(relay_edges(spark, sf_dir))


def chain_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The relay links of the parts, and beside them every customer linked both
    ways with their nation: chains of period 2 around 25 growing hubs."""
    lives = table(spark, sf_dir, "customer").select(_prefixed("C", "c_custkey").alias("c"), _prefixed("N", "c_nationkey").alias("n"))
    lives = lives.where("c IS NOT NULL AND n IS NOT NULL")
    both = lives.select(F.col("c").alias("src"), F.col("n").alias("dst")).unionByName(lives.select(F.col("n").alias("src"), F.col("c").alias("dst")))
    return Graph(relay_edges(spark, sf_dir).unionByName(both.select("src", "dst", F.lit(1).cast("bigint").alias("cnt"))))
