"""The registered queries: one callable per operator of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame over the whole driver
tables (or graphs Spark derives from them).  Rank-like doubles are rounded to
``RANK_DIGITS`` places so results compare across engines independent of
floating-point summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import eda, graph as gr, markov, pagerank as pr, report, traversal
from ..session import scratch_path
from ..sources import adjacency, index, inventory
from . import graphs
from .oracle import RANK_DIGITS

ALPHA = 0.15
ITERATIONS = 10
TOP_K = 20
TOP_DEGREE = 10
SAMPLE_SIZE = 1000
SAMPLE_SEED = 42
HIST_BINS = 50
TOLERANCE = 1e-8
MOST_STEPS = 30


def _round(col: str, alias: str | None = None):
    return F.round(F.col(col), RANK_DIGITS).alias(alias or col)


def _trade_ranks(spark: SparkSession, sf: str) -> DataFrame:
    ranks = pr.pagerank(graphs.trade_graph(spark, sf), ALPHA, ITERATIONS)
    return ranks.select("id", _round("rank"))


# ---------------------------------------------------------------- sources

def q_adjacency_parse(spark, sf):
    """Render the trade graph as adjacency text, scan it back, parse it."""
    path = scratch_path(spark, "adjacency")
    adjacency.render_adjacency(graphs.trade_edges(spark, sf)).write.text(path)
    records = adjacency.read_adjacency(spark, path)
    return gr.edges_from_records(records).select("src", "dst", "cnt")


def q_page_index_lookup(spark, sf):
    """Render the trade titles as index lines, read them with the index source."""
    edges = graphs.trade_edges(spark, sf)
    path = scratch_path(spark, "index")
    index.render_index(graphs.trade_names(spark, sf), gr.in_degree(edges),
                       gr.out_degree(edges)).write.text(path)
    return index.read_index(spark, path).select(
        "id", "title", F.col("in_degree").cast("bigint").alias("in_degree"),
        F.col("out_degree").cast("bigint").alias("out_degree"))


def q_source_inventory(spark, sf):
    return inventory.list_files(spark, sf).select("name", "length")


def q_peek_rows(spark, sf):
    return graphs.trade_edges(spark, sf).orderBy("src", "dst").limit(30)


# ---------------------------------------------------------------- graph

def q_node_set(spark, sf):
    return graphs.trade_graph(spark, sf).vertices


def q_edge_table(spark, sf):
    return graphs.web_graph(spark, sf).edges.select("src", "dst", "cnt")


def q_dangling_nodes(spark, sf):
    return gr.dangling(graphs.trade_graph(spark, sf).once())


def q_graph_init(spark, sf):
    init = gr.init_graph(graphs.trade_graph(spark, sf))
    return init.select("id", "dangling", "out_degree", _round("rank"))


def q_transition_weights(spark, sf):
    return gr.transition_weights(graphs.trade_edges(spark, sf))


def q_in_degree(spark, sf):
    return gr.in_degree(graphs.trade_edges(spark, sf)).select(F.col("dst").alias("id"), "in_degree")


def q_adjacency_list(spark, sf):
    return gr.adjacency_list(graphs.seq_graph(spark, sf))


# ---------------------------------------------------------------- EDA

def q_record_count(spark, sf):
    return eda.count_records(graphs.order_records(spark, sf))


def q_count_nodes(spark, sf):
    return eda.count_nodes(graphs.trade_graph(spark, sf))


def q_dangling_count(spark, sf):
    return eda.dangling_count(graphs.web_graph(spark, sf))


def q_out_degree(spark, sf):
    return eda.record_degrees(graphs.order_records(spark, sf))


def q_avg_out_degree(spark, sf):
    avg = eda.average_degree(eda.record_degrees(graphs.order_records(spark, sf)))
    return avg.select("records", "links", _round("avg_out_degree"))


def q_top_out_degree(spark, sf):
    return eda.top_by(eda.source_degrees(graphs.trade_graph(spark, sf)), "out_degree", TOP_DEGREE)


def q_degree_sample(spark, sf):
    return eda.sample_fixed(eda.source_degrees(graphs.trade_graph(spark, sf)), SAMPLE_SIZE, SAMPLE_SEED)


def q_sample_histogram(spark, sf):
    """The notebook's plot input: a histogram of the 1000-row degree sample."""
    sample = eda.sample_fixed(eda.source_degrees(graphs.trade_graph(spark, sf)), SAMPLE_SIZE, SAMPLE_SEED)
    hist = eda.histogram(sample, "out_degree", HIST_BINS)
    return hist.select("bin", _round("lo"), _round("hi"), "count")


def q_degree_histogram(spark, sf):
    hist = eda.histogram(eda.source_degrees(graphs.trade_graph(spark, sf)), "out_degree", HIST_BINS)
    return hist.select("bin", _round("lo"), _round("hi"), "count")


def q_node_count_sketches(spark, sf):
    """Nodes of each kind from stored sketches, and of all kinds from their
    merge; 0.08 is five standard errors."""
    nodes = gr.written(graphs.trade_graph(spark, sf).once().vertices, "nodes").withColumn("kind", F.substring("id", 1, 1))
    sketches = gr.written(eda.node_sketches(nodes, F.col("kind")), "sketches")
    direct = eda.merged_estimate(eda.node_sketches(nodes, F.lit("*"))).scalar()
    near = lambda a, b: F.abs(a - b) <= 0.08 * b
    exact = nodes.groupBy("kind").agg(F.count(F.lit(1)).alias("nodes"))
    each = (exact.join(sketches, "kind").withColumn("found", F.hll_sketch_estimate("sketch"))
            .select("kind", "nodes", near(F.col("found"), F.col("nodes")).alias("within"), near(F.col("found"), F.col("found")).alias("as_direct")))
    total = (eda.merged_estimate(sketches).withColumnRenamed("nodes", "found").withColumn("nodes", exact.agg(F.sum("nodes")).scalar())
             .select(F.lit("*").alias("kind"), "nodes", near(F.col("found"), F.col("nodes")).alias("within"), near(F.col("found"), direct).alias("as_direct")))
    return each.unionByName(total)


def q_record_edges(spark, sf):
    """Set merge: a customer with several orders has several records, of which
    equal (part, count) pairs count once."""
    return gr.graph_from_records(graphs.order_records(spark, sf)).edges.select("src", "dst", "cnt")


# ---------------------------------------------------------------- Markov

def q_adjacency_matrix(spark, sf):
    return markov.adjacency_matrix(graphs.states_graph(spark, sf)).select(
        "src", "dst", F.col("value").cast("bigint").alias("value"))


def q_transition_matrix(spark, sf):
    return markov.transition_matrix(graphs.states_graph(spark, sf))


def q_adjacency_matrix_web(spark, sf):
    """The same on the page links: a state for every page and link target."""
    return markov.adjacency_matrix(graphs.web_graph(spark, sf)).select(
        "src", "dst", F.col("value").cast("bigint").alias("value"))


def q_transition_matrix_web(spark, sf):
    """Page links, most targets being sinks: these have no row."""
    return markov.transition_matrix(graphs.web_graph(spark, sf))


def q_power_iteration(spark, sf):
    x = markov.power_iteration(graphs.seq_graph(spark, sf), ITERATIONS, start="first")
    return x.select("id", _round("mass"))


def q_power_iteration_squaring(spark, sf):
    x = markov.power_iteration_squaring(graphs.states_graph(spark, sf), 3, start="first")
    return x.select("id", _round("mass"))


def q_power_iteration_squaring_seq(spark, sf):
    """The same on a chain that grows with the data: a state for every part."""
    x = markov.power_iteration_squaring(graphs.seq_graph(spark, sf), 3, start="first")
    return x.select("id", _round("mass"))


def q_mass_trace(spark, sf):
    trace = markov.mass_trace(graphs.web_graph(spark, sf), ITERATIONS, start="uniform")
    return trace.select("step", _round("total_mass"))


# ---------------------------------------------------------------- PageRank

def q_pagerank(spark, sf):
    return _trade_ranks(spark, sf)


def q_pagerank_web(spark, sf):
    """PageRank on the href graph of the pages: string ids, mostly sinks, and
    pages kept as nodes even without links."""
    ranks = pr.pagerank(graphs.web_graph(spark, sf), ALPHA, ITERATIONS)
    return ranks.select("id", _round("rank"))


def q_pagerank_step(spark, sf):
    ranks = pr.pagerank(graphs.trade_graph(spark, sf), ALPHA, 1)
    return ranks.select("id", _round("rank"))


def _metrics(spark, sf):
    return pr.pagerank_metrics(graphs.trade_graph(spark, sf), ALPHA, ITERATIONS)


def q_dangling_mass(spark, sf):
    return _metrics(spark, sf).select("step", _round("dangling_mass"))


def q_total_mass(spark, sf):
    return _metrics(spark, sf).select("step", _round("total_mass"))


def q_pagerank_topk(spark, sf):
    return report.topk(_trade_ranks(spark, sf), TOP_K)


def q_pagerank_graphx(spark, sf):
    """GraphX-convention ranks on their own scale (sum N)."""
    ranks = pr.pagerank_graphx(graphs.trade_graph(spark, sf), ALPHA, ITERATIONS)
    return ranks.select("id", _round("pagerank"))


def q_pagerank_graphx_norm(spark, sf):
    """GraphX-convention ranks (sum N) reported on the probability scale
    (divided by N), the scale every other rank query uses."""
    g = graphs.trade_graph(spark, sf)
    ranks = pr.pagerank_graphx(g, ALPHA, ITERATIONS)
    n = ranks.agg(F.count(F.lit(1)).cast("double")).scalar()
    return ranks.select("id", F.round(F.col("pagerank") / n, RANK_DIGITS).alias("pagerank"))


def q_pagerank_convergence(spark, sf):
    """Largest change of a rank in every step, until it is below the tolerance."""
    steps = pr.pagerank_convergence(graphs.seq_graph(spark, sf), ALPHA, TOLERANCE, MOST_STEPS)
    return steps.select("step", _round("max_delta"), "stopped")


# ---------------------------------------------------------------- traversal

def q_hops_trade(spark, sf):
    return traversal.hop_distances(graphs.trade_graph(spark, sf))


def q_hops_web(spark, sf):
    return traversal.hop_distances(graphs.web_graph(spark, sf))


def q_hops_seq(spark, sf):
    return traversal.hop_distances(graphs.seq_graph(spark, sf))


def q_shortest_paths_trade(spark, sf):
    """A link costs less the more line items it stands for."""
    return traversal.distances(graphs.trade_graph(spark, sf), cost="1D / l.cnt", width=0.25).select("id", _round("dist"))


def q_shortest_paths_seq(spark, sf):
    return traversal.distances(graphs.seq_graph(spark, sf), cost="1D / l.cnt", width=0.25).select("id", _round("dist"))


def q_strong_components(spark, sf):
    found = pr.cut_lineage(traversal.strong_components(graphs.relay_graph(spark, sf)), mode="parquet")
    sizes = pr.cut_lineage(found.groupBy("component").agg(F.count(F.lit(1)).alias("size")), mode="parquet")
    return found.join(sizes, "component").select("id", "component", "size")


def q_chain_structure(spark, sf):
    return traversal.chain_structure(graphs.chain_graph(spark, sf))


# ---------------------------------------------------------------- reports

def _titled_top(spark, sf):
    top = report.topk(_trade_ranks(spark, sf), TOP_K)
    return report.with_titles(top, graphs.trade_names(spark, sf))


def q_topk_with_titles(spark, sf):
    return _titled_top(spark, sf)


def q_topk_titled_only(spark, sf):
    """Only suppliers have titles here: the other nodes of the top 200 drop out."""
    top = report.topk(_trade_ranks(spark, sf), 200)
    names = graphs.table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("title"))
    return report.with_titles(top, names)


def q_ranked_report(spark, sf):
    return report.ranked_lines(_titled_top(spark, sf))


def q_topk_parquet_roundtrip(spark, sf):
    return report.parquet_roundtrip(report.topk(_trade_ranks(spark, sf), TOP_K), "top20")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "adjacency_parse": q_adjacency_parse,
    "page_index_lookup": q_page_index_lookup,
    "source_inventory": q_source_inventory,
    "peek_rows": q_peek_rows,
    "topk_parquet_roundtrip": q_topk_parquet_roundtrip,
    "ranked_report": q_ranked_report,
    "node_set": q_node_set,
    "edge_table": q_edge_table,
    "dangling_nodes": q_dangling_nodes,
    "graph_init": q_graph_init,
    "topk_with_titles": q_topk_with_titles,
    "pagerank_step": q_pagerank_step,
    "record_count": q_record_count,
    "count_nodes": q_count_nodes,
    "dangling_count": q_dangling_count,
    "out_degree": q_out_degree,
    "in_degree": q_in_degree,
    "avg_out_degree": q_avg_out_degree,
    "transition_weights": q_transition_weights,
    "dangling_mass": q_dangling_mass,
    "total_mass": q_total_mass,
    "degree_histogram": q_degree_histogram,
    "sample_histogram": q_sample_histogram,
    "adjacency_list": q_adjacency_list,
    "top_out_degree": q_top_out_degree,
    "degree_sample": q_degree_sample,
    "pagerank_topk": q_pagerank_topk,
    "adjacency_matrix": q_adjacency_matrix,
    "transition_matrix": q_transition_matrix,
    "adjacency_matrix_web": q_adjacency_matrix_web,
    "transition_matrix_web": q_transition_matrix_web,
    "power_iteration": q_power_iteration,
    "power_iteration_squaring": q_power_iteration_squaring,
    "power_iteration_squaring_seq": q_power_iteration_squaring_seq,
    "mass_trace": q_mass_trace,
    "pagerank": q_pagerank,
    "pagerank_web": q_pagerank_web,
    "pagerank_graphx": q_pagerank_graphx,
    "pagerank_graphx_norm": q_pagerank_graphx_norm,
    "pagerank_convergence": q_pagerank_convergence,
    "node_count_sketches": q_node_count_sketches,
    "record_edges": q_record_edges,
    "topk_titled_only": q_topk_titled_only,
    "hops_trade": q_hops_trade,
    "hops_web": q_hops_web,
    "hops_seq": q_hops_seq,
    "shortest_paths_trade": q_shortest_paths_trade,
    "shortest_paths_seq": q_shortest_paths_seq,
    "strong_components": q_strong_components,
    "chain_structure": q_chain_structure,
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Trade graph -> PageRank (10 steps) -> top 20 -> titles."""
    return _titled_top(spark, sf)
