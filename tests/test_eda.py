"""EDA operators and the bounded-row representations."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rankwalk.operators import eda, graph as gr, report
from rankwalk.operators.sequence import numbered
from rankwalk.plans import graphs


def test_adjacency_list_numbers_a_hub_over_many_tasks(spark):
    rows = [("h", f"t{i:05d}", i % 4 + 1) for i in range(25_000)] + [("x", "h", 2), ("a", "h", 1), ("a", "x", 3)]
    g = gr.Graph(spark.createDataFrame(rows, "src string, dst string, cnt bigint"))
    lists = gr.adjacency_list(g)
    got = lists.where("position > 0").select("id", "position", "neighbor", "count").collect()
    assert {(r["id"], r["neighbor"], r["count"]) for r in got} == set(rows)
    assert sorted((r["id"], r["position"]) for r in got) == [("a", 1), ("a", 2)] + [("h", i + 1) for i in range(25_000)] + [("x", 1)]
    hub = {r["position"]: r["neighbor"] for r in got if r["id"] == "h"}
    assert [hub[i] for i in range(1, 25_001)] == [f"t{i:05d}" for i in range(25_000)]
    sinks = lists.where("position = 0").collect()
    assert len(sinks) == 25_000 and all(r["neighbor"] is None and r["count"] is None for r in sinks)
    placed = numbered(g.edges, "src", ["dst"]).where("src = 'h'").groupBy(F.spark_partition_id()).count().count()
    assert placed > 1


def test_a_hot_source_is_split(spark):
    """A third of all edges in one source: its edges meet their total where they lie."""
    rows = [("h", f"t{i}", 1 + i % 3) for i in range(2000)] + [(f"s{i % 500}", f"t{i}", 2) for i in range(4000)]
    edges = spark.createDataFrame(rows, "src string, dst string, cnt bigint").repartition(8)
    total = {}
    for s, _, c in rows:
        total[s] = total.get(s, 0) + c
    for chunk in (300, gr.SALT_CHUNK):
        w = gr.transition_weights(edges, chunk)
        assert {(r["src"], r["dst"]): r["w"] for r in w.collect()} == {(s, d): c / total[s] for s, d, c in rows}
    hot = [r["count"] for r in gr.transition_weights(edges, 300).where("src = 'h'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(hot) == 2000 and max(hot) <= 300


def test_records_are_read_once(spark):
    records = spark.createDataFrame([("a", {"b": 2, "c": 0}), ("a", {"b": 2, "d": 1}), ("a", {"d": 3}), ("e", {}), ("f", {"f": -1})],
                                    "node string, links map<string,int>")
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(node):
        read.add(1)
        return node

    g = gr.graph_from_records(records.select(seen("node").alias("node"), "links"))
    assert {tuple(r) for r in g.edges.collect()} == {("a", "b", 2), ("a", "d", 4)}
    assert {r["id"] for r in g.vertices.collect()} == set("abcdef")
    assert {r["id"] for r in gr.dangling(g).collect()} == set("bcdef")
    assert read.value == 5


def test_sketches_merge(spark):
    nodes = spark.range(20_000).select(F.concat(F.lit("n"), "id").alias("id"))
    stored = eda.node_sketches(nodes.unionByName(nodes.limit(9_000)), F.pmod(F.xxhash64("id"), F.lit(7)))
    assert stored.count() == 7 and abs(eda.merged_estimate(stored).first()["nodes"] - 20_000) <= 0.08 * 20_000
    assert eda.merged_estimate(stored.limit(0)).first()["nodes"] in (0, None)


def test_histogram_bins_cover_all_values(spark):
    df = spark.createDataFrame([(str(i), i) for i in [1, 1, 2, 5, 9, 10]], "id string, out_degree long")
    h = sorted(eda.histogram(df, "out_degree", 3).collect())
    assert [r["count"] for r in h] == [3, 1, 2]      # [1,4) [4,7) [7,10]
    assert h[0]["lo"] == 1.0 and h[-1]["hi"] == 10.0
    flat = spark.createDataFrame([("a", 4), ("b", 4)], "id string, out_degree long")
    h = eda.histogram(flat, "out_degree", 5).collect()
    assert sorted((r["bin"], r["count"]) for r in h) == [(0, 0), (1, 0), (2, 2), (3, 0), (4, 0)]


def test_fixed_size_sample_is_exact_and_repeatable(spark):
    degrees = eda.source_degrees(graphs.trade_graph(spark, SF_SMALL))
    total = degrees.count()
    a = [r["id"] for r in eda.sample_fixed(degrees, 100, 7).collect()]
    b = [r["id"] for r in eda.sample_fixed(degrees, 100, 7).collect()]
    c = [r["id"] for r in eda.sample_fixed(degrees, 100, 8).collect()]
    assert len(a) == 100 == len(set(a)) and a == b and a != c
    assert eda.sample_fixed(degrees, total + 50, 7).count() == total


def test_web_graph_keeps_pages_without_links(spark):
    g = graphs.web_graph(spark, SF_SMALL)
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select(F.col("page_id").cast("string").alias("id"))
    assert pages.join(g.vertices, "id", "left_anti").count() == 0


def test_titles_join_keeps_untitled_ranked_nodes(spark):
    top = spark.createDataFrame([("a", 0.5), ("zz", 0.3)], "id string, rank double")
    titles = spark.createDataFrame([("a", "Alpha"), ("b", "Beta")], "id string, title string")
    out = [tuple(r) for r in report.with_titles(top, titles, how="left").collect()]
    assert out == [("a", "Alpha", 0.5), ("zz", None, 0.3)]
    assert [tuple(r) for r in report.with_titles(top, titles).collect()] == [("a", "Alpha", 0.5)]
    lines = [r["line"] for r in report.ranked_lines(report.with_titles(top, titles)).collect()]
    assert lines[0] == "0.500000\t|          a\t| Alpha"


def test_approximate_node_count_is_close(spark):
    g = graphs.trade_graph(spark, SF_SMALL)
    exact = eda.count_nodes(g).first()["nodes"]
    approx = eda.count_nodes(g, approx=True).first()["nodes"]
    assert abs(approx - exact) <= 0.06 * exact


def test_report_text_has_header_rule_and_lines(spark):
    top = spark.createDataFrame([("a", 0.5), ("b", 0.25)], "id string, rank double")
    titles = spark.createDataFrame([("a", "Alpha"), ("b", "Beta")], "id string, title string")
    text = report.report_text(report.with_titles(top, titles)).splitlines()
    assert text[0] == "PageRank  \t| Page id   \t| Title"
    assert text[1] == "=" * 100
    assert text[2:] == ["0.500000\t|          a\t| Alpha", "0.250000\t|          b\t| Beta"]


def test_report_sink_has_every_line_and_join_is_inner(spark, tmp_dir):
    ranks = spark.range(1500).select(F.col("id").cast("string").alias("id"), (1.0 / (1 + F.col("id"))).alias("rank"))
    titles = ranks.where("id <> '3'").select("id", F.concat(F.lit("t"), "id").alias("title"))
    titled = report.with_titles(ranks, titles)
    assert titled.count() == 1499 and report.with_titles(ranks, titles, how="left").count() == 1500
    report.write_report(titled, tmp_dir + "/report")
    lines = [r["value"] for r in spark.read.text(tmp_dir + "/report").collect()]
    assert len(lines) == 1501 and len(report.report_text(titled).splitlines()) == 1501


def test_empty_graph_and_null_title(spark):
    from rankwalk.operators import markov, pagerank
    from rankwalk.operators.graph import Graph
    from rankwalk.sources import index
    empty = Graph(spark.createDataFrame([], "src string, dst string, cnt bigint"))
    assert pagerank.pagerank_metrics(empty, 0.15, 1).count() == 2
    assert markov.mass_trace(empty, 1).count() == 2
    assert markov.power_iteration(empty, 1, start="uniform").count() == 0
    assert markov.power_iteration_squaring(empty, 1, start="uniform").count() == 0
    line = index.render_index(spark.createDataFrame([("1", None)], "id string, title string")).collect()[0]["value"]
    assert line == "\t1\t0\t0"
