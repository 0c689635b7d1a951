"""Headline-query timings.

Runs the registered queries at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS] and prints one JSON line.  The metric is the PageRank
headline (trade graph, 10 iterations, built from the parquet tables); every
other timed query is listed under "queries".  A warm-up pass over the
smaller scales runs first so JVM start-up and JIT compilation are not billed to
the first timed query; the headline is the median of three runs (all three
are reported).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from rankwalk.plans import queries as q  # noqa: E402
from rankwalk.session import local_session  # noqa: E402

HEADLINE = "pagerank"
TIMED = ["pagerank", "pagerank_topk", "topk_with_titles", "pagerank_graphx_norm", "graph_init",
         "count_nodes", "out_degree", "avg_out_degree", "degree_histogram", "top_out_degree",
         "degree_sample", "transition_weights", "adjacency_parse", "edge_table",
         "adjacency_list", "power_iteration", "transition_matrix", "mass_trace", "record_edges",
         "hops_trade", "hops_seq", "shortest_paths_trade"]


def run(spark, name, sf):
    t = time.time()
    df = q.QUERIES[name](spark, sf)
    # The noop sink computes every column of every row without shipping the
    # result to the driver.
    df.write.format("noop").mode("overwrite").save()
    return time.time() - t, None


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or TIMED
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "8")),
                          app="rankwalk-bench")
    for warm in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        for name in ("pagerank", "degree_histogram"):
            run(spark, name, warm)
    times, runs = {}, []
    for name in names:
        if name == HEADLINE:
            runs = sorted(round(run(spark, name, sf)[0], 3) for _ in range(3))
            times[name] = runs[1]
        else:
            times[name] = round(run(spark, name, sf)[0], 3)
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": f"{HEADLINE}_10iter_sec", "value": times.get(HEADLINE),
                      "unit": "sec", "queries": times, "headline_runs": runs, "sf": sf_label,
                      "cpus": cpus, "total_sec": round(sum(times.values()), 3)}))


if __name__ == "__main__":
    main()
