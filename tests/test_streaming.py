"""Adjacency files arriving in a folder: running statistics equal the batch ones."""

import os

from conftest import TEST11_LINES
from rankwalk.streaming import (read_adjacency_stream, running_degree_stats, running_out_degree,
                                start_to_memory)


def test_running_stats_over_arriving_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(TEST11_LINES[:5]) + "\n")
    records = read_adjacency_stream(spark, src)
    q1 = start_to_memory(running_degree_stats(records), "adj_stats")
    q2 = start_to_memory(running_out_degree(records), "adj_degree")
    try:
        q1.processAllAvailable()
        q2.processAllAvailable()
        first = spark.table("adj_stats").first()
        assert (first["records"], first["links"]) == (5, 12)
        with open(os.path.join(src, "b.txt"), "w") as f:
            f.write("\n".join(TEST11_LINES[5:]) + "\n")
        q1.processAllAvailable()
        q2.processAllAvailable()
        row = spark.table("adj_stats").first()
        assert (row["records"], row["links"], row["avg_out_degree"]) == (10, 20, 2.0)
        deg = {r["id"]: r["out_degree"] for r in spark.table("adj_degree").collect()}
        assert deg["5"] == 5 and deg["6"] == 3 and len(deg) == 10
    finally:
        q1.stop()
        q2.stop()
