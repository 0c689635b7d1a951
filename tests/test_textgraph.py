"""Adjacency text + index text -> titled top-k, end to end."""

import os

from conftest import TEST11_LINES, write_lines
from rankwalk.plans.textgraph import rank_adjacency_text, ranked_report_lines
from test_goldens import TEST11_GOLDEN


def test_rank_from_text_files(spark, tmp_dir):
    adj = write_lines(os.path.join(tmp_dir, "adj"), TEST11_LINES)
    idx = write_lines(os.path.join(tmp_dir, "idx"),
                      [f"Page {i}\t{i}\t0\t0" for i in range(1, 12)])
    top = rank_adjacency_text(spark, adj, idx, max_iter=20, k=3).collect()
    assert [(r["id"], r["title"]) for r in top] == [("2", "Page 2"), ("3", "Page 3"), ("5", "Page 5")]
    assert abs(top[0]["rank"] - TEST11_GOLDEN["2"]) < 1e-12
    lines = [r["line"] for r in ranked_report_lines(
        rank_adjacency_text(spark, adj, idx, max_iter=20, k=3)).collect()]
    assert lines[0] == "0.362064\t|          2\t| Page 2"


def test_rank_from_text_without_index(spark, tmp_dir):
    adj = write_lines(tmp_dir, TEST11_LINES)
    top = rank_adjacency_text(spark, adj, max_iter=20, k=11).collect()
    assert len(top) == 11 and all(r["title"] is None for r in top)
    assert abs(sum(r["rank"] for r in top) - 1.0) < 1e-12
