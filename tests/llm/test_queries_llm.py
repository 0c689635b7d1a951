"""Registered corpus queries against their DuckDB SQL, and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from rankwalk.llm import queries
from rankwalk.llm.textkernel import pieces, shingle_sets, windows

SF = "/root/testdata/sf0.001"
SQL = queries.oracles() | {"pipeline": corpus_pipeline.ORACLE_SQL}
QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    out = QUERIES[name](spark, SF)
    found = con.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(out.columns)
    assert sorted(repr(tuple(r)) for r in out.select(*columns).collect()) == sorted(map(repr, found.fetchall()))


def test_kernel_pieces_agree_with_regex():
    import re

    import pyarrow as pa
    texts = ["", None, "a", " é b\tb\x0bc ", "x" * 50, "\n\n", "end "]
    found = []
    for piece in pieces(pa.array(texts)):
        for a, b in zip(piece.words[:-1], piece.words[1:]):
            found.append([piece.data[s:e].tobytes().decode() for s, e in zip(piece.starts[a:b], piece.ends[a:b])])
        assert len(list(shingle_sets(piece, 5))) == piece.n and len(windows(piece.word_hashes(), 99)) == 0
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
