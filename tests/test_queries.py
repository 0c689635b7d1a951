"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01), and the flagship entry."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

from rankwalk.plans.queries import QUERIES as OWN

QUERIES = {name: f for name, f in entry.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}
TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events", "pages"]


def canon(cols, rows):
    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return repr(v)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_but_the_listing_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == {"source_inventory"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(ocols, orows)


def test_source_inventory_rows(spark):
    rows = QUERIES["source_inventory"](spark, SF_SMALL).collect()
    assert len(rows) == len([f for f in os.listdir(SF_SMALL) if f.endswith(".parquet")])


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["id", "title", "rank"]
    assert len(rows) == 20
    ranks = [r["rank"] for r in rows]
    assert ranks == sorted(ranks, reverse=True)
