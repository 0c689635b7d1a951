"""Scale guards over every registered query's physical plan: no cartesian
product or nested-loop join, and every parquet scan reads only the columns
the query needs (column pruning reaches the scan)."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

from rankwalk.plans.queries import QUERIES as OWN

QUERIES = {name: f for name, f in entry.queries().items() if name in OWN}
# Columns no registered query needs; a scan reading them would mean pruning failed.
UNUSED = {"l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
          "l_linestatus", "l_shipdate", "o_orderstatus", "o_totalprice", "o_orderdate",
          "o_orderpriority", "c_nationkey", "c_acctbal", "c_mktsegment", "p_brand",
          "p_type", "p_size", "p_retailprice", "s_nationkey", "s_acctbal", "url",
          "value", "props"}


def plan_nodes(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        root = df._jdf.queryExecution().executedPlan()
        nodes, todo = [], [root]
        while todo:
            node = todo.pop()
            nodes.append((node.nodeName(), node.simpleString(2000)))
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
            if node.nodeName() == "InMemoryTableScan":
                todo.append(node.relation().cachedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return nodes


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_plan_is_scale_safe(spark, name):
    nodes = plan_nodes(QUERIES[name](spark, SF_SMALL))
    names = {n for n, _ in nodes}
    assert not names & {"CartesianProduct", "BroadcastNestedLoopJoin"}, name
    for node_name, text in nodes:
        if node_name.startswith("Scan parquet") or "FileScan parquet" in text:
            m = re.search(r"ReadSchema: struct<([^>]*)>", text)
            if m:
                cols = {c.split(":")[0] for c in m.group(1).split(",")}
                assert not cols & UNUSED, (name, cols & UNUSED)
