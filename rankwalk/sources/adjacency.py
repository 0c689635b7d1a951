"""Adjacency-text source: one line per node, ``node \\t {'dst': count, ...}``.

The link dictionary is a Python dict literal with single-quoted keys and
integer counts; Spark's JSON reader accepts it as-is (single quotes are
allowed by default), so parsing stays a JVM-side ``from_json`` - no Python
worker, no UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINKS_TYPE = "map<string,bigint>"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text line scan: DataFrame(value STRING), one row per line."""
    return spark.read.text(path)


def parse_adjacency(lines: DataFrame, column: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """Lines -> (node STRING, links MAP<STRING,BIGINT>).

    A line must split on tab into exactly two fields and the second must be
    a dict literal of int counts.  ``FAILFAST`` stops the job on the first
    bad line (as the line-by-line literal parser would); ``PERMISSIVE``
    keeps going and returns a NULL ``links`` for bad lines - use
    :func:`split_rejects` to route them aside.  Duplicate keys inside one
    dict keep the last value.
    """
    mode = mode.upper()
    fields = F.split(F.col(column), "\t")
    n_fields = F.size(fields)
    raw = fields.getItem(1)
    if mode == "FAILFAST":
        checked = F.when(n_fields == 2, raw).otherwise(
            F.raise_error(F.concat(F.lit("malformed adjacency line (expected 2 tab-separated fields): "),
                                   F.substring(F.col(column), 1, 200))))
        links = F.from_json(checked, LINKS_TYPE, {"mode": "FAILFAST"})
    else:
        links = F.when(n_fields == 2, F.from_json(raw, LINKS_TYPE, {"mode": "PERMISSIVE"}))
    parsed = lines.select(fields.getItem(0).alias("node"), links.alias("links"),
                          F.col(column).alias("_line"))
    return parsed.select("node", _last_key_wins("links").alias("links"), "_line")


def _last_key_wins(links: str) -> F.Column:
    """Drop repeated keys of a parsed dict, keeping the last value (the JSON
    reader keeps every occurrence).  Maps without repeats pass unchanged; a
    map with repeats is sorted by (key, reversed position) - O(k log k) - and
    the first entry of each key run is kept."""
    m = F.col(links)
    indexed = F.transform(F.map_entries(m), lambda e, i: F.struct(
        e["key"].alias("k"), (-i).alias("p"), e["value"].alias("v")))
    ordered = F.array_sort(indexed)
    kept = F.filter(ordered, lambda e, i: (i == 0) | (F.element_at(ordered, i)["k"] != e["k"]))
    deduped = F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"], e["v"])))
    no_repeats = F.size(F.array_distinct(F.map_keys(m))) == F.size(m)
    return F.when(m.isNull() | no_repeats, m).otherwise(deduped)


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected lines) of a PERMISSIVE parse."""
    good = parsed.where(F.col("links").isNotNull()).select("node", "links")
    bad = parsed.where(F.col("links").isNull()).select(F.col("_line").alias("line"))
    return good, bad


def read_adjacency(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """Read adjacency text files -> (node, links)."""
    return parse_adjacency(read_lines(spark, path), mode=mode).select("node", "links")


def _dict_key(key) -> F.Column:
    """A dict key as text: ``'id'`` like the source format, or - when the id
    holds a quote, a backslash or a control character - a JSON-escaped
    ``"id"``, which both this reader and a Python literal parser accept."""
    plain = ~key.rlike(r"""['"\\\p{Cntrl}]""")
    escaped = F.regexp_extract(F.to_json(F.array(key)), r"^\[(.*)\]$", 1)
    return F.when(plain, F.concat(F.lit("'"), key, F.lit("'"))).otherwise(escaped)


def render_adjacency(edges: DataFrame) -> DataFrame:
    """Edge table (src, dst, cnt) -> adjacency lines (value STRING), one record
    a source with all its targets in order, whatever their number: the format
    keeps a node's list on one line, so a task that writes or reads it holds
    that line."""
    lists = edges.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("dst", "cnt"))).alias("_l"))
    body = F.array_join(F.transform("_l", lambda e: F.concat(_dict_key(e["dst"]), F.lit(": "),
                                                            e["cnt"].cast("string"))), ", ")
    return lists.select(F.concat(F.col("src"), F.lit("\t{"), body, F.lit("}")).alias("value"))


def render_records(records: DataFrame) -> DataFrame:
    """(node, links map) -> lines; empty maps render as ``{}``."""
    body = F.array_join(F.transform(F.sort_array(F.map_entries("links")),
                                    lambda e: F.concat(_dict_key(e["key"]), F.lit(": "),
                                                       e["value"].cast("string"))), ", ")
    return records.select(F.concat(F.col("node"), F.lit("\t{"), body, F.lit("}")).alias("value"))
