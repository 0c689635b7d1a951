"""URL rules as a sort-merge range join.

A host turned round label by label and closed with a dot ("com.example.www.")
makes "this host and all its subdomains" a prefix, hence an interval of the
sorted keys, and intervals of two rules nest or are apart.  URLs are
range-split on (host key, path, id) so that one busy host spreads over
partitions; a rule goes to each partition that its interval meets.  Every
partition is sorted with rules before URLs, and one sweep keeps a stack of the
rules whose interval holds the current key: a rule is pushed when it is met and
popped once the keys have left its prefix.  The rules on the stack are those
whose host fits; of those whose path also starts the URL's path the longest
wins (length of host and path; then the longer host; then block).

The stack holds at most one entry per label of the current host.

Cases: a null URL or one without "://" has empty host and path and meets no
rule; without a rule the verdict is the default; repeated rows are judged
alike; empty tables of pages or rules work; other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EVENTS = "part int, kind int, page_id long, host string, path string, key string, verdict string"
LEAST = -(2**63)
SCHEMA = "page_id long, host string, path string, rule string, verdict string"


def host_key(host: Column) -> Column:
    """Labels in reverse order, each closed with a dot; empty for no host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _parsed(pages: DataFrame) -> DataFrame:
    out = pages.select("page_id", F.col("url").alias("_url"))
    out = out.withColumn("_bare", F.when(F.instr("_url", "://") > 0, F.regexp_extract(
        F.expr("substring(_url, instr(_url, '://') + 3)"), r"^[^?#]*", 0)).otherwise(F.lit("")))
    out = out.withColumn("_host", F.regexp_extract("_bare", r"^[^/]*", 0))
    out = out.select("page_id", F.translate("_host", UPPER, LOWER).alias("host"), F.expr("substring(_bare, length(_host) + 1)").alias("path"))
    return out.withColumn("key", host_key(F.col("host")))


def _boundaries(urls: DataFrame, parts: int, per_part: int = 40) -> list[tuple[str, str, int]]:
    """Split points (key, path, page_id) from a hash-ordered sample of bounded
    size; they decide only the balance of the partitions, not the result."""
    pick = urls.select("key", "path", F.coalesce("page_id", F.lit(0)).alias("id"))
    rows = pick.orderBy(F.xxhash64("key", "path", "id")).limit(parts * per_part).collect()
    rows = sorted((r["key"], r["path"], r["id"]) for r in rows)
    return [rows[len(rows) * k // parts] for k in range(1, parts)] if rows else []


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, default: str = "allow") -> DataFrame:
    """Per page: page_id, host, path, rule (host + path, or null), verdict.

    rules: (verdict, host, path) rows, as a list or as a DataFrame with those
    columns; of equal rules block wins."""
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules or [], "verdict string, host string, path string")
    urls = _parsed(pages)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _boundaries(urls, parts)
    rules = rules.select("verdict", F.translate("host", UPPER, LOWER).alias("host"), "path")
    rules = rules.withColumn("key", host_key(F.col("host"))).select(
        F.lit(None).cast("long").alias("page_id"), "host", "path", "key", "verdict")
    urls = urls.select("page_id", "host", "path", "key", F.lit(None).cast("string").alias("verdict"))
    events = urls.mapInArrow(_placed(bounds, 1), EVENTS).unionByName(rules.mapInArrow(_placed(bounds, 0), EVENTS))
    events = events.repartition(parts, "part")
    return events.sortWithinPartitions("part", "key", "kind", "path", "page_id").mapInArrow(_sweep(default), SCHEMA)


def _placed(bounds: list[tuple[str, str, int]], kind: int):
    """Adds the partition: one for a URL, all that its interval meets for a rule."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.to_pydict()
            if kind:
                first = [bisect_right(bounds, (k, p, i or 0)) for k, p, i in zip(cols["key"], cols["path"], cols["page_id"])]
                last = first
            else:
                first = [bisect_right(bounds, (k, "", LEAST)) for k in cols["key"]]
                last = [bisect_right(bounds, (k + "\U0010ffff", "", LEAST)) for k in cols["key"]]
            take = np.repeat(np.arange(len(first)), np.array(last, dtype=int) - np.array(first, dtype=int) + 1)
            step = np.arange(len(take)) - np.searchsorted(take, take)
            part = pa.array((np.array(first, dtype=np.int32)[take] + step).astype(np.int32))
            kept = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([part, pa.array(np.full(len(take), kind, dtype=np.int32)), *kept.columns],
                                             ["part", "kind", *kept.schema.names])

    return place


def _sweep(default: str):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []          # stack: (key, host, {path: verdict}, path lengths, longest first)
        for batch in batches:
            out: list[tuple] = []
            cols = batch.to_pydict()
            for now, key, kind, page_id, host, path, verdict in zip(*(cols[c] for c in (
                    "part", "key", "kind", "page_id", "host", "path", "verdict"))):
                if now != part:
                    part, stack = now, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, []))
                    paths, lengths = stack[-1][2:]
                    if paths.get(path) != "block":
                        paths[path] = verdict
                    if len(path) not in lengths:
                        lengths.append(len(path))
                        lengths.sort(reverse=True)
                    continue
                best = None
                for _, rule_host, paths, lengths in stack:
                    hit = next((path[:n] for n in lengths if path[:n] in paths), None)
                    if hit is not None:
                        rule = (len(rule_host) + len(hit), len(rule_host), rule_host + hit, paths[hit])
                        best = max(best, rule) if best else rule
                out.append((page_id, host, path, best[2] if best else None, best[3] if best else default))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] + [pa.string()] * 4)],
                    ["page_id", "host", "path", "rule", "verdict"])

    return sweep
