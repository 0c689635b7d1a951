"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dict_degree(links: Column | str) -> Column:
    """Sum of the counts of a link map (out-degree with multiplicity); 0 for
    an empty map."""
    col = F.col(links) if isinstance(links, str) else links
    return F.aggregate(F.map_values(col), F.lit(0).cast("bigint"),
                       lambda acc, x: acc + x.cast("bigint"))


def md5_bucket(col: Column, buckets: Column) -> Column:
    """Deterministic bucket of a string: first 32 bits of its md5, modulo
    ``buckets``.  md5 (not Spark's internal hash) so the same split can be
    reproduced outside Spark, e.g. by the SQL oracle."""
    return F.pmod(F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("bigint"), buckets)


def sample_key(id_col: Column | str, seed: int) -> Column:
    """Repeatable pseudo-random order: md5 of the id and the seed."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(col.cast("string"), F.lit(str(seed))))


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Index of ``x`` among ``bins`` equal-width bins over [lo, hi]; the last
    bin is closed.  ``hi`` must be above ``lo``."""
    width = (hi - lo) / F.lit(float(bins))
    return F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")


def report_line(rank: Column, id_col: Column, title: Column) -> Column:
    """``rank \\t| id \\t| title`` with rank as %f and the id right-aligned in
    10 characters."""
    return F.format_string("%f\t| %10s\t| %s", rank, id_col, F.coalesce(title, F.lit("")))


# The report's printed header, its rule and (above) line layout.
REPORT_RULE = "=" * 100
REPORT_HEADER = "{:10s}\t| {:10s}\t| {}".format("PageRank", "Page id", "Title")
