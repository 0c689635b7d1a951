"""Ranked reports: top-k, titles, formatted lines, Parquet round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import REPORT_HEADER, REPORT_RULE, report_line
from ..session import scratch_path


def topk(ranks: DataFrame, k: int = 20, value: str = "rank") -> DataFrame:
    """The ``k`` highest-ranked nodes, ties broken by id (bounded top-k)."""
    return ranks.orderBy(F.desc(value), F.asc("id")).limit(k)


def with_titles(top: DataFrame, titles: DataFrame, value: str = "rank", how: str = "inner") -> DataFrame:
    """Join a top-k frame with an (id, title) lookup, highest rank first.
    Ranked nodes without a title are left out; ``how="left"`` keeps them with
    a NULL title.

    The top-k side has at most k rows - a proven bound - so it is the side
    broadcast: the lookup (one row per page) is filtered by a broadcast semi
    join and never shuffled.
    """
    lookup = titles.join(F.broadcast(top.select("id")), "id", "left_semi").select("id", "title")
    return (top.join(lookup, "id", how)
               .select("id", "title", value)
               .orderBy(F.desc(value), F.asc("id")))


def ranked_lines(titled: DataFrame, value: str = "rank") -> DataFrame:
    """(position, line): ``rank \\t| id \\t| title`` per ranked node, position
    1 = highest.  Runs on a top-k frame (k rows), so the un-partitioned
    numbering window handles k rows only."""
    pos = F.row_number().over(Window.orderBy(F.desc(value), F.asc("id")))
    return titled.select(pos.alias("position"),
                         report_line(F.col(value), F.col("id"), F.col("title")).alias("line"))


def report_text(titled: DataFrame) -> str:
    """Header, a rule of ``=`` and one line per ranked node, as printed text.
    For printing a top-k frame, whose k bounds the lines; a ranking of any
    length goes through :func:`write_report`."""
    rows = ranked_lines(titled).orderBy("position").collect()
    return "\n".join([REPORT_HEADER, REPORT_RULE] + [r["line"] for r in rows])


def write_report(titled: DataFrame, path: str, value: str = "rank") -> None:
    """Every ranked node as a report line in a text sink, header and rule
    first: the files in name order are the report.  A distributed sort, no
    limit on the number of lines."""
    lines = titled.select(F.lit(1).alias("_part"), F.col(value).alias("_rank"), F.col("id").alias("_id"),
                          report_line(F.col(value), F.col("id"), F.col("title")).alias("value"))
    head = titled.sparkSession.createDataFrame(
        [(0, 1.0, "", REPORT_HEADER), (0, 0.0, "", REPORT_RULE)], "_part int, _rank double, _id string, value string")
    (head.unionByName(lines).orderBy("_part", F.desc("_rank"), "_id").select("value").write.text(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def parquet_roundtrip(df: DataFrame, name: str = "topk") -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder
    (overwrite mode) and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_parquet(df, path)
    return spark.read.parquet(path)
