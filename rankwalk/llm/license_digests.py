"""Prints the rows of ``licenses.DIGESTS`` for the licence files of a folder.

    python -m rankwalk.llm.license_digests /usr/share/common-licenses

A file gives the digests of its text as published, with a line for each
paragraph and on a single line, each also ended at "END OF TERMS AND
CONDITIONS"; where no copyright statement stands in the text they are equal.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import local_session
from .licenses import canonical, without_copyright

# File name -> license_id.
FILES = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
         "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
         "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
END = "END OF TERMS AND CONDITIONS"


def layouts(text: str) -> list[str]:
    """The text with its lines, a line a paragraph, and on one line."""
    every = []
    for t in [text] + ([text[:text.index(END) + len(END)]] if END in text else []):
        paragraphs = [" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", t)]
        every += [t, "\n\n".join(paragraphs), " ".join(paragraphs)]
    return every


def digests(spark: SparkSession, texts: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(license_id, first word, digests) of (license_id, text), as in DIGESTS."""
    rows = spark.createDataFrame([(i, x) for i, t in texts for x in layouts(t)], "id string, text string")
    rows = rows.select("id", canonical(without_copyright(F.col("text"))).alias("form")).where("form <> ''")
    rows = rows.groupBy("id", F.substring_index("form", " ", 1).alias("lead")).agg(F.array_join(F.sort_array(F.collect_set(F.md5(F.col("form").cast("binary")))), " ").alias("ds"))
    return [tuple(r) for r in rows.orderBy("id", "lead").collect()]


if __name__ == "__main__":
    folder = Path(sys.argv[1])
    for row in digests(local_session(2), [(i, (folder / f).read_text()) for f, i in FILES.items() if (folder / f).exists()]):
        print(f"    {row},")
