"""Length buckets of least padding, and token-budget batches inside them.

A document's length is its number of words.  The global histogram counts
lengths in log-linear cells (exact below 256, then 128 cells a power of two),
so it has at most a few thousand cells however many documents there are; with
each cell's longest length and sum of lengths, dynamic programming over the
cells finds the ``buckets`` bucket limits that minimise the total padding
(each document padded to its bucket's longest).  Ties go to the lower limit.

In a bucket, documents in the order of doc_id fill batches of
budget // limit rows (at least one), so that a padded batch stays within the
token budget; a document longer than the budget is a batch of its own and is
never cut.  The row numbers in a bucket come from per-partition totals, so a
bucket may hold any share of the documents.

Cases: null and empty texts have length 0 and fall in the first bucket;
repeated rows are packed each; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import log_cell, materialise, with_global_position
from .textkernel import pieces

EXACT_BITS = 8


@F.arrow_udf(T.LongType())
def n_words(texts: pa.Array) -> pa.Array:
    found = [np.diff(p.words) for p in pieces(texts)]
    return pa.array(np.concatenate(found).astype(np.int64) if found else [], pa.int64())


def bucket_limits(count: np.ndarray, total: np.ndarray, longest: np.ndarray, buckets: int) -> list[int]:
    """Limits (ascending) of at most ``buckets`` runs of cells with the least
    sum of count * limit - total; the arrays hold the cells in order."""
    n = len(count)
    if not n:
        return []
    # Whole numbers of any size where the padding could leave 64 bits.
    most = 2 * int(count.sum()) * int(longest.max()) + 1
    kind = np.int64 if most < 2**62 else object
    count, total, longest = (x.astype(kind) for x in (count, total, longest))
    counts, totals = (np.concatenate((np.zeros(1, dtype=kind), np.cumsum(x))) for x in (count, total))
    k_max = min(buckets, n)
    cost = np.full((k_max + 1, n + 1), most, dtype=kind)
    came = np.zeros((k_max + 1, n + 1), dtype=np.int64)
    cost[0, 0] = 0
    for k in range(1, k_max + 1):
        for j in range(k, n + 1):
            ways = cost[k - 1, :j] + (counts[j] - counts[:j]) * longest[j - 1] - (totals[j] - totals[:j])
            came[k, j] = i = int(np.argmin(ways))
            cost[k, j] = ways[i]
    out, j = [], n
    for k in range(k_max, 0, -1):
        out.append(int(longest[j - 1]))
        j = int(came[k, j])
    return out[::-1]


def packed(docs: DataFrame, buckets: int = 8, budget: int = 16384) -> DataFrame:
    """Per document: doc_id, n_tokens, bucket (from 0), bucket_limit,
    batch (from 0 in its bucket), slot (from 0 in its batch)."""
    lengths = materialise(docs.select("doc_id", n_words("text").alias("n_tokens")), "lengths")
    cells = (lengths.groupBy(log_cell(F.col("n_tokens"), EXACT_BITS).alias("cell"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("total"), F.max("n_tokens").alias("longest"))
             .orderBy("cell").collect())
    limits = bucket_limits(*(np.array([r[c] for r in cells], dtype=np.int64) for c in ("n", "total", "longest")), buckets)
    limit_array = F.array(*[F.lit(x).cast("bigint") for x in limits]) if limits else F.array().cast("array<bigint>")
    placed = lengths.withColumn("bucket", F.size(F.filter(limit_array, lambda x: x < F.col("n_tokens"))))
    placed = placed.withColumn("one", F.lit(1).cast("bigint"))
    placed = with_global_position(placed, ["doc_id", "n_tokens"], {"nr": "one"}, "bucket-rows", group="bucket")
    limit = F.element_at(limit_array, F.col("bucket") + 1)
    rows = F.greatest(F.floor(F.lit(budget) / F.greatest(limit, F.lit(1))), F.lit(1)).cast("bigint")
    return placed.select("doc_id", "n_tokens", "bucket", limit.alias("bucket_limit"),
                         F.floor(F.col("nr") / rows).cast("bigint").alias("batch"), (F.col("nr") % rows).alias("slot"))
