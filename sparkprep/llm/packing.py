"""Optimal length buckets and token-budget batches.

1. The token count of each document (letter or digit runs and single marks,
   or a column the caller names) is cut into pieces of at most ``max_len``
   tokens, so every length is between 1 and ``max_len`` and the global
   histogram has at most ``max_len`` rows, however large the corpus.
2. Dynamic programming over that histogram chooses the ``buckets`` upper
   bounds with the least total padding: best(k, j) = min over i < j of
   best(k - 1, i) + cost(i, j), where cost pads all lengths in (i, j] to j.
3. Inside a bucket, pieces in (doc_id, piece) order form batches of
   floor(batch_tokens / bound) rows, so no batch exceeds the token budget.
   Positions come from counts per range partition and their prefix sums;
   only ids and lengths move, and no bucket is gathered in one task.

A null or empty text has no token and gives one row with piece 0, no tokens
and no bucket. Ties in doc_id are ordered by a hash of the text. A negative
or null length column counts as 0. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import saved

MAX_LEN = 2048
BUCKETS = 16
BATCH_TOKENS = 65_536
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


def token_count(text: Column) -> Column:
    """Runs of letters and digits, and single other marks."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def best_bounds(lengths: list[int], counts: list[int], buckets: int) -> tuple[list[int], int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding,
    and that padding. Bounds are lengths that occur; among equal costs the
    fewest buckets and the smallest bounds win."""
    order = np.argsort(lengths)
    x = np.asarray(lengths, np.int64)[order]
    c = np.asarray(counts, np.int64)[order]
    m = len(x)
    if not m:
        return [], 0
    rows = np.r_[0, np.cumsum(c)]
    tokens = np.r_[0, np.cumsum(c * x)]
    # best[j]: least padding of the j shortest lengths
    best = np.full(m + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    cuts, totals = [], []
    for _ in range(min(buckets, m)):
        nxt = best.copy()
        cut = np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            cost = best[:j] + x[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            i = int(np.argmin(cost))
            nxt[j], cut[j] = cost[i], i
        nxt[0] = 0
        cuts.append(cut)
        totals.append(int(nxt[m]))
        best = nxt
    k = int(np.argmin(totals))
    bounds, j = [], m
    for cut in reversed(cuts[:k + 1]):
        if j == 0:
            break
        bounds.append(int(x[j - 1]))
        j = int(cut[j])
    return bounds[::-1], totals[k]


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
         max_len: int = MAX_LEN, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """Per piece: doc_id, piece, first_token, n_tokens, bucket, bucket_len,
    batch (within the bucket) and slot (within the batch)."""
    if not 0 < max_len <= batch_tokens:
        raise ValueError("max_len must be positive and at most batch_tokens")
    n = F.greatest(F.coalesce(F.col(length_col), F.lit(0)).cast("long"), F.lit(0)) if length_col else token_count(
        F.col(text_col))
    lengths = saved(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_key"), n.alias("_n")))
    last = F.greatest(F.ceil(F.col("_n") / max_len) - 1, F.lit(0)).cast("int")
    pieces = (lengths.select("doc_id", "_key", "_n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
                     .withColumn("first_token", F.col("piece").cast("long") * max_len)
                     .withColumn("n_tokens", F.least(F.col("_n") - F.col("first_token"), F.lit(max_len)).cast("int")))
    # at most max_len rows
    histogram = pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()
    bounds, _ = best_bounds([r["n_tokens"] for r in histogram], [r["count"] for r in histogram], buckets)
    if not bounds:
        bounds = [max_len]
    steps = F.array(*[F.lit(b) for b in bounds])
    bucket = F.when(F.col("n_tokens") > 0, F.size(F.filter(steps, lambda b: b < F.col("n_tokens"))))
    order = ["bucket", "doc_id", "_key", "piece"]
    ranged = cut_lineage(pieces.withColumn("bucket", bucket).drop("_n")
                               .repartitionByRange(*order).sortWithinPartitions(*order)
                               .withColumn("_pid", F.spark_partition_id())
                               .withColumn("_seq", F.monotonically_increasing_id()))
    before = Window.partitionBy("bucket").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition and bucket it touches
    offsets = ranged.where("bucket is not null").groupBy("bucket", "_pid").agg(
        F.count("*").alias("_c"), F.min("_seq").alias("_s0")).select(
        "bucket", "_pid", "_s0", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c0"))
    rank = F.col("_c0") + F.col("_seq") - F.col("_s0")
    bound = F.try_element_at(steps, F.col("bucket") + 1)
    per_batch = F.floor(F.lit(batch_tokens) / F.col("bucket_len"))
    return (ranged.join(F.broadcast(offsets), ["bucket", "_pid"], "left")
                  .withColumn("bucket_len", bound)
                  .withColumn("batch", F.floor(rank / per_batch)).withColumn("slot", (rank % per_batch).cast("int"))
                  .select("doc_id", "piece", "first_token", "n_tokens", "bucket", "bucket_len", "batch", "slot"))
