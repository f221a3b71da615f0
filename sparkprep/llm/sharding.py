"""Contiguous shards of nearly equal bytes from global prefix sums.

Only (id, size, checksum) rows move. They are range-partitioned and sorted by
id; one aggregate gives each partition's total, a prefix sum over those
totals (one row per partition) gives where each partition starts, and a
running sum inside the partition does the rest. A row belongs to the shard in
which the middle of its bytes falls when the grand total is cut at equal
targets, so shards are contiguous in id order and each is at most one row
away from its target. DataFrame functions only.

Ids order the rows (null first); equal ids are ordered by checksum and size,
so only rows equal in all three are interchangeable. A null text has no
bytes. A row larger than a whole target leaves the shards it spans empty. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SHARDS = 40
ROW_OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, *, shards: int = SHARDS, overhead: int = ROW_OVERHEAD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and the gapless slot in it."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    order = ["doc_id", "text_crc32", "size"]
    ranged = cut_lineage(
        docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
                    F.crc32(text).alias("text_crc32"))
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("_pid", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, whatever the size of the data
    starts = ranged.groupBy("_pid").agg(F.sum("size").alias("_b"), F.count("*").alias("_n")).select(
        "_pid", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b0"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.sum("_b").over(Window.orderBy(F.lit(1)).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"))
    inside = Window.partitionBy("_pid").orderBy("_seq")
    placed = (ranged.repartitionByRange("_pid")
              .withColumn("_before", F.sum("size").over(inside) - F.col("size"))
              .withColumn("_row", F.row_number().over(inside))
              .join(F.broadcast(starts), "_pid")
              .withColumn("shard", F.expr(
                  f"cast(least({shards - 1}, ((2 * (_b0 + _before) + size) * {shards}) div (2 * _total)) as int)"))
              .withColumn("_rank", F.col("_n0") + F.col("_row")))
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))  # ``shards`` rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot"))
