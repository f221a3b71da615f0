"""Global order without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one
task. The positional operators (equal-depth bins, positional splits,
positional ids, cursor bins) instead range-partition the data, number rows
inside each partition, and add per-partition offsets taken from a table
with one row per partition (its size is bounded by the partition count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_PID, _MONO, _N, _OFF, _TB = "_gr_pid", "_gr_mono", "_gr_n", "_gr_off", "_gr_tb"


def _as_order(cols) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c).asc() if isinstance(c, str) else c)
    return out


def global_rank(df: DataFrame, order_by, rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row in ``order_by``
    (row_number semantics; rows equal on every key are numbered in an
    arbitrary but fixed order).

    Plan: one range exchange (a per-row tiebreak lets the range partitioner
    split a hot key; without ``num_partitions`` AQE sizes and coalesces the
    ordered ranges from runtime statistics), a local sort, a reliable
    checkpoint so the numbering and the per-partition counts come from the
    very same partitions even if an executor is lost, then a broadcast join
    with one row per partition.
    """
    order = _as_order(order_by) + [F.col(_TB).asc()]
    ranged = (df.withColumn(_TB, F.monotonically_increasing_id())
                .repartitionByRange(*([num_partitions] if num_partitions else []), *order)
                .sortWithinPartitions(*order)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MONO, F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    # counts has one row per partition: a single-partition window over it is
    # bounded by the number of partitions, not by the data.
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum(_N).over(Window.orderBy(_PID).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias(_OFF))
    local = F.col(_MONO) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (ranged.join(F.broadcast(offsets), _PID)
                  .withColumn(rank_col, F.col(_OFF) + local + F.lit(1))
                  .drop(_PID, _MONO, _OFF, _TB))


def head_n(df: DataFrame, n: int, order_by) -> DataFrame:
    """First ``n`` rows in order: a TakeOrdered (top-k per task, merged)."""
    return df.orderBy(*_as_order(order_by)).limit(n)


def tail_n(df: DataFrame, n: int, order_by) -> DataFrame:
    """Last ``n`` rows in order: top-k of the reversed order."""
    rev = [F.col(c).desc() if isinstance(c, str) else c for c in order_by]
    return df.orderBy(*rev).limit(n)


def row_range(df: DataFrame, start: int, stop: int, order_by) -> DataFrame:
    """Rows at 0-based positions [start, stop) in order."""
    return df.orderBy(*_as_order(order_by)).offset(start).limit(stop - start)


def sort_multi(df: DataFrame, cols, ascending, position: str | None = None) -> DataFrame:
    """Mixed-direction sort (range exchange + local sort); ``position`` adds
    each row's 1-based place in the order."""
    order = [F.col(c).asc() if a else F.col(c).desc() for c, a in zip(cols, ascending)]
    return global_rank(df, order, position) if position else df.orderBy(*order)
