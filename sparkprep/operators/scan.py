"""Running aggregates over an order, optionally restarted per group.

A ``Window.partitionBy(g).orderBy(o)`` sends a whole group to one task; a
group may hold a third of the rows. ``grouped_scan`` instead:

1. range-partitions on (group, order, per-row tiebreak) so every task gets
   an even slice, even of one hot group, and checkpoints that layout once;
2. runs the running aggregate inside each (partition, group) slice;
3. sums up each slice into a summary table (one row per partition and
   group it touches) and turns it into carries with a window over the
   summary, whose groups hold at most one row per partition;
4. joins the carry back and combines it with the local value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_PID, _MONO, _TB = "_gs_pid", "_gs_mono", "_gs_tb"

_LOCAL = {
    "sum": lambda c: F.sum(c),
    "max": lambda c: F.max(c),
    "min": lambda c: F.min(c),
    "count": lambda c: F.count(c),
}
_CARRY = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}


def _combine(fn, carry, local):
    if fn in ("sum", "count"):
        return F.coalesce(carry, F.lit(0)) + local
    if fn == "max":
        return F.greatest(carry, local)
    return F.least(carry, local)


def _order_cols(order_by):
    return [F.col(c).asc() if isinstance(c, str) else c for c in order_by]


def grouped_scan(df: DataFrame, partition_by, order_by, aggs: dict,
                 num_partitions: int | None = None) -> DataFrame:
    """Add prefix aggregates (``ROWS UNBOUNDED PRECEDING .. CURRENT ROW``).

    ``aggs`` maps an output column to ``(fn, column)`` with fn one of
    ``sum``, ``max``, ``min``, ``count``. Use ``(\"count\", F.lit(1))`` for a
    row number inside the group.
    """
    group = list(partition_by)
    order = [F.col(g).asc() for g in group] + _order_cols(order_by) + [F.col(_TB).asc()]
    ranged = (df.withColumn(_TB, F.monotonically_increasing_id())
                .repartitionByRange(*([num_partitions] if num_partitions else []), *order)
                .sortWithinPartitions(*order)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MONO, F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)

    w_local = (Window.partitionBy(_PID, *group).orderBy(_MONO)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[
        _LOCAL[fn](F.col(c) if isinstance(c, str) else c).over(w_local).alias(f"_loc_{out}")
        for out, (fn, c) in aggs.items()])

    summary = ranged.groupBy(_PID, *group).agg(*[
        _LOCAL[fn](F.col(c) if isinstance(c, str) else c).alias(f"_tot_{out}")
        for out, (fn, c) in aggs.items()])
    w_carry = (Window.partitionBy(*group).orderBy(_PID)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = summary.select(
        F.col(_PID).alias("_c_pid"), *[F.col(g).alias(f"_c_{g}") for g in group],
        *[_CARRY[fn](f"_tot_{out}").over(w_carry).alias(f"_car_{out}")
          for out, (fn, _) in aggs.items()])

    # only the first group of a partition can go on from the one before: at
    # most one carry row per partition, so they are broadcast
    some = reduce(lambda a, b: a | b, [F.col(f"_car_{out}").isNotNull() for out in aggs])
    cond = [F.col(_PID) == F.col("_c_pid")] + [
        F.col(g).eqNullSafe(F.col(f"_c_{g}")) for g in group]
    joined = local.join(F.broadcast(carry.where(some)), reduce(lambda a, b: a & b, cond), "left")
    result = joined.select(
        *[F.col(c) for c in df.columns],
        *[_combine(fn, F.col(f"_car_{out}"), F.col(f"_loc_{out}")).alias(out)
          for out, (fn, _) in aggs.items()])
    return result
