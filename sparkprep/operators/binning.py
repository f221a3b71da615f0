"""Equal-width and equal-depth binning and bin smoothing.

Per-bin tables (counts, means, minima) have at most ``k`` (or ``n div k``
+ 1) rows and are broadcast back; no window runs over a whole bin, since
one bin may hold most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import global_rank
from .stats import fetch_row


def _range(df: DataFrame, col: str):
    r = fetch_row(df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")))
    return r["lo"], r["hi"]


def bin_boundaries(df: DataFrame, col: str, k: int) -> DataFrame:
    """Inner cut points ``min + i * w`` for i = 1..k-1, w = (max-min)/k."""
    lo, hi = _range(df, col)
    w = (hi - lo) / k
    return (df.sparkSession.range(1, k).select(F.col("id").cast("int").alias("i"))
              .withColumn("boundary", lo + F.col("i") * w))


def textbook_bin(x: Column, lo: Column, w: Column, k: int) -> Column:
    """Upper-inclusive equal-width bin: (lo + t w, lo + (t+1) w], the first
    bin also holds the minimum; clamped to k-1. A null has no bin; without
    spread every value is in bin 0."""
    t = F.coalesce(F.ceil(F.try_divide(x - lo, w)) - 1, F.lit(0))
    return F.when(x.isNotNull(), F.least(F.greatest(t, F.lit(0)), F.lit(k - 1)).cast("int"))


def _without_bin(df: DataFrame, col: str, out: str) -> DataFrame:
    """Rows whose value is null, with a null bin."""
    return df.filter(F.col(col).isNull()).withColumn(out, F.lit(None).cast("int"))


def equal_width_bins(df: DataFrame, col: str, k: int, mode: str = "textbook",
                     out: str = "bin") -> DataFrame:
    """Assign each row an equal-width bin.

    ``textbook``: upper-inclusive bins. ``cursor``: the result of a cursor
    that walks the sorted values and opens only ONE new bin per value that
    overflows the current upper edge, so a value after an empty bin lands a
    bin too low. With i the 0-based sorted position and t the textbook bin,
    cursor bin = min(t, i + min over non-empty bins p < t of (p+1 - S_p)),
    S_p = number of values in bins 0..p: a global rank plus a k-row table.
    """
    lo, hi = _range(df, col)
    w = (hi - lo) / k
    t = textbook_bin(F.col(col), lo, w, k)
    if mode == "textbook":
        return df.withColumn(out, t)
    if mode != "cursor":
        raise ValueError(mode)
    base = df.filter(F.col(col).isNotNull()).withColumn("_t", t)
    counts = base.groupBy("_t").agg(F.count(F.lit(1)).alias("_n"))
    cum = F.sum("_n").over(Window.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0))
    per_bin = counts.select("_t", (F.col("_t") + 1 - cum).alias("_c"))
    # k rows at most: a single-partition window over them is bounded by k.
    pref = per_bin.select("_t", F.min("_c").over(
        Window.orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)).alias("_m"))
    all_bins = df.sparkSession.range(k).select(F.col("id").cast("int").alias("_t"))
    # carry the prefix minimum over empty bins
    mins = all_bins.join(pref, "_t", "left").select(
        "_t", F.min("_m").over(Window.orderBy("_t").rowsBetween(
            Window.unboundedPreceding, 0)).alias("_m"))
    ranked = global_rank(base, [col], "_rk")
    binned = (ranked.join(F.broadcast(mins), "_t")
                    .withColumn(out, F.coalesce(F.least(F.col("_t"), F.col("_rk") - 1 + F.col("_m")),
                                                F.col("_t")).cast("int"))
                    .drop("_t", "_rk", "_m"))
    return binned.unionByName(_without_bin(df, col, out))


def smooth_by_mean(df: DataFrame, col: str, bin_col: str = "bin", out: str = "smoothed",
                   digits: int = 6) -> DataFrame:
    """Replace a value by its bin mean (rounded)."""
    means = df.groupBy(F.col(bin_col).alias("_b")).agg(F.round(F.avg(col), digits).alias(out))
    # as many rows as bins; a bin column of any size is joined as AQE sees fit
    return df.join(means, F.col(bin_col).eqNullSafe(F.col("_b"))).drop("_b")


def smooth_width_boundary(df: DataFrame, col: str, k: int, bin_col: str = "bin",
                          out: str = "smoothed") -> DataFrame:
    """Replace a value by the nearer edge of its equal-width bin (tie ->
    lower edge). Works on textbook or cursor bins in ``bin_col``."""
    lo, hi = _range(df, col)
    w = (hi - lo) / k
    lower = lo + F.col(bin_col) * w
    upper = lower + w
    x = F.col(col)
    return df.withColumn(out, F.when(F.abs(x - lower) <= F.abs(x - upper), lower).otherwise(upper))


def equal_depth_bins(df: DataFrame, col: str, k: int, out: str = "bin") -> DataFrame:
    """Chunks of ``n div k`` sorted values; a remainder opens extra bins
    (so there can be more than k). Needs n >= k. A null has no bin."""
    base = df.filter(F.col(col).isNotNull())
    ranked = global_rank(base, [col], "_rk")
    # the row count is the largest rank: read from the ranked (checkpointed)
    # rows instead of scanning the input again
    n = ranked.select(F.max("_rk")).scalar()
    size = F.greatest(F.floor(n / k), F.lit(1))
    binned = ranked.withColumn(out, F.floor((F.col("_rk") - 1) / size).cast("int")).drop("_rk")
    return binned.unionByName(_without_bin(df, col, out))


def smooth_depth_boundary(df: DataFrame, col: str, bin_col: str = "bin",
                          out: str = "smoothed") -> DataFrame:
    """Replace a value by the nearer of its bin's min and max (tie -> min)."""
    edges = df.groupBy(F.col(bin_col).alias("_b")).agg(F.min(col).alias("_bmin"), F.max(col).alias("_bmax"))
    x = F.col(col)
    return (df.join(edges, F.col(bin_col).eqNullSafe(F.col("_b")))
              .withColumn(out, F.when(F.abs(x - F.col("_bmin")) <= F.abs(x - F.col("_bmax")),
                                      F.col("_bmin")).otherwise(F.col("_bmax")))
              .drop("_b", "_bmin", "_bmax"))
