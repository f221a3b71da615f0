"""Scalar statistics as distributed jobs.

Exact quantiles: Spark's ``percentile``/``median``/``mode`` aggregates keep
a map of every distinct value in one final task. Here the distinct values
are counted, range-sorted across all tasks with running counts, and only the
two rows that bracket each requested position are picked out, then
interpolated linearly (``lo + (hi - lo) * frac``, position ``q * (n - 1)``), as pandas,
numpy and SQL ``quantile_cont`` do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import global_rank


def fetch_row(agg: DataFrame) -> dict:
    """Run a 1-row aggregate once and return its values as typed literal
    Columns. Used when several statistics of one aggregate enter a plan:
    one scan of the data, instead of one scalar subquery (and scan) each."""
    row = agg.first()
    return {f.name: F.lit(row[f.name]).cast(f.dataType) for f in agg.schema.fields}


def to_long(df: DataFrame, cols, by=(), value_type: str = "double") -> DataFrame:
    """Unpivot ``cols`` into ``(by..., column, value)`` rows; nulls and NaN
    (pandas' missing value) are dropped."""
    by = list(by)
    packed = F.array(*[F.struct(F.lit(c).alias("column"),
                                F.col(c).cast(value_type).alias("value")) for c in cols])
    present = F.col("value").isNotNull()
    if value_type in ("double", "float"):
        present = present & ~F.isnan("value")
    return df.select(*by, F.inline(packed)).filter(present)


def ranked_values(df: DataFrame, cols) -> DataFrame:
    """``(column, value, n, cum)``: the distinct values of every column with
    their counts and the number of values up to and including each.

    The counts are one partial/final aggregate over the unpivoted columns;
    the running sum is a segmented scan over range partitions. One table
    answers distinct counts, extremes and any quantile, for any values
    (infinities and values of very different size included)."""
    from .scan import grouped_scan
    counts = to_long(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return grouped_scan(counts, ["column"], ["value"], {"cum": ("sum", "n")})


def exact_quantiles(df: DataFrame, cols, probs, by=()) -> DataFrame:
    """``(by..., column, prob, value)`` for every column and probability;
    columns without a value give no rows. With grouping keys (an unbounded
    number of groups) the rows themselves are ranked."""
    if not by:
        return quantiles_of(ranked_values(df, cols), probs)
    return _ranked_quantiles(df, cols, probs, by)


def quantiles_of(ranked: DataFrame, probs) -> DataFrame:
    """Quantiles from ``ranked_values``: the value at 0-based rank r is the
    one with cum - n <= r < cum. The wanted ranks are columns x
    probabilities rows, so they are broadcast and the table is streamed."""
    pos = F.col("prob") * (F.col("total") - 1)
    want = (ranked.groupBy("column").agg(F.sum("n").alias("total"))
                  .select("column", "total", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
                  .select("column", "prob", F.floor(pos).alias("lo"), F.ceil(pos).alias("hi"),
                          (pos - F.floor(pos)).alias("frac")))
    first = F.col("cum") - F.col("n")
    at = lambda r: F.max(F.when((first <= F.col(r)) & (F.col(r) < F.col("cum")), F.col("value")))
    got = (ranked.join(F.broadcast(want), "column")
                 .filter((first <= F.col("hi")) & (F.col("lo") < F.col("cum")))
                 .groupBy("column", "prob", "frac").agg(at("lo").alias("vlo"), at("hi").alias("vhi")))
    # equal ends are not interpolated: inf - inf would be NaN
    return got.select("column", "prob", F.when(F.col("vlo") == F.col("vhi"), F.col("vlo")).otherwise(
        F.col("vlo") + (F.col("vhi") - F.col("vlo")) * F.col("frac")).alias("value"))


def _ranked_quantiles(df: DataFrame, cols, probs, by) -> DataFrame:
    by = list(by)
    long = to_long(df, cols, by)
    ranked = global_rank(long, ["column", *by, "value"], "_rk")
    blocks = ranked.groupBy("column", *by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rk").alias("_start"))
    pos = F.col("prob") * (F.col("_n") - 1)
    targets = (blocks
               .select("column", *by, "_n", "_start",
                       F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
               .select("column", *by, "prob",
                       (F.col("_start") + F.floor(pos)).alias("_lo"),
                       (F.col("_start") + F.ceil(pos)).alias("_hi"),
                       (pos - F.floor(pos)).alias("_frac")))
    # ``targets`` has (columns x groups x probs) rows; the ranked table is
    # joined to it on the unique rank, so the large side is only streamed.
    picks = ranked.select("_rk", "value")
    lo = picks.select(F.col("_rk").alias("_lo"), F.col("value").alias("_vlo"))
    hi = picks.select(F.col("_rk").alias("_hi"), F.col("value").alias("_vhi"))
    out = targets.join(lo, "_lo").join(hi, "_hi")
    return out.select("column", *by, "prob",
                      (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac"))
                      .alias("value"))


def quantile_wide(df: DataFrame, cols, probs, names=None) -> DataFrame:
    """One row per column: ``column, <name_i>`` for each probability."""
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    long = exact_quantiles(df, cols, probs)
    return long.groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(n)
        for p, n in zip(probs, names)])


def scalar_quantile(df: DataFrame, col: str, prob: float) -> Column:
    """Exact quantile of one column as a scalar-subquery Column."""
    return exact_quantiles(df, [col], [prob]).select("value").scalar()


def corrected_skewness(c: str) -> Column:
    """Bias-corrected sample skewness G1 (pandas ``skew``; null under three
    values)."""
    n = F.count(c).cast("double")
    return F.try_divide(F.skewness(c) * F.sqrt(n * (n - 1)), n - 2)


def corrected_kurtosis(c: str) -> Column:
    """Bias-corrected excess kurtosis G2 (pandas ``kurt``; null under four
    values)."""
    n = F.count(c).cast("double")
    return F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6)


def mode_values(df: DataFrame, col: str) -> DataFrame:
    """All most-frequent non-null values (pandas ``mode``): a distributed
    count per value, then a filter on the maximum count (scalar subquery)."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    top = counts.select(F.max("n")).scalar()
    return counts.filter(F.col("n") == top).select(col)


def lowest_mode(df: DataFrame, col: str) -> Column:
    """The smallest most-frequent value, as a scalar subquery."""
    return mode_values(df, col).select(F.min(col)).scalar()
