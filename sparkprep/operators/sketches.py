"""Approximate quantiles by mergeable sketches.

A KLL sketch of each slice (a day, a file, a partition key) is stored as a
row; slices are merged later without a second look at the data. With the
parameter ``k`` a rank error of about 2.3 / k ** 0.97 holds with 99 % confidence
(0.0133 at the default of 200, 0.0021 at 1350), before and after merging: a
returned median has a rank of 0.5 plus or minus that. Null and NaN
are missing. Use ``stats.exact_quantiles`` where the error matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_K = 200


def rank_error(k: int = DEFAULT_K) -> float:
    """Rank error at 99 % confidence."""
    return 2.296 / k ** 0.9723


def sketch_columns(df: DataFrame, cols, by=(), k: int = DEFAULT_K) -> DataFrame:
    """``(by..., column, sketch, n)``: one sketch a slice and column, built
    before the shuffle; store it as any other table."""
    by = list(by)
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    wide = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(value(c), F.lit(k)).alias(f"s{j}") for j, c in enumerate(cols)])
    packed = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{j}").alias("sketch")) for j, c in enumerate(cols)])
    return wide.select(*by, F.inline(packed)).select(*by, "column", "sketch", F.kll_sketch_get_n_double("sketch").alias("n"))


def merge_sketches(sketches: DataFrame, by=(), k: int = DEFAULT_K) -> DataFrame:
    """Sketches of coarser slices: ``(by..., column, sketch, n)``."""
    by = list(by)
    return sketches.groupBy(*by, "column").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")).select(
        *by, "column", "sketch", F.kll_sketch_get_n_double("sketch").alias("n"))


def approx_quantiles(sketches: DataFrame, probs, by=()) -> DataFrame:
    """``(by..., column, prob, value)``; a slice without values gives null."""
    by = list(by)
    at = [F.struct(F.lit(float(p)).alias("prob"), F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(
        F.col("sketch"), F.lit(float(p)))).alias("value")) for p in probs]
    return sketches.select(*by, "column", F.inline(F.array(*at)))


def approx_median(df: DataFrame, cols, k: int = DEFAULT_K) -> DataFrame:
    """``(column, median)`` of the whole table within ``rank_error(k)``."""
    return approx_quantiles(sketch_columns(df, cols, k=k), [0.5]).select("column", F.col("value").alias("median"))
