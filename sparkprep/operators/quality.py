"""Data-quality dimensions: completeness, validity, uniqueness, consistency,
first-digit (Benford) tests. All column metrics of a family run in one
aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import per_column

# Benford's law, expected share of first digit d is
# log10(1 + 1/d) * 100 percent, for d = 1..9; verdict threshold 15 points.
BENFORD_THRESHOLD = 15.0


def completeness(df: DataFrame, cols) -> DataFrame:
    """Share of non-null cells in percent (an empty string is present)."""
    one = df.agg(*[(F.count(c) * 100.0 / F.count(F.lit(1))).alias(f"completeness__{c}")
                   for c in cols])
    return per_column(one, cols, ["completeness"])


def validity(df: DataFrame, rules: dict) -> DataFrame:
    """Percent of non-null values satisfying ``rules[col]`` (a Column)."""
    one = df.agg(*[F.try_divide(F.count_if(F.coalesce(rule, F.lit(False))) * 100.0,
                                F.count(c)).alias(f"validity__{c}")
                   for c, rule in rules.items()])
    return per_column(one, list(rules), ["validity"])


def uniqueness(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Distinct non-null values / all rows, in percent (nulls count in the
    denominator only). ``approx`` uses HyperLogLog++ instead of an exact
    distinct count."""
    dc = F.approx_count_distinct if approx else F.count_distinct
    one = df.agg(*[(dc(c) * 100.0 / F.count(F.lit(1))).alias(f"uniqueness__{c}") for c in cols])
    return per_column(one, cols, ["uniqueness"])


def uniqueness_nonblank(df: DataFrame, col: str) -> DataFrame:
    """Distinct / count over values that are neither null nor ''."""
    nb = df.filter(F.col(col).isNotNull() & (F.col(col) != ""))
    return nb.agg(F.lit(col).alias("column"),
                  F.count_distinct(col).alias("n_distinct"),
                  F.count(F.lit(1)).alias("n_non_blank"),
                  F.try_divide(F.count_distinct(col) * 100.0, F.count(F.lit(1))).alias("uniqueness"))


def consistency_flag(recorded: Column, expected: Column) -> Column:
    """1 when equal, 0 otherwise (a null on either side is inconsistent)."""
    return F.coalesce(recorded == expected, F.lit(False)).cast("int")


def consistency_rate(df: DataFrame, recorded: Column, expected: Column) -> DataFrame:
    flag = consistency_flag(recorded, expected)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(flag).alias("n_consistent"),
                  (F.avg(flag) * 100).alias("consistency_rate"))


def first_digit(c: Column) -> Column:
    """First character of the value's text form as an int, null if it is
    not a digit ('-', '.'); 0.5 -> 0."""
    return F.substring(c.cast("string"), 1, 1).try_cast("int")


def benford_expected(spark) -> DataFrame:
    return (spark.range(1, 10).select(F.col("id").cast("int").alias("digit"))
            .withColumn("expected", F.log10(1 + 1 / F.col("digit")) * 100))


def first_digit_distribution(df: DataFrame, cols) -> DataFrame:
    """``(column, digit, observed)``: percent of non-null first digits
    (digit 0 stays in the denominator)."""
    packed = F.array(*[F.struct(F.lit(c).alias("column"), first_digit(F.col(c)).alias("digit"))
                       for c in cols])
    digits = df.select(F.inline(packed)).filter(F.col("digit").isNotNull())
    counts = digits.groupBy("column", "digit").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return (counts.join(totals, "column")
                  .select("column", "digit", (F.col("n") * 100.0 / F.col("total")).alias("observed")))


def benford_test(df: DataFrame, cols, threshold: float = BENFORD_THRESHOLD) -> DataFrame:
    """Per column and digit 1..9: observed vs expected percent, the column's
    L1 distance and whether it is below ``threshold``. Missing digits
    count as 0 (a left join from the nine expected digits)."""
    spark = df.sparkSession
    obs = first_digit_distribution(df, cols)
    grid = benford_expected(spark).withColumn(
        "column", F.explode(F.array(*[F.lit(c) for c in cols])))
    joined = (grid.join(obs, ["column", "digit"], "left")
                  .withColumn("observed", F.coalesce("observed", F.lit(0.0))))
    dist = joined.groupBy("column").agg(
        F.sum(F.abs(F.col("observed") - F.col("expected"))).alias("l1_distance"))
    return (joined.join(dist, "column")
                  .withColumn("follows_benford", F.col("l1_distance") < threshold))
