"""Association between columns: contingency tables, chi-square with
Yates correction on 2x2 tables, Cramer's V, Pearson correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import numeric_columns


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table ``(a, b, n)``; rows with a null are dropped."""
    return (df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
              .groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))


def crosstab_wide(df: DataFrame, a: str, b: str, values) -> DataFrame:
    """Wide form: one column per given value of ``b`` (the caller names them,
    as they make the schema), zeros for empty cells."""
    ct = crosstab(df, a, b)
    pv = ct.groupBy(a).pivot(b, values).agg(F.first("n"))
    return pv.na.fill(0)


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson chi-square of the contingency table of ``a`` x ``b``.

    Without correction the statistic needs only the non-empty cells:
    sum over all cells of (O-E)^2/E = sum over non-empty cells of O^2/E - N.
    With one degree of freedom (2x2) Yates' correction (|O-E| reduced by
    min(0.5, |O-E|)) needs all four cells; the four-cell grid is built from
    the two column totals, gathered only when there are exactly two.
    """
    from ..session import cut_lineage
    # the contingency table (rows x columns of categories) is read by
    # several statistics: materialise it once instead of rescanning the data
    ct = cut_lineage(crosstab(df, a, b))
    rows = ct.groupBy(a).agg(F.sum("n").alias("r"))
    cols = ct.groupBy(b).agg(F.sum("n").alias("c"))
    n_total = ct.select(F.sum("n")).scalar()
    n_rows = rows.select(F.count(F.lit(1))).scalar()
    n_cols = cols.select(F.count(F.lit(1))).scalar()
    cells = ct.join(rows, a).join(cols, b).withColumn(
        "e", F.col("r") * F.col("c") / n_total)
    plain = cells.select(F.sum(F.col("n") * F.col("n") / F.col("e")).alias("s")).select(
        (F.col("s") - n_total).alias("chi2"))

    # 2x2 only: every (row, column) cell, observed count 0 when absent.
    two_cols = cols.filter(n_cols == 2).select(
        F.sort_array(F.collect_list(F.struct(F.col(b).alias("k"), F.col("c").alias("c")))).alias("cs")
    ).scalar()
    grid = (rows.filter((n_rows == 2) & (n_cols == 2))
                .select(a, "r", F.inline(two_cols))
                .withColumnRenamed("k", b))
    full = grid.join(ct, [a, b], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    e = F.col("r") * F.col("c") / n_total
    diff = F.abs(F.col("n") - e)
    yates = full.select(F.sum(F.pow(diff - F.least(F.lit(0.5), diff), 2) / e).alias("chi2"))
    use_yates = (n_rows == 2) & (n_cols == 2)
    stat = F.when(use_yates, yates.scalar()).otherwise(plain.scalar())
    dof = (n_rows - 1) * (n_cols - 1)
    return ct.sparkSession.range(1).select(
        stat.alias("chi2"), dof.alias("dof"), n_total.alias("n"),
        n_rows.alias("n_rows"), n_cols.alias("n_cols"))


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """sqrt(chi2 / (n * (min(rows, cols) - 1))); null where one of the columns
    has a single category."""
    cs = chi_square(df, a, b)
    return cs.select("chi2", "n", F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (
        F.least("n_rows", "n_cols") - 1))).alias("cramers_v"))


def _corr(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are present; null where one
    of them has no spread (pandas: NaN)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    dev = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), dev)


def corr_pair(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation over rows where both are present."""
    return df.agg(_corr(x, y).alias("corr"))


def corr_matrix(df: DataFrame, cols=None) -> DataFrame:
    """All pairs (both orders and the diagonal) in long form
    ``(a, b, corr)``; one aggregate pass over the data for the k(k-1)/2
    distinct pairs."""
    cols = cols or numeric_columns(df)
    pairs = list(combinations(cols, 2))
    one = df.agg(*[_corr(x, y).alias(f"{i}") for i, (x, y) in enumerate(pairs)],
                 *[F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"d{i}") for i, c in enumerate(cols)])
    entries = []
    for i, (x, y) in enumerate(pairs):
        entries.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"{i}").alias("corr")))
        entries.append(F.struct(F.lit(y).alias("a"), F.lit(x).alias("b"), F.col(f"{i}").alias("corr")))
    for i, c in enumerate(cols):
        entries.append(F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.col(f"d{i}").alias("corr")))
    return one.select(F.inline(F.array(*entries)))


def corr_drop_candidates(df: DataFrame, cols, threshold: float = 0.9) -> DataFrame:
    """Columns whose absolute correlation with an EARLIER column exceeds
    ``threshold`` (upper triangle of the matrix, column order as given)."""
    order = {c: i for i, c in enumerate(cols)}
    cm = corr_matrix(df, cols)
    pos = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    return (cm.filter((pos[F.col("a")] < pos[F.col("b")]) & (F.abs("corr") > threshold))
              .select(F.col("b").alias("column")).distinct())


def pmi(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pointwise mutual information ln(p(x,y) / (p(x) p(y))) of co-occurring
    values, from counts: (x, y) cells, x and y marginals, and the total."""
    from ..session import cut_lineage
    # the (x, y) counts feed three branches: materialise them once
    xy = cut_lineage(df.groupBy(x, y).agg(F.count(F.lit(1)).alias("_nxy")))
    # materialised marginals: plain scans on both sides of the joins, so a
    # value that occurs with most others is split over several tasks
    nx = cut_lineage(xy.groupBy(x).agg(F.sum("_nxy").alias("_nx")))
    ny = cut_lineage(xy.groupBy(y).agg(F.sum("_nxy").alias("_ny")))
    n = xy.select(F.sum("_nxy")).scalar()
    j = xy.join(nx, x).join(ny, y)
    return j.select(x, y, F.log((F.col("_nxy") / n) / ((F.col("_nx") / n) * (F.col("_ny") / n)))
                    .alias("pmi"))
