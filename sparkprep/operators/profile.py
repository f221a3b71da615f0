"""Column profiling: schema, null handling, descriptive statistics.

Every statistic over many columns is computed in ONE aggregate pass and
then reshaped to one row per column (``inline`` of an array of structs over
the single result row), instead of one job per column and metric.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import nan_to_null
from . import stats as S

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """``kind`` = 'numeric' or 'string' (pandas ``select_dtypes``)."""
    if kind == "numeric":
        return numeric_columns(df)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def select_by_dtype(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*columns_of_type(df, kind))


def per_column(one_row: DataFrame, cols, stats) -> DataFrame:
    """Reshape a 1-row frame with columns ``<stat>__<col>`` into one row per
    column with one field per stat."""
    packed = F.array(*[F.struct(F.lit(c).alias("column"),
                                *[F.col(f"{s}__{c}").alias(s) for s in stats])
                       for c in cols])
    return one_row.select(F.inline(packed))


def multi_agg(df: DataFrame, cols, stat_fns: dict) -> DataFrame:
    """``stat_fns``: name -> fn(column name) -> aggregate Column. One pass."""
    aggs = [fn(c).alias(f"{s}__{c}") for c in cols for s, fn in stat_fns.items()]
    return per_column(df.agg(*aggs), cols, list(stat_fns))


# ---------------------------------------------------------------- schema

def schema_profile(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, n_rows, n_non_null, n_cols, size)``:
    pandas ``info()`` / ``dtypes`` / ``shape`` / ``size`` in one pass."""
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(c).alias(f"nn__{c}") for c in df.columns]
    one = df.agg(*aggs)
    packed = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                                F.lit(dtypes[c]).alias("dtype"),
                                F.col("_rows").alias("n_rows"),
                                F.col(f"nn__{c}").alias("n_non_null"),
                                F.lit(len(df.columns)).alias("n_cols"),
                                (F.col("_rows") * len(df.columns)).alias("size"))
                       for i, c in enumerate(df.columns)])
    return one.select(F.inline(packed))


# ---------------------------------------------------------------- nulls

def _all(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _any(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


def rows_any_null(df: DataFrame, cols=None) -> DataFrame:
    cols = cols or df.columns
    return df.filter(_any([F.col(c).isNull() for c in cols]))


def rows_all_null(df: DataFrame, cols=None) -> DataFrame:
    cols = cols or df.columns
    return df.filter(_all([F.col(c).isNull() for c in cols]))


def null_mask(df: DataFrame, keep=(), cols=None) -> DataFrame:
    cols = cols or [c for c in df.columns if c not in keep]
    return df.select(*keep, *[F.col(c).isNull().alias(c) for c in cols])


def dropna(df: DataFrame, how: str = "any", thresh: int | None = None, subset=None) -> DataFrame:
    return df.na.drop(how=how, thresh=thresh, subset=subset)


def dropna_columns(df: DataFrame) -> DataFrame:
    """Drop columns whose values are all null. The decision needs one
    aggregate row (one count per column) on the driver: it fixes the schema."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
    return df.drop(*[c for c, n in counts.items() if n == 0])


def fill_const(df: DataFrame, value, subset=None) -> DataFrame:
    return df.na.fill(value, subset=subset)


def fill_mean(df: DataFrame, cols) -> DataFrame:
    """Null -> column mean (scalar subquery, computed once, no join)."""
    means = S.fetch_row(df.agg(*[F.avg(c).alias(c) for c in cols]))
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), means[c]))
    return out


def fill_median(df: DataFrame, cols, source: DataFrame | None = None) -> DataFrame:
    """Null -> exact median of ``source`` (default: ``df`` itself; pass the
    training frame to reuse its medians on test data)."""
    src = source if source is not None else df
    med = S.exact_quantiles(src, cols, [0.5])
    out = df
    for c in cols:
        v = med.filter(F.col("column") == c).select("value").scalar()
        out = out.withColumn(c, F.coalesce(F.col(c), v.cast(df.schema[c].dataType)))
    return out


def fill_mode(df: DataFrame, cols, source: DataFrame | None = None) -> DataFrame:
    """Null -> most frequent value, lowest on ties (pandas ``mode().iloc[0]``);
    a column with no values stays null (it has no median either)."""
    src = source if source is not None else df
    out = df
    for c in cols:
        m = S.lowest_mode(src, c)
        out = out.withColumn(c, F.coalesce(F.col(c), m))
    return out


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Dictionary recode; unmapped values become null. Small maps inline
    as a literal map; big ones should be joined as a table instead."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return df.withColumn(out or col, F.try_element_at(F.create_map(*kv), F.col(col)))


def cast_cols(df: DataFrame, types: dict) -> DataFrame:
    """``try_cast`` (ANSI mode raises on bad input; pandas gives NaN)."""
    out = df
    for c, t in types.items():
        out = out.withColumn(c, F.col(c).try_cast(t))
    return out


def unique_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


# ---------------------------------------------------------------- stats

def basic_stats(df: DataFrame, cols) -> DataFrame:
    """min, max, count, mean per column (one pass)."""
    dcols = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return multi_agg(dcols, cols, {"min": F.min, "max": F.max,
                                   "count": F.count, "mean": F.avg})


def median(df: DataFrame, cols) -> DataFrame:
    return S.exact_quantiles(df, cols, [0.5]).select("column", F.col("value").alias("median"))


def var_std(df: DataFrame, cols) -> DataFrame:
    return multi_agg(df, cols, {"var": F.var_samp, "std": F.stddev_samp})


def shape_stats(df: DataFrame, cols) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis (pandas ``skew``/``kurt``)."""
    return multi_agg(df, cols, {"skew": S.corrected_skewness, "kurt": S.corrected_kurtosis})


def mean_abs_dev(df: DataFrame, cols) -> DataFrame:
    """Mean absolute deviation around the mean: two passes, the mean enters
    the second as a scalar subquery."""
    means = S.fetch_row(df.agg(*[F.avg(c).alias(c) for c in cols]))
    one = df.agg(*[F.avg(F.abs(F.col(c) - means[c])).alias(f"mad__{c}") for c in cols])
    return per_column(one, cols, ["mad"])


def column_profile(df: DataFrame, cols) -> DataFrame:
    """One row per column: rows, missing, completeness %, distinct values,
    mean, sample std, min, exact quartiles, max.

    One table of distinct values with running counts gives the counts,
    distinct counts, extremes and quartiles; one aggregate pass gives rows
    and moments. NaN counts as missing. The result (one row per column) is
    assembled on the driver."""
    spark = df.sparkSession
    dcols = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    one = dcols.agg(F.count(F.lit(1)).alias("_rows"), *[x for c in cols for x in (
        F.avg(c).alias(f"mean__{c}"), F.stddev_samp(c).alias(f"std__{c}"))]).first()
    ranked = S.ranked_values(dcols, cols)
    per = {r["column"]: r for r in ranked.groupBy("column").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    q = {(r["column"], r["prob"]): r["value"] for r in S.quantiles_of(ranked, [0.25, 0.5, 0.75]).collect()}
    n = one["_rows"]
    rows = []
    for c in cols:
        p = per.get(c)
        k, d, lo, hi = (p["n"], p["d"], p["lo"], p["hi"]) if p else (0, 0, None, None)
        rows.append((c, n, n - k, (k * 100.0 / n) if n else None, d, one[f"mean__{c}"], one[f"std__{c}"], lo,
                     q.get((c, 0.25)), q.get((c, 0.5)), q.get((c, 0.75)), hi))
    return spark.createDataFrame(rows, "column string, n_rows long, n_missing long, completeness double, "
                                       "n_distinct long, mean double, std double, min double, q25 double, "
                                       "q50 double, q75 double, max double")


def describe_numeric(df: DataFrame, cols) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max with exact quartiles."""
    dcols = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    base = multi_agg(dcols, cols, {"count": F.count, "mean": F.avg, "std": F.stddev_samp,
                                   "min": F.min, "max": F.max})
    q = S.quantile_wide(dcols, cols, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    return base.join(q, "column", "left")


def describe_categorical(df: DataFrame, cols) -> DataFrame:
    """count, unique, top (most frequent, lowest on ties), freq per column.
    Value counts are one distributed aggregate over the unpivoted values."""
    long = S.to_long(df, cols, value_type="string")
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per = vc.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("_top"))
    return per.select("column", "count", "unique", F.col("_top.value").alias("top"),
                      (-F.col("_top.neg")).alias("freq"))


def missing_counts(df: DataFrame, only_positive: bool = False) -> DataFrame:
    """Nulls per column, sorted descending (then by name)."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing__{c}") for c in df.columns])
    out = per_column(one, df.columns, ["missing"])
    if only_positive:
        out = out.filter(F.col("missing") > 0)
    return out.orderBy(F.col("missing").desc(), F.col("column"))


def missing_patterns(df: DataFrame, cols=None) -> DataFrame:
    """Presence vector (1 = present) per row, grouped and counted."""
    cols = cols or df.columns
    return (df.groupBy(*[F.col(c).isNotNull().cast("int").alias(c) for c in cols])
              .agg(F.count(F.lit(1)).alias("n")))


def value_distribution(df: DataFrame, col: str, as_percent_string: bool = False) -> DataFrame:
    """Normalised value counts (nulls dropped), sorted by share."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(col)).scalar()
    out = counts.withColumn("share", F.col("n") / total)
    if as_percent_string:
        out = out.withColumn("percent", F.concat(F.round(F.col("share") * 100, 1).cast("string"),
                                                 F.lit("%")))
    return out.orderBy(F.col("share").desc(), F.col(col))
