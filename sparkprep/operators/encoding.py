"""Categorical encoding: label indices and one-hot columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import global_rank

MAX_DENSE = 1_000


def label_index(df: DataFrame, col: str, out: str = "index") -> DataFrame:
    """Table ``(value, index)``: 0-based alphabetical index of the distinct
    non-null values (a distributed rank over the distinct values)."""
    values = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    return global_rank(values, ["value"], "_r").select(
        "value", (F.col("_r") - 1).cast("int").alias(out))


def label_encode(df: DataFrame, col: str, out: str | None = None,
                 index: DataFrame | None = None) -> DataFrame:
    """Join the index table (fitted on ``df`` unless given). AQE broadcasts
    it when its runtime size is small and shuffles otherwise."""
    index = index if index is not None else label_index(df, col)
    out = out or f"{col}_index"
    return df.join(index.withColumnRenamed("value", col).withColumnRenamed("index", out),
                   col, "left")


def label_decode(df: DataFrame, index_col: str, index: DataFrame, out: str) -> DataFrame:
    return df.join(index.withColumnRenamed("index", index_col).withColumnRenamed("value", out),
                   index_col, "left")


def onehot_sparse(df: DataFrame, col: str, index: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """One-hot code of any number of categories as two columns: the position
    ``<out>`` of the 1 (0-based, the alphabetically first category dropped:
    null) and the ``<out>_size`` of the vector. A join with the index table;
    nothing is fetched."""
    out = out or f"{col}_hot"
    index = index if index is not None else label_index(df, col)
    size = index.select(F.greatest(F.count(F.lit(1)) - 1, F.lit(0))).scalar()
    coded = label_encode(df, col, f"{out}_i", index)
    return coded.select(*df.columns, F.when(F.col(f"{out}_i") > 0, F.col(f"{out}_i") - 1).alias(out),
                        size.alias(f"{out}_size"))


def categories(df: DataFrame, col: str, limit: int = MAX_DENSE) -> list:
    """The distinct non-null values of a column, ascending, for a dense
    one-hot code. More than ``limit`` raise: a schema cannot grow with the
    data; ``onehot_sparse`` takes any number."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} categories; use onehot_sparse")
    return sorted(r[0] for r in rows)


def onehot_drop_first(df: DataFrame, col: str, cats, keep_source: bool = False) -> DataFrame:
    """Dense 0/1 columns ``<col>_<value>`` for every given category except
    the first (scikit-learn ``drop='first'``, ``sparse=False``). The caller
    names the categories, as they make the schema; ``onehot_sparse`` takes
    any."""
    out = df.select("*", *[(F.col(col) == F.lit(v)).cast("double").alias(f"{col}_{v}")
                           for v in cats[1:]])
    return out if keep_source else out.drop(col)
