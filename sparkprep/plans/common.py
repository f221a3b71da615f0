"""Shared bindings for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import load


def rounded(df: DataFrame, digits: int = 6, skip=()) -> DataFrame:
    """Round every double column (results are compared value by value
    with an independent engine, whose summation order differs)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip
        else F.col(f.name)
        for f in df.schema.fields])


def holey_customer(spark, sf) -> DataFrame:
    """``customer`` with nulls injected by key arithmetic (the driver
    tables have none): name every 11th/13th key, acctbal every 7th/13th,
    segment every 5th/13th ('' every 17th), nation every 13th, phone
    always. Keys divisible by 13 are null in every attribute."""
    c = load(spark, sf, "customer")
    k = F.col("c_custkey")
    all_null = k % 13 == 0

    def hole(cond, col):
        return F.when(cond | all_null, F.lit(None)).otherwise(F.col(col)).alias(col)

    seg = (F.when((k % 5 == 0) | all_null, F.lit(None))
            .when(k % 17 == 0, F.lit("")).otherwise(F.col("c_mktsegment")))
    return c.select("c_custkey", hole(k % 11 == 0, "c_name"),
                    hole(F.lit(False), "c_nationkey"), hole(k % 7 == 0, "c_acctbal"),
                    seg.alias("c_mktsegment"), F.lit(None).cast("string").alias("c_phone"))


HOLEY_CUSTOMER_SQL = """
hc AS (SELECT c_custkey,
  CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN NULL ELSE c_name END AS c_name,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
  CASE WHEN c_custkey % 7 = 0 OR c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 5 = 0 OR c_custkey % 13 = 0 THEN NULL
       WHEN c_custkey % 17 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment,
  CAST(NULL AS VARCHAR) AS c_phone
FROM customer)
"""


# Decimal places per magnitude band for ``sig_round``: 10 significant
# digits, so rows of very different magnitude in one column are all
# compared well above floating-point noise and well below their precision.
_SIG_BANDS = [(10.0 ** e, 9 - e) for e in range(-4, 13)]


def sig_round(c, sig: int = 10):
    """Round to about ``sig`` significant digits (Column)."""
    expr = None
    a = F.abs(c)
    for upper, places in _SIG_BANDS:
        places = places + (sig - 10)
        br = F.round(c, places)
        expr = F.when(a < upper, br) if expr is None else expr.when(a < upper, br)
    return expr.otherwise(F.round(c, 0))


def sig_round_sql(e: str, sig: int = 10) -> str:
    """SQL text equivalent of ``sig_round``."""
    parts = [f"WHEN abs({e}) < {upper!r} THEN round({e}, {places + (sig - 10)})"
             for upper, places in _SIG_BANDS]
    return "CASE " + " ".join(parts) + f" ELSE round({e}, 0) END"
