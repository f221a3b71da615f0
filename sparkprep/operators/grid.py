"""Evaluation meshes over the observed range of two columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mesh(df: DataFrame, x: str, y: str, n: int = 50, xname: str = "x", yname: str = "y") -> DataFrame:
    """``(i, j, xname, yname)``: an n x n grid spanning [min, max] of both
    columns. Generated from ``range`` plus a fixed-length ``sequence``
    explode (the size is the parameter n^2, not the data)."""
    r = df.agg(F.min(x).cast("double").alias("x0"), F.max(x).cast("double").alias("x1"),
               F.min(y).cast("double").alias("y0"), F.max(y).cast("double").alias("y1"))
    from .stats import fetch_row
    v = fetch_row(r)
    x0, x1, y0, y1 = v["x0"], v["x1"], v["y0"], v["y1"]
    g = df.sparkSession.range(n).select(F.col("id").cast("int").alias("i"),
                                        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j"))
    return g.select("i", "j", (x0 + F.col("i") * (x1 - x0) / (n - 1)).alias(xname),
                    (y0 + F.col("j") * (y1 - y0) / (n - 1)).alias(yname))
