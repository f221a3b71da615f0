"""Ranked-retrieval evaluation: precision/recall/F1 at k, the precision-
recall curve and interpolated precision, per query (``query`` column).

Ranks and running counts inside a query come from ``grouped_scan``, which
spreads even a query with most of the candidates over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scan import grouped_scan


def ranked(df: DataFrame, query: str, order_by, rel: str) -> DataFrame:
    """Add ``rank`` (1-based inside the query) and ``cum_rel`` (relevant
    items at ranks <= rank)."""
    return grouped_scan(df, [query], order_by, {
        "rank": ("count", F.lit(1)),
        "cum_rel": ("sum", F.col(rel).cast("long"))})


def _totals(df: DataFrame, query: str, rel: str, totals: DataFrame | None = None) -> DataFrame:
    """Relevant items per query: given (``totals``: query, total_rel) when
    the collection holds relevant items that were not retrieved, else
    counted from the ranked list itself."""
    if totals is not None:
        return totals.select(query, F.col("total_rel").cast("long").alias("total_rel"))
    return df.groupBy(query).agg(F.sum(F.col(rel).cast("long")).alias("total_rel"))


def metrics_at_k(df: DataFrame, query: str, order_by, rel: str, ks=(5, 10, 20),
                 totals: DataFrame | None = None) -> DataFrame:
    """``(query, k, precision, recall, f1)``; recall over all relevant items
    of the query; F1 is 0 when precision + recall is 0."""
    # only the first max(ks) rows of a query count: the rank filter becomes a
    # per-task limit before the shuffle
    w = Window.partitionBy(query).orderBy(*order_by)
    r = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max(ks))
    ks_col = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    hits = (r.select(query, "rank", F.col(rel).cast("long").alias("_rel"), ks_col)
             .groupBy(query, "k")
             .agg(F.sum(F.when(F.col("rank") <= F.col("k"), F.col("_rel")).otherwise(0)).alias("_hits")))
    out = hits.join(_totals(df, query, rel, totals), query)
    p = F.col("_hits") / F.col("k")
    rc = F.try_divide(F.col("_hits").cast("double"), F.col("total_rel"))
    f1 = F.when((p + rc) > 0, 2 * p * rc / (p + rc)).otherwise(F.lit(0.0))
    return out.select(query, "k", p.alias("precision"), rc.alias("recall"), f1.alias("f1"))


def pr_curve(df: DataFrame, query: str, order_by, rel: str,
             totals: DataFrame | None = None) -> DataFrame:
    """``(query, rank, precision, recall)`` after each retrieved item."""
    r = ranked(df, query, order_by, rel).join(_totals(df, query, rel, totals), query)
    return r.select(query, "rank", (F.col("cum_rel") / F.col("rank")).alias("precision"),
                    F.try_divide(F.col("cum_rel").cast("double"), F.col("total_rel")).alias("recall"))


def interpolated_precision(curve: DataFrame, query: str) -> DataFrame:
    """Per rank: the maximum precision at this or any later rank (a suffix
    maximum = a prefix maximum over the reversed order)."""
    out = grouped_scan(curve, [query], [F.col("rank").desc()],
                       {"interpolated": ("max", F.col("precision"))})
    return out


def interpolated_at_recall(curve: DataFrame, query: str, levels) -> DataFrame:
    """``(query, level, interpolated)``: max precision over points whose
    recall >= level (levels are few, so each curve point fans out to them)."""
    lv = F.explode(F.array(*[F.lit(float(x)) for x in levels])).alias("level")
    return (curve.select(query, "precision", "recall", lv)
                 .groupBy(query, "level")
                 .agg(F.max(F.when(F.col("recall") >= F.col("level"), F.col("precision")))
                      .alias("interpolated")))
