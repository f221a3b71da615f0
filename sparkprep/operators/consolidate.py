"""Deduplication and two-source record consolidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_keep_latest(df: DataFrame, keys, ts: str, tiebreak=None) -> DataFrame:
    """Keep one row per ``keys``: the newest ``ts``; ties go to the largest
    ``tiebreak`` columns (default: all other columns), so the choice is total.
    Null timestamps lose, as pandas sorts NaT last.

    ``row_number() = 1`` over the key is planned with a *partial*
    ``WindowGroupLimit`` before the shuffle: every map task keeps only its
    best row per key, so a key holding a third of all rows crosses the
    shuffle as one row per task (like a map-side combine), and the final
    window sees at most one row per task and key.
    """
    from pyspark.sql import Window
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != ts]
    tiebreak = list(tiebreak) if tiebreak is not None else rest
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last(),
                                          *[F.col(c).desc_nulls_last() for c in tiebreak])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def full_outer_merge(left: DataFrame, right: DataFrame, key: str,
                     suffixes=("_x", "_y"), null_safe: bool = False) -> DataFrame:
    """pandas ``merge(on=key, how='outer')``: one key column, overlapping
    names suffixed. pandas also pairs null keys with each other; pass
    ``null_safe=True`` for that (null-safe equality), else nulls never match."""
    lx, ry = suffixes
    common = (set(left.columns) & set(right.columns)) - {key}
    l2 = left.select(F.col(key).alias("_k_l"), *[
        F.col(c).alias(c + lx if c in common else c) for c in left.columns if c != key])
    r2 = right.select(F.col(key).alias("_k_r"), *[
        F.col(c).alias(c + ry if c in common else c) for c in right.columns if c != key])
    cond = (F.col("_k_l").eqNullSafe(F.col("_k_r")) if null_safe
            else F.col("_k_l") == F.col("_k_r"))
    joined = l2.join(r2, cond, "full")
    return joined.select(F.coalesce("_k_l", "_k_r").alias(key),
                         *[c for c in joined.columns if c not in ("_k_l", "_k_r")])


def _both_differ(col: str, suffixes) -> Column:
    x, y = F.col(col + suffixes[0]), F.col(col + suffixes[1])
    return x.isNotNull() & y.isNotNull() & (x != y)


def conflict_counts(merged: DataFrame, cols, suffixes=("_x", "_y")) -> DataFrame:
    """Per attribute: rows where both sources have a value and they differ.
    One aggregate pass, then a k-column unpivot of the single result row."""
    aggs = [F.count_if(_both_differ(c, suffixes)).alias(c) for c in cols]
    one = merged.agg(*aggs)
    return one.unpivot([], list(cols), "attribute", "n_conflicts")


def conflict_rows(merged: DataFrame, col: str, suffixes=("_x", "_y")) -> DataFrame:
    """Rows where both sources carry ``col``."""
    return merged.filter(F.col(col + suffixes[0]).isNotNull()
                         & F.col(col + suffixes[1]).isNotNull())


def survivorship(merged: DataFrame, cols, ts_x: str, ts_y: str,
                 suffixes=("_x", "_y"), final_suffix="_final") -> DataFrame:
    """Newest source wins; if the winner is null take the other; both null
    stays null. Equal or missing timestamps favour the second source."""
    out = merged
    x_newer = F.coalesce(F.col(ts_x) > F.col(ts_y), F.lit(False))
    for c in cols:
        x, y = F.col(c + suffixes[0]), F.col(c + suffixes[1])
        out = out.withColumn(c + final_suffix,
                             F.coalesce(F.when(x_newer, x).otherwise(y), x, y))
    return out.drop(*[c + s for c in cols for s in suffixes])


def lookup_semi(df: DataFrame, vocab: DataFrame, on: str) -> DataFrame:
    """Keep rows whose ``on`` value is in ``vocab`` (left semi join).
    Catalyst broadcasts ``vocab`` when its statistics fall under the
    broadcast threshold and sort-merges otherwise."""
    return df.join(vocab.select(on).distinct(), on, "left_semi")


def stop_anti(df: DataFrame, stops: DataFrame, on: str) -> DataFrame:
    """Drop rows whose ``on`` value is in ``stops`` (left anti join)."""
    return df.join(stops.select(on).distinct(), on, "left_anti")
