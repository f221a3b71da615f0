"""Cosine k-means with the reference's rules: K distinct seeds drawn from
the data, assignment to the nearest centroid by cosine distance, update to
the plain (unnormalised) mean of the members, an empty cluster keeps its
centroid, stop when the assignment repeats or after ``max_iter``.

Centroids (K x d, K a parameter) travel as one array-valued scalar
subquery, so assignment is a projection over the data: no join, no
cross product. The update is a grouped vector mean (partial aggregation).
Each iteration's assignment is checkpointed to the shared checkpoint
folder, which bounds lineage and survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import vectors as V

DIST_DIGITS = 9


def seed_centroids(df: DataFrame, key: str, vec: str, k: int, seed: int | None = None) -> DataFrame:
    """K distinct rows as seeds: the first K keys, or the K smallest
    hashes of (key, seed) when a seed is given. ``(cluster, centroid)``."""
    order = [F.col(key)] if seed is None else [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)]
    picked = df.select(key, vec).orderBy(*order).limit(k)  # top-k: k is a parameter
    # numbering k rows: a window over the k picked rows only
    from pyspark.sql import Window
    return picked.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("int").alias("cluster"),
                         F.col(vec).cast("array<double>").alias("centroid"))


def centroid_array(centroids: DataFrame) -> Column:
    """The centroid table as one sorted array<struct<cluster, centroid>>."""
    return centroids.select(F.array_sort(F.collect_list(F.struct("cluster", "centroid")))).scalar()


def centroid_distances(vec: Column, cents: Column) -> Column:
    """array<struct<d, cluster>>: cosine distance to every centroid,
    rounded so near-ties resolve by cluster id."""
    return F.transform(cents, lambda c: F.struct(
        F.round(V.cosine_distance(vec, c["centroid"]), DIST_DIGITS).alias("d"),
        c["cluster"].alias("cluster")))


def assign_clusters(df: DataFrame, vec: str, cents: Column, out: str = "cluster") -> DataFrame:
    """Nearest centroid (smallest distance, then smallest cluster id)."""
    # a subquery may not sit inside a lambda: project it as a column first
    base = df.withColumn("_cents", cents)
    best = F.array_min(centroid_distances(F.col(vec), F.col("_cents")))
    return base.withColumn("_best", best).withColumn(out, F.col("_best.cluster")).withColumn(
        "distance", F.col("_best.d")).drop("_best", "_cents")


def update_centroids(assigned: DataFrame, previous: DataFrame, vec: str,
                     cluster: str = "cluster", dim: int | None = None) -> DataFrame:
    """Member mean per cluster; clusters without members keep the old one.
    With a known dimension the mean is ``dim`` exact sums in one hash
    aggregate; otherwise the Summarizer vector aggregate is used."""
    src = assigned.withColumnRenamed(cluster, "_c")
    means = (V.group_mean_fixed(src, ["_c"], vec, dim, out="_m") if dim
             else V.group_mean_vector(src, ["_c"], vec, out="_m"))
    return (previous.join(means.withColumnRenamed("_c", "cluster"), "cluster", "left")
                    .select("cluster", F.coalesce("_m", "centroid").alias("centroid")))


def inertia(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("distance").alias("inertia"))


def kmeans_cosine(df: DataFrame, key: str, vec: str, k: int, max_iter: int = 10,
                  seed: int | None = None):
    """Returns ``(centroids, assigned, history)``; history has one row per
    iteration with the inertia and the number of changed assignments."""
    spark = df.sparkSession
    data = df.select(key, F.col(vec).cast("array<double>").alias(vec))
    dim = data.select(F.max(F.size(vec))).first()[0]
    cents = cut_lineage(seed_centroids(data, key, vec, k, seed))
    history = []
    current = data.withColumn("cluster", F.lit(-1))
    assigned = None
    for it in range(max_iter):
        # the previous assignment travels in the checkpointed frame: no join
        assigned = assign_clusters(current.withColumnRenamed("cluster", "_prev"), vec,
                                   centroid_array(cents))
        assigned = cut_lineage(assigned)
        stats = assigned.agg(F.sum("distance").alias("inertia"),
                             F.count_if(F.col("cluster") != F.col("_prev")).alias("changed")).first()
        history.append((it, float(stats["inertia"] or 0.0), int(stats["changed"])))
        if it > 0 and stats["changed"] == 0:
            break
        cents = cut_lineage(update_centroids(assigned, cents, vec, dim=dim))
        current = assigned.drop("_prev", "distance")
    hist = spark.createDataFrame(history, "iteration int, inertia double, changed long")
    return cents, assigned.drop("_prev"), hist
