"""Dense-vector expressions on ``array<double|float>`` columns, group
softmax / attention, and grouped vector means.

Element-wise work uses array higher-order functions (``zip_with``,
``aggregate``, ``transform``): evaluated in the JVM, no Python per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bags import Bags, Block, as_bags, meet


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null when either vector has zero length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity; a zero vector is at distance 1."""
    return F.coalesce(1 - cosine_similarity(a, b), F.lit(1.0))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") + y.cast("double"))


def scale(a: Column, s) -> Column:
    return F.transform(a, lambda x: x.cast("double") * s)


def reshape(a: Column, cols: int) -> Column:
    """Row-major ``view(-1, cols)``: array of ``size/cols`` rows."""
    rows = F.sequence(F.lit(0), F.floor(F.size(a) / cols).cast("int") - 1)
    return F.transform(rows, lambda i: F.slice(a, i * cols + 1, cols))


def argmax(a: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def argmin(a: Column) -> Column:
    return (F.array_position(a, F.array_min(a)) - 1).cast("int")


def concat_features(*arrays: Column) -> Column:
    return F.concat(*[a.cast("array<double>") for a in arrays])


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def group_softmax(df: DataFrame, group, score: str, out: str = "weight") -> DataFrame:
    """exp(s - max_g) / sum_g exp(s - max_g) inside each group. Two
    aggregate passes (max, then sum) joined back: each is a partial/final
    hash aggregate, so a group of any size is reduced before the shuffle."""
    group = list(group)
    mx = df.groupBy(*group).agg(F.max(score).alias("_mx"))
    z = F.sum(F.exp(F.col(score) - F.col("_mx"))).alias("_z")
    # materialised: the last join reads plain scans, so a hot group is split
    tot = cut_lineage(df.join(cut_lineage(mx), group).groupBy(*group, "_mx").agg(z))
    return (df.join(tot, group).withColumn(out, F.exp(F.col(score) - F.col("_mx")) / F.col("_z"))
              .drop("_mx", "_z"))


def group_mean_vector(df: DataFrame, group, vec: str, weight: str | None = None,
                      out: str = "mean") -> DataFrame:
    """Element-wise (weighted) mean of array vectors per group through the
    ``Summarizer`` aggregate (partial aggregation; one vector per group
    crosses the shuffle per task)."""
    group = list(group)
    v = array_to_vector(F.col(vec).cast("array<double>"))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    agg = df.select(*group, v.alias("_v"), w.alias("_w")).groupBy(*group).agg(
        Summarizer.mean(F.col("_v"), F.col("_w")).alias("_m"))
    return agg.select(*group, vector_to_array("_m").alias(out))


def group_mean_fixed(df: DataFrame, group, vec: str, dim: int, out: str = "mean") -> DataFrame:
    """Element-wise mean of fixed-length vectors per group as ``dim`` plain
    sums in one generated hash aggregate (exact sum / count per element)."""
    group = list(group)
    v = F.col(vec)
    sums = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *[
        F.sum(F.element_at(v, i + 1).cast("double")).alias(f"_s{i}") for i in range(dim)])
    return sums.select(*group, F.array(*[F.col(f"_s{i}") / F.col("_n") for i in range(dim)]).alias(out))


#: postings whose vectors are multiplied at a time
_MEAN_CHUNK = 1 << 15


def _block_means(b: Block, dim: int) -> pa.Table:
    flat = b.table.column("v").combine_chunks().flatten()
    vectors = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    holes = ~np.asarray(flat.is_valid()).reshape(-1, dim) if flat.null_count else None
    if holes is not None:
        vectors = np.where(holes, 0.0, vectors)
    tf = b.values.astype(np.float64)
    start = np.flatnonzero(np.diff(b.row, prepend=-1))  # of each document with a known term
    total, blank = np.zeros((len(start), dim)), np.zeros((len(start), dim), bool)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(start, start[lo] + _MEAN_CHUNK)))
        s = slice(start[lo], start[hi] if hi < len(start) else len(tf))
        total[lo:hi] = np.add.reduceat(vectors[b.at[s]] * tf[s, None], start[lo:hi] - start[lo])
        if holes is not None:
            blank[lo:hi] = np.logical_and.reduceat(holes[b.at[s]], start[lo:hi] - start[lo])
        lo = hi
    mean = total / np.add.reduceat(tf, start)[:, None] if len(start) else total
    return pa.table({"doc": b.docs.column("doc").take(pa.array(b.row[start])),
                     "mean": pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1) * dim, pa.int32()),
                                                      pa.array(mean.ravel(), mask=blank.ravel()))})


def doc_mean_vectors(tf: DataFrame | Bags, vectors: DataFrame, doc: str, token: str,
                     vec: str, dim: int, tf_col: str = "tf") -> DataFrame:
    """Average word vector ``(doc, mean array)`` of each document's
    in-vocabulary tokens, from bags or term frequencies ``(doc, token, tf)``.
    A token's vector is sent to a block of documents once (``bags.meet``), so
    no vector is shuffled for a posting; the weighted sums are made there."""
    bags = as_bags(tf, doc, token, tf_col)
    wide = vectors.select(token, F.array(*[F.element_at(vec, i + 1) for i in range(dim)]).alias("v"))
    means = meet(bags, wide, lambda b: _block_means(b, dim),
                 f"doc {dict(bags.rows.dtypes)['doc']}, mean array<double>", token)
    return means.withColumnRenamed("doc", doc)


def attention_weights(keys: DataFrame, queries: DataFrame, group, vec: str, qvec: str,
                      scaled: bool = True, out: str = "weight") -> DataFrame:
    """Scaled dot-product attention weights of every key row against its
    group's query vector: softmax over the group of q.k / sqrt(d)."""
    group = list(group)
    j = keys.join(queries.select(*group, qvec), group)
    s = dot(F.col(vec), F.col(qvec))
    if scaled:
        s = s / F.sqrt(F.size(F.col(vec)).cast("double"))
    return group_softmax(j.withColumn("_score", s), group, "_score", out).drop(qvec, "_score")
