"""Near-duplicate embeddings: PCA-ordered tiled comparison.

Vectors of equal label and equal components are one class, stood for by its
smallest id with its size. The principal axes of all unit vectors come from
one distributed sum of outer products (dimension x dimension numbers reach
the driver, whatever the number of rows). Representatives are numbered in
the order of their first principal coordinate within their label and cut
into tiles of ``tile`` rows; a label of any size is many tiles, and each pair
of tiles is one group, so a hot label spreads over all tasks. A tile pair
whose first-coordinate ranges alone keep every cosine under the threshold is
never formed.

Inside a tile pair the leading coordinates are multiplied first, ``STEP`` at
a time. After each step the rest of a dot product is bounded by the product
of the two suffix norms (Cauchy-Schwarz); row blocks stop as soon as no pair
can reach the threshold, and later steps run on the pairs still open only.
Survivors' cosines are computed in double precision from the vectors as
given. A tile pair gives, for each vector, the number of links found and a
spanning forest of them (fewer rows than vectors), never the pairs.

Null, zero, non-finite vectors and vectors with a null component, or of a
length other than the label's other vectors, link with nothing across that
difference; so do rows with a null label. Each row gives one result row; rows
that repeat a vec_id with the same vector count as separate vectors of one
class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import saved
from .components import components

THRESHOLD = 0.93
TILE = 1024
STEP = 8
_SLACK = 1e-9  # rounding of rotated coordinates; survivors are recomputed


def _usable(v: str):
    """Vectors that can link: not null, finite, without nulls, not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(v).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _matrix(col) -> np.ndarray:
    """Rows of equal length as a double matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.empty((0, 0))


def _unit(m: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Columns: principal axes of the unit vectors, by falling variance."""
    def outer(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                u = _unit(_matrix(batch.column(0)))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["k", "x"])

    rows = (vectors.where(F.size("v") == dim).select("v").mapInArrow(outer, "k long, x double")
                   .groupBy("k").agg(F.sum("x").alias("x")).collect())  # dim * dim rows
    m = np.zeros(dim * dim)
    for r in rows:
        m[r["k"]] = r["x"]
    _, axes = np.linalg.eigh(m.reshape(dim, dim))
    return np.ascontiguousarray(axes[:, ::-1])


def _rank_in_label(reps: DataFrame, tile: int) -> DataFrame:
    """Tile number by first principal coordinate within (label, dim): local
    positions in range partitions plus counts of the partitions before."""
    order = ["label", "dim", "c", "rep"]
    ranged = cut_lineage(reps.repartitionByRange(*order).sortWithinPartitions(*order)
                             .withColumn("pid", F.spark_partition_id())
                             .withColumn("seq", F.monotonically_increasing_id()))
    before = Window.partitionBy("label", "dim").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition and label it touches
    offset = ranged.groupBy("label", "dim", "pid").agg(F.count("*").alias("n"), F.min("seq").alias("s0")).select(
        "label", "dim", "pid", "s0", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    return (ranged.join(F.broadcast(offset), ["label", "dim", "pid"])
                  .withColumn("tile", ((F.col("n0") + F.col("seq") - F.col("s0")) / tile).cast("int"))
                  .select("label", "dim", "rep", "copies", "v", "c", "tile"))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """A spanning forest of the links (a, b)."""
    up: dict = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out_a, out_b = [], []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
            out_a.append(x)
            out_b.append(y)
    return out_a, out_b


def tile_links(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool, step: int = STEP,
               block: int = 128):
    """Index pairs (i of x, j of y) with cosine >= threshold; i < j where
    both are the same tile."""
    ux, uy = _unit(x), _unit(y)
    px, py = ux @ axes, uy @ axes
    dim = px.shape[1]

    def suffix(p):
        s = np.cumsum((p * p)[:, ::-1], 1)[:, ::-1]
        return np.sqrt(np.maximum(np.concatenate([s, np.zeros((len(p), 1))], 1), 0))

    sx, sy = suffix(px), suffix(py)
    low = threshold - _SLACK
    out_i, out_j = [], []
    for at in range(0, len(px), block):
        rows = slice(at, min(len(px), at + block))
        k = min(2 * step, dim)
        part = px[rows, :k] @ py[:, :k].T
        open_ = part + sx[rows, k, None] * sy[None, :, k] >= low
        if same:
            open_ &= np.arange(len(py))[None, :] > np.arange(rows.start, rows.stop)[:, None]
        i, j = np.nonzero(open_)
        dot = part[i, j]
        i = i + at
        while len(i) and k < dim:
            e = min(k + step, dim)
            dot = dot + np.einsum("nd,nd->n", px[i, k:e], py[j, k:e])
            k = e
            keep = dot + sx[i, k] * sy[j, k] >= low
            i, j, dot = i[keep], j[keep], dot[keep]
        if len(i):
            exact = np.einsum("nd,nd->n", ux[i], uy[j])
            keep = exact >= threshold
            out_i.append(i[keep])
            out_j.append(j[keep])
    none = np.empty(0, np.int64)
    return np.concatenate(out_i or [none]), np.concatenate(out_j or [none])


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """Per row: vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable) and kept (it is that id)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).alias("v")).withColumn("ok", _usable("v") & F.col("label").isNotNull())
    usable = rows.where("ok").select("vec_id", "label", "v")
    # a class is known by a stored number, as its ids may all be null
    classes = saved(usable.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                          .withColumn("rep", F.monotonically_increasing_id()).withColumn("dim", F.size("v")))
    dims = [r["dim"] for r in classes.select("dim").distinct().collect()]
    axes = {d: principal_axes(classes.where(F.col("dim") == d), d) for d in dims}
    held = spark.sparkContext.broadcast(axes)

    def first_coordinate(batches):
        for batch in batches:
            d = batch.column("dim").to_numpy()
            c = np.zeros(batch.num_rows)
            for k in np.unique(d):
                at = np.flatnonzero(d == k)
                c[at] = _unit(_matrix(batch.column("v").take(pa.array(at)))) @ held.value[k][:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c)], names=[*batch.schema.names, "c"])

    kind = classes.schema["label"].dataType.simpleString()
    element = classes.schema["v"].dataType.simpleString()
    coord = classes.select("label", "v", "rep", "copies", "dim").mapInArrow(first_coordinate,
                               f"label {kind}, v {element}, rep long, copies long, dim int, c double")
    tiled = saved(_rank_in_label(coord, tile))
    ends = saved(tiled.groupBy("label", "dim", "tile").agg(F.min("c").alias("lo"), F.max("c").alias("hi")))
    other = ends.select("label", "dim", F.col("tile").alias("t2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    # unit vectors with first coordinates p <= q have a cosine of at most
    # p*q + sqrt(1-p*p)*sqrt(1-q*q) = cos(acos p - acos q)
    gap = F.greatest(F.lit(0.0), F.acos(F.greatest(F.least("hi", F.lit(1.0)), F.lit(-1.0)))
                     - F.acos(F.greatest(F.least("lo2", F.lit(1.0)), F.lit(-1.0))))
    pairs = ends.join(other, ["label", "dim"]).where("tile <= t2").where(F.cos(gap) >= threshold - 1e-6)
    near = pairs.select("label", "dim", F.col("tile").alias("p"), F.col("t2").alias("q"),
                        F.explode(F.when(F.col("tile") == F.col("t2"), F.array("tile"))
                                   .otherwise(F.array("tile", "t2"))).alias("tile"))
    dealt = tiled.join(saved(near), ["label", "dim", "tile"])

    def links(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        p, q, t = (table.column(c).to_numpy() for c in ("p", "q", "tile"))
        dim = int(table.column("dim")[0].as_py())
        left, right = np.flatnonzero(t == p), np.flatnonzero(t == q)
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        m = _matrix(table.column("v"))
        same = bool(p[0] == q[0])
        i, j = tile_links(m[left], m[right], held.value[dim], threshold, same)
        a, b = left[i], right[j]
        n = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
        some = np.flatnonzero(n)
        fa, fb = _forest(rep[a], rep[b])
        none = pa.nulls
        return pa.table({
            "rep": pa.concat_arrays([pa.array(rep[some]), pa.array(fa, pa.int64())]),
            "n": pa.concat_arrays([pa.array(n[some].astype(np.int64)), none(len(fa), pa.int64())]),
            "b": pa.concat_arrays([none(len(some), pa.int64()), pa.array(fb, pa.int64())])})

    found = saved(dealt.groupBy("label", "dim", "p", "q").applyInArrow(links, "rep long, n long, b long"))
    counts = saved(found.where("n is not null").groupBy("rep").agg(F.sum("n").alias("n")))
    label = saved(components(found.where("b is not null").select(F.col("rep").alias("a"), "b")))
    named = saved(classes.join(counts, "rep", "left").join(
        label.select(F.col("id").alias("rep"), "component"), "rep", "left")
        .select("label", "v", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component")))
    smallest = saved(named.groupBy("component").agg(F.min("least").alias("component_id")))
    per_class = saved(named.join(smallest, "component").select("label", "v", "n_links", "component_id"))
    usable_out = usable.join(per_class, ["label", "v"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return usable_out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
