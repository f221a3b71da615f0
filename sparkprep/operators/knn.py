"""Exact k nearest neighbours with pivots.

A bounded sample of the training rows are pivots; every training row belongs
to the cell of its nearest pivot, and a cell is cut by the distance to the
pivot into rings of at most ``RING_ROWS`` rows. By the triangle inequality a
row at distance r from a pivot is at least |d(query, pivot) - r| away from a
query, so:

* round 1: a query visits one ring, the one nearest to it in the cell of its
  nearest pivot that holds k rows; the k-th distance found is its reach;
* round 2: it visits the other rings, of any cell, that the reach touches.

Rows that are equal in vector and label are one row with a count of at most k,
so copies fill neither a ring nor a result. A ring that many queries visit is
dealt to several tasks; a task holds one ring and ``QUERIES_PER_TASK``
queries. Only the pivots and their cells' radii are broadcast, ``PIVOTS`` rows
at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .scan import grouped_scan

PIVOTS = 256
RING_ROWS = 4_096
QUERIES_PER_TASK = 2_000
#: rings (a row each) that may be broadcast; more are joined by shuffles
BROADCAST_RINGS = 100_000
SLACK = 1e-6  # distances are rounded to 9 digits


def _stack(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1) if len(col) else np.empty((0, 0))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed left to right and rounded to 9 places, so
    that ties resolve alike wherever a pair is compared."""
    out = np.empty((len(x), len(y)))
    step = max(1, 2_000_000 // max(1, y.size))
    for at in range(0, len(x), step):
        diff = x[at:at + step, None, :] - y[None, :, :]
        out[at:at + step] = np.round(np.sqrt(np.cumsum(diff * diff, axis=2)[:, :, -1]), 9)
    return out


def _squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one matrix product, and what bounds their error
    and that of rounding to 9 places, by row of ``x``."""
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    return xx[:, None] + yy - 2.0 * (x @ y.T), 1e-8 * (1.0 + xx + np.nanmax(yy, initial=0.0))


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances good to far less than ``SLACK``: pairs whose product cancels are subtracted."""
    d = _squares(x, y)[0]
    rows, cols = np.nonzero(~(d > 1e-4 * ((x * x).sum(1)[:, None] + (y * y).sum(1))))
    diff = x[rows] - y[cols]
    d[rows, cols] = (diff * diff).sum(1)
    return np.sqrt(d)


def _vectors(batch) -> np.ndarray:
    return _stack(batch.column(batch.schema.get_field_index("v")))


def _to_pivots(pivots, among=None):
    """Appends the nearest pivot (of ``among``) and its distance."""
    among = np.arange(len(pivots)) if among is None else among

    def run(batches):
        for batch in batches:
            if not batch.num_rows or not len(among):
                continue
            d = _far(_vectors(batch), pivots[among])
            cell = d.argmin(1)
            yield batch.append_column("cell", pa.array(among[cell].astype(np.int32))).append_column(
                "r", pa.array(d[np.arange(len(d)), cell]))
    return run


def _touched(pivots, cells, inner, radius):
    """``key, cell, d, reach``: the cells whose rows the reach may touch."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows or not len(cells):
                continue
            d = _far(_vectors(batch), pivots[cells])
            reach = batch.column(batch.schema.get_field_index("reach")).to_numpy()
            row, col = np.nonzero(np.maximum(inner - d, d - radius) <= reach[:, None] + SLACK)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("key")).take(pa.array(row)), pa.array(cells[col].astype(np.int32)),
                 pa.array(d[row, col]), pa.array(reach[row])], names=["key", "cell", "d", "reach"])
    return run


def _nearest(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k nearest rows of a ring within each query's reach. A matrix
    product picks the rows that may be among them, and only these are
    measured as ``_distances`` does."""
    schema = pa.schema([("key", left.schema.field("key").type), ("dist", pa.float64()), ("y", right.schema.field("y").type),
                        ("n", pa.int64())])
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    y = right.column("y").to_numpy()
    n = right.column("n").to_numpy()
    xs, ys, reach = _stack(left.column("v")), _stack(right.column("v")), left.column("reach").to_numpy()
    rows, picks, dist = [], [], []
    for at in range(0, len(xs), 256):
        square, slack = _squares(xs[at:at + 256], ys)
        cut = reach[at:at + 256] ** 2
        wide = np.flatnonzero(np.isinf(cut))
        if len(wide) and len(ys) > k:
            cut[wide] = np.partition(square[wide], k - 1, axis=1)[:, k - 1]
        maybe = ~(square > (cut + slack)[:, None])
        for row in np.flatnonzero(maybe.any(1)):
            part = np.flatnonzero(maybe[row])
            d = _distances(xs[at + row:at + row + 1], ys[part])[0]
            order = np.lexsort((y[part], d))[:k]
            near, d = part[order], d[order]
            upto = int(np.searchsorted(np.cumsum(n[near]), k)) + 1
            rows += [at + row] * len(near[:upto])
            picks += near[:upto].tolist()
            dist += d[:upto].tolist()
    return pa.table([left.column("key").take(pa.array(rows, pa.int64())), pa.array(dist, pa.float64()),
                     right.column("y").take(pa.array(picks, pa.int64())), pa.array(n[picks], pa.int64())], schema=schema)


def _compare(visits: DataFrame, rings: DataFrame, k: int, per_task: int) -> DataFrame:
    """k nearest of each visited ring. ``visits``: key, v, cell, ring, reach."""
    ring = ["cell", "ring"]
    parts = cut_lineage(visits.groupBy(*ring).agg(F.ceil(F.count(F.lit(1)) / per_task).cast("int").alias("parts")))
    left = visits.join(parts, ring).select(*ring, F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "key", "v", "reach")
    copies = parts.select(F.col("cell").alias("c"), F.col("ring").alias("g"),
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"))
    right = rings.join(copies, (F.col("cell") == F.col("c")) & (F.col("ring") == F.col("g"))).select("c", "g", "p", "v", "y", "n")
    kinds = dict(left.dtypes) | dict(right.dtypes)
    return left.groupBy(*ring, "part").cogroup(right.groupBy("c", "g", "p")).applyInArrow(
        lambda a, b: _nearest(a, b, k), f"key {kinds['key']}, dist double, y {kinds['y']}, n long")


def rings_of(train: DataFrame, pivots: np.ndarray, ring_rows: int) -> DataFrame:
    """``(cell, ring, r, v, y, n)``: rings of a cell hold its rows in the
    order of their distance to the pivot, in even shares of ``ring_rows`` at most."""
    kinds = dict(train.dtypes)
    placed = train.mapInArrow(_to_pivots(pivots),
                              f"v array<double>, y {kinds['y']}, n long, cell int, r double")
    ranked = cut_lineage(grouped_scan(placed, ["cell"], ["r"], {"at": ("count", F.lit(1))}))
    sizes = ranked.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))  # a row a pivot
    shares = F.ceil(F.col("size") / ring_rows)
    return cut_lineage(ranked.join(F.broadcast(sizes), "cell").select(
        "cell", F.floor((F.col("at") - 1) * shares / F.col("size")).cast("int").alias("ring"), "r", "v", "y", "n"))


def visits(queries: DataFrame, train: DataFrame, k: int, pivots: int = PIVOTS, ring_rows: int = RING_ROWS,
           per_task: int = QUERIES_PER_TASK):
    """(neighbours, visited rings of round 1, of round 2). ``queries``: key,
    v; ``train``: v, y. ``neighbours``: key, dist, y, n; at least the k nearest."""
    train = cut_lineage(train.groupBy("v", "y").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("n")))
    queries = cut_lineage(queries)
    total = train.count()
    kinds = dict(queries.dtypes)
    wanted = max(1, min(pivots, math.isqrt(max(0, total))))
    points = _stack(train.select("v").orderBy(F.xxhash64("v"), "v").limit(wanted).toArrow().column("v"))
    rings = rings_of(train, points, ring_rows) if total else cut_lineage(train.select(
        F.lit(0).alias("cell"), F.lit(0).alias("ring"), F.lit(0.0).alias("r"), "v", "y", "n"))
    bounds = cut_lineage(rings.groupBy("cell", "ring").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.sum("n").alias("held")))
    if bounds.count() <= BROADCAST_RINGS:
        bounds = F.broadcast(bounds)
    # a row a pivot
    cells = bounds.groupBy("cell").agg(F.max("hi").alias("radius"), F.min("lo").alias("inner"), F.max("held").alias("held")).toPandas()
    cells = cells.sort_values("cell")
    kind = f"key {kinds['key']}"

    # round 1: the nearest cell that holds k rows in a ring, its ring nearest to the query
    roomy = cells.loc[cells["held"] >= k, "cell"].to_numpy(np.int64)
    home = queries.mapInArrow(_to_pivots(points, roomy), f"{kind}, v array<double>, cell int, r double").select(
        "key", "cell", F.col("r").alias("d"))
    gap = F.greatest(F.col("lo") - F.col("d"), F.col("d") - F.col("hi"), F.lit(0.0))
    first = cut_lineage(home.join(bounds.where(F.col("held") >= k), "cell").groupBy("key").agg(
        F.min(F.struct(gap.alias("gap"), "cell", "ring")).alias("b")).select("key", "b.cell", "b.ring"))
    endless = F.lit(float("inf"))
    found = cut_lineage(_compare(first.join(queries, "key").withColumn("reach", endless), rings, k, per_task))
    at_k = grouped_neighbours(found, k).groupBy("key").agg(F.sum("n").alias("n"), F.max("dist").alias("dist"))
    reach = at_k.where(F.col("n") >= k).select("key", F.col("dist").alias("reach"))

    # round 2: rings that the reach touches
    known = cut_lineage(queries.join(reach, "key", "left").withColumn("reach", F.coalesce("reach", endless)))
    near = known.mapInArrow(_touched(points, *(cells[c].to_numpy() for c in ("cell", "inner", "radius"))),
                            f"{kind}, cell int, d double, reach double")
    second = cut_lineage(near.join(bounds, "cell").where(gap <= F.col("reach") + SLACK).select("key", "cell", "ring").join(
        first, ["key", "cell", "ring"], "left_anti"))
    more = _compare(second.join(known, "key"), rings, k, per_task)
    return found.unionByName(more), first, second


def grouped_neighbours(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each key: equal (distance, label) rows of one key are
    added up first, then kept until k are reached."""
    merged = found.groupBy("key", "dist", "y").agg(F.sum("n").alias("n"))
    top = merged.groupBy("key").agg(F.slice(F.array_sort(F.collect_list(F.struct("dist", "y", "n"))), 1, k).alias("nn"))
    before = lambda i: F.aggregate(F.slice("nn", 1, i), F.lit(0).cast("long"), lambda a, t: a + t["n"])
    cut = F.transform("nn", lambda t, i: F.struct(t["dist"].alias("dist"), t["y"].alias("y"), F.greatest(
        F.least(t["n"], F.lit(k) - before(i)), F.lit(0).cast("long")).alias("n")))
    return top.select("key", F.inline(cut)).where("n > 0")


def knn_classify(queries: DataFrame, train: DataFrame, qkey: str, vec: str, label: str, k: int = 3,
                 pivots: int = PIVOTS, ring_rows: int = RING_ROWS) -> DataFrame:
    """Exact k nearest neighbours by Euclidean distance (9 digits; ties by
    label), majority vote (count desc, label asc): ``(qkey, pred, votes)``.
    Rows without a vector are left out; keys of queries are distinct."""
    q = queries.where(F.col(vec).isNotNull()).select(F.col(qkey).alias("key"), F.col(vec).cast("array<double>").alias("v"))
    t = train.where(F.col(vec).isNotNull()).select(F.col(vec).cast("array<double>").alias("v"), F.col(label).alias("y"))
    top = grouped_neighbours(visits(q, t, k, pivots, ring_rows)[0], k)
    votes = top.groupBy("key", "y").agg(F.sum("n").alias("c"))
    return votes.groupBy("key").agg(F.min(F.struct((-F.col("c")).alias("nc"), F.col("y"))).alias("b")).select(
        F.col("key").alias(qkey), F.col("b.y").alias("pred"), (-F.col("b.nc")).alias("votes"))
