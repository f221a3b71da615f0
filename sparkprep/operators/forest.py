"""Random forests whose trees are grown to full depth on tables of any size.

Settings follow ``pyspark.ml``'s RandomForestClassifier: features are cut into
at most ``max_bins`` bins (its rule, over all values instead of a sample),
every tree sees each row Poisson(1) times, a node tries ceil(sqrt(features))
features drawn for it and takes the split of the largest Gini gain (none: a
leaf), sibling leaves of one class are merged, and a tree votes with the class
shares of the leaf. Draws are keyed: a row's by its bins and label (rows equal
in both are one row with a weight w, drawn as Poisson(w)), a node's by its tree
and place. So a forest does not move with the layout of the data.

``pyspark.ml`` sums dense statistics of every node over all rows and keeps the
forest on the driver. Here a pass over the rows serves only nodes of more rows
than one task may hold (``LOCAL_CELLS``); their splits are the part of the
forest that the driver holds. The rows of each smaller node go to one task,
which grows it to its leaves, level by level, and returns it as one row of a
stored table. To predict, distinct rows are sent through the driver's part,
meet the small trees by joins on the node, and their votes are summed.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, store
from .scan import grouped_scan

#: Rows x drawn features x classes of a node that one task grows.
LOCAL_CELLS = 8_000_000
#: Bytes of statistics that a task of a pass holds; more nodes take more passes.
PASS_BYTES = 64 << 20
#: Distinct rows that meet a small tree in one task.
SCORE_ROWS = 500_000
#: A vote of 1. Votes are whole numbers, so their sums have no order.
ONE = 1 << 40
LEAF, LOCAL, OPEN = -1, -2, -3


@dataclass(frozen=True)
class Settings:
    classes: int
    features: int
    bins: int
    trees: int
    max_depth: int
    seed: int

    @property
    def drawn(self) -> int:
        return ceil(sqrt(self.features))


@dataclass
class Top:
    """The nodes that the driver holds (root of tree t: node t; children of a
    node: ``child``, ``child`` + 1). ``feature`` is LEAF, LOCAL or OPEN where
    there is no split; ``place`` numbers a tree's nodes like a heap."""
    tree: np.ndarray
    place: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    child: np.ndarray
    counts: np.ndarray

    def leaf_of(self, tree: int, bins: np.ndarray) -> np.ndarray:
        return _leaf_of(self.feature, self.bin, self.child, np.full(len(bins), tree), bins)


def _leaf_of(feature, cut, child, at, bins):
    """Node in which each row ends that starts at ``at``."""
    go = np.arange(len(at))
    while True:
        f = feature[at[go]]
        go, f = go[f >= 0], f[f >= 0]
        if not len(go):
            return at
        at[go] = child[at[go]] + (bins[go, f] > cut[at[go]])


def _mix(x):
    """Scattered 64-bit numbers of whole numbers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = np.asarray(x).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _drawn_features(s: Settings, tree, place):
    """The features that each node tries, ascending."""
    node = _mix(_mix(_mix(s.seed) ^ np.asarray(tree, np.uint64)) ^ np.asarray(place, np.uint64))
    lots = _mix(node[:, None] ^ _mix(np.arange(s.features))[None])
    if s.drawn == s.features:
        return np.tile(np.arange(s.features), (len(lots), 1))
    return np.sort(np.argpartition(lots, s.drawn - 1, axis=1)[:, :s.drawn], axis=1)


def _drawn_weights(s: Settings, keys, weights):
    """How often each row is in each tree (rows x trees)."""
    out = np.empty((len(keys), s.trees), np.int64)
    for i, (key, w) in enumerate(zip(keys.tolist(), weights.tolist())):
        philox = np.random.Philox(key=[s.seed & (2**64 - 1), key & (2**64 - 1)])
        out[i] = np.random.Generator(philox).poisson(w, s.trees)
    return out


def _gain(left, counts):
    """Gini gain of splits by class counts on the left and of the node; -1
    where a side is empty."""
    nl, n = left.sum(-1), counts.sum(-1)
    nr = n - nl
    left, right, whole = left.astype(np.float64), (counts - left).astype(np.float64), counts.astype(np.float64)
    purity = (left * left).sum(-1) / np.maximum(nl, 1) + (right * right).sum(-1) / np.maximum(nr, 1)
    gain = np.round((purity - (whole * whole).sum(-1) / np.maximum(n, 1)) / np.maximum(n, 1), 12)
    return np.where((nl > 0) & (nr > 0), gain, -1.0)


def _best_splits(s: Settings, drawn, at, bins, y, w, counts):
    """Feature (LEAF without a gain), bin and left class counts of the best
    split of each node; ties go to the smallest feature and bin. ``at`` is the
    node of each row; every node has rows."""
    m, k, width = s.drawn, s.classes, int(w.max()) + 1
    cell = (at[:, None] * m + np.arange(m)) * s.bins + bins[np.arange(len(at))[:, None], drawn[at]]
    # node, feature, bin, class and weight sort as one number
    key = np.sort((((cell * k) + y[:, None]) * width + w[:, None]).ravel())
    cell, weight = np.divmod(key, width)
    cell, cls = np.divmod(cell, k)
    hot = np.zeros((len(key), k), np.int32)
    hot[np.arange(len(key)), cls] = weight
    last = np.flatnonzero(np.append(cell[1:] != cell[:-1], True))
    left, cell = np.cumsum(hot, axis=0, dtype=np.int32)[last], cell[last]
    group, b = np.divmod(cell, s.bins)
    node = group // m
    # every feature of a node has all its rows: what came before the group
    before = np.cumsum(np.repeat(counts, m, axis=0), axis=0) - np.repeat(counts, m, axis=0)
    left = left - before[group]
    gain = _gain(left, counts[node])
    first = np.searchsorted(node, np.arange(len(counts)))
    top = np.maximum.reduceat(gain, first)
    hits = np.flatnonzero(gain == top[node])
    best = hits[np.searchsorted(node[hits], np.arange(len(counts)))]
    feature = np.where(top > 0, drawn[np.arange(len(counts)), group[best] % m], LEAF)
    return feature, b[best], left[best]


def _grow(s: Settings, tree: int, place: int, bins, y, w):
    """The tree under one node from its rows: feature (LEAF: none), bin and
    first child by node, and the class counts of the leaves in node order."""
    depth, at = place.bit_length() - 1, np.zeros(len(y), np.int64)
    places = np.array([place])
    counts = np.bincount(y, w, s.classes).astype(np.int64)[None]
    levels, start = [], 0
    while len(places):
        feature, cut = np.full(len(places), LEAF), np.zeros(len(places), np.int64)
        child = np.zeros(len(places), np.int64)
        levels.append((feature, cut, child, counts))
        tried = np.flatnonzero((counts.max(1) < counts.sum(1)) & (depth < s.max_depth))
        if not len(tried):
            break
        number = np.full(len(places), -1)
        number[tried] = np.arange(len(tried))
        on = number[at] >= 0
        bins, y, w, at = bins[on], y[on], w[on], at[on]
        feature[tried], cut[tried], left = _best_splits(
            s, _drawn_features(s, np.full(len(tried), tree), places[tried]), number[at], bins, y, w, counts[tried])
        split = np.flatnonzero(feature >= 0)
        start, depth = start + len(places), depth + 1
        child[split] = start + 2 * np.arange(len(split))
        left = left[number[split]]
        on = feature[at] >= 0
        bins, y, w, at = bins[on], y[on], w[on], at[on]
        at = child[at] - start + (bins[np.arange(len(at)), feature[at]] > cut[at])
        counts = np.stack([left, counts[split] - left], 1).reshape(-1, s.classes)
        places = np.stack([2 * places[split], 2 * places[split] + 1], 1).ravel()
    ends = np.cumsum([len(x[0]) for x in levels])
    feature, cut, child, counts = (np.concatenate(x) for x in zip(*levels))
    spans = [slice(a, b) for a, b in zip(np.append(0, ends), ends)]
    for span in reversed(spans):
        _merge(feature, child, counts, np.arange(span.start, span.stop))
    alive = np.zeros(len(feature), bool)
    alive[0] = True
    for span in spans:
        inner = np.arange(span.start, span.stop)[alive[span] & (feature[span] >= 0)]
        alive[child[inner]] = alive[child[inner] + 1] = True
    child = (np.cumsum(alive) - 1)[child][alive]
    feature, cut, counts = feature[alive], cut[alive], counts[alive]
    return feature, cut, child, counts[feature < 0]


def _merge(feature, child, counts, nodes):
    """A split whose sides are leaves of one class becomes a leaf."""
    at = nodes[feature[nodes] >= 0]
    a, b = child[at], child[at] + 1
    same = (feature[a] == LEAF) & (feature[b] == LEAF) & (counts[a].argmax(1) == counts[b].argmax(1))
    feature[at[same]] = LEAF


def _votes(counts):
    n = counts.sum(1, keepdims=True)
    return np.round(counts / np.maximum(n, 1) * ONE).astype(np.int64)


def _rows(col, n_features):
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, n_features)


def _blobs(rows: np.ndarray) -> pa.Array:
    flat, (n, d) = np.ascontiguousarray(rows, np.uint8), rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n * d + 1, d, dtype=np.int32)), pa.py_buffer(flat)])


def _data(batch, s: Settings):
    bins = _rows(batch.column("_bins"), s.features)
    y, w, h = (batch.column(c).to_numpy().astype(np.int64) for c in ("y", "w", "h"))
    return bins, y, _drawn_weights(s, h, w)


def _statistics(batches, s: Settings, top: Top, nodes):
    """Class counts by drawn feature and bin of the open ``nodes`` (ascending
    by tree), summed over this task's rows."""
    drawn = _drawn_features(s, top.tree[nodes], top.place[nodes])
    size = s.drawn * s.bins * s.classes
    total = np.zeros((len(nodes), size), np.int64)
    number = np.full(len(top.feature), -1)
    number[nodes] = np.arange(len(nodes))
    for batch in batches:
        bins, y, w = _data(batch, s)
        for t in np.unique(top.tree[nodes]).tolist():
            low, high = np.searchsorted(top.tree[nodes], [t, t + 1])
            at = number[top.leaf_of(t, bins)]
            on = np.flatnonzero((at >= 0) & (w[:, t] > 0))
            cell = ((at[on, None] - low) * s.drawn + np.arange(s.drawn)) * s.bins + bins[on[:, None], drawn[at[on]]]
            cell = cell * s.classes + y[on, None]
            total[low:high] += np.bincount(cell.ravel(), np.repeat(w[on, t], s.drawn), (high - low) * size).astype(
                np.int64).reshape(-1, size)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int32()), pa.array([x.tobytes() for x in total], pa.binary())],
                                     names=["node", "sums"])


def _chosen(table: pa.Table, s: Settings, top: Top) -> pa.Table:
    """The best split of one node from the tasks' statistics."""
    node = table.column("node")[0].as_py()
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("sums")).reshape(s.drawn, s.bins, s.classes)
    counts, left = total[0].sum(0), np.cumsum(total, axis=1)
    gain = _gain(left, np.broadcast_to(counts, left.shape))
    f, b = np.unravel_index(gain.argmax(), gain.shape)
    feature = int(_drawn_features(s, top.tree[[node]], top.place[[node]])[0, f]) if gain[f, b] > 0 else LEAF
    return pa.table({"node": pa.array([node], pa.int32()), "feature": pa.array([feature], pa.int32()), "bin": pa.array([int(b)], pa.int32()),
                     "left": pa.array([left[f, b].tolist()], pa.list_(pa.int64())), "counts": pa.array([counts.tolist()], pa.list_(pa.int64()))})


def _slices(batches, s: Settings, top: Top, drawn: bool):
    """Rows by the LOCAL node they end in: one row of packed bins (of drawn
    rows: also labels and weights) for each node and batch."""
    for batch in batches:
        bins, y, w = _data(batch, s) if drawn else (_rows(batch.column("_bins"), s.features), None, None)
        for t in range(s.trees):
            at = top.leaf_of(t, bins)
            on = np.flatnonzero((top.feature[at] == LOCAL) & (w[:, t] > 0 if drawn else True))
            on = on[np.argsort(at[on], kind="stable")]
            nodes, first = np.unique(at[on], return_index=True)
            parts = np.split(on, first[1:]) if len(nodes) else []
            cols = {"node": pa.array(nodes, pa.int32()), "bins": pa.array([bins[p].tobytes() for p in parts], pa.binary())}
            if drawn:
                cols["y"] = pa.array([y[p].astype("<i4").tobytes() for p in parts], pa.binary())
                cols["w"] = pa.array([w[p, t].astype("<i4").tobytes() for p in parts], pa.binary())
            yield pa.RecordBatch.from_pydict(cols)


def _joined(col, kind):
    return np.frombuffer(b"".join(col.to_pylist()), kind)


def _grown(table: pa.Table, s: Settings, top: Top) -> pa.Table:
    node = table.column("node")[0].as_py()
    feature, cut, child, counts = _grow(
        s, int(top.tree[node]), int(top.place[node]), _joined(table.column("bins"), np.uint8).reshape(-1, s.features),
        _joined(table.column("y"), "<i4").astype(np.int64), _joined(table.column("w"), "<i4").astype(np.int64))
    packed = [feature.astype("<i4"), cut.astype("u1"), child.astype("<i4"), counts.astype("<i8")]
    return pa.table([pa.array([node], pa.int32()), pa.array([len(feature)], pa.int32())] + [pa.array([x.tobytes()], pa.binary()) for x in packed],
                    names=["node", "n_nodes", "feature", "bin", "child", "leaves"])


def _scored(rows: pa.Table, tree: pa.Table, s: Settings) -> pa.Table:
    """Votes of one small tree for the rows that reach it."""
    names = [f"v{j}" for j in range(s.classes)]
    bins = _joined(rows.column("bins"), np.uint8).reshape(-1, s.features)
    if not tree.num_rows:  # none of the tree's draws fell on a row
        votes = np.zeros((len(bins), s.classes), np.int64)
    else:
        feature, cut, child, leaves = (np.frombuffer(tree.column(c)[0].as_py(), kind) for c, kind in (
            ("feature", "<i4"), ("bin", "u1"), ("child", "<i4"), ("leaves", "<i8")))
        leaf = _leaf_of(feature, cut, child, np.zeros(len(bins), np.int64), bins)
        votes = _votes(leaves.reshape(-1, s.classes))[(np.cumsum(feature < 0) - 1)[leaf]]
    return pa.table([_blobs(bins), *[pa.array(v) for v in votes.T]], names=["_bins", *names])


def _top_votes(batches, s: Settings, top: Top):
    """Votes of the trees in which a row ends at a leaf the driver holds."""
    by_node = _votes(top.counts)
    for batch in batches:
        bins, total = _rows(batch.column("_bins"), s.features), 0
        for t in range(s.trees):
            at = top.leaf_of(t, bins)
            total = total + np.where((top.feature[at] == LEAF)[:, None], by_node[at], 0)
        yield pa.RecordBatch.from_arrays([_blobs(bins), *[pa.array(v) for v in total.T]],
                                         names=["_bins", *[f"v{j}" for j in range(s.classes)]])


def split_points(rows: DataFrame, features: int, n: int, max_bins: int) -> list[np.ndarray]:
    """Ascending thresholds of each feature of the ``n`` rows of arrays ``x``:
    half way between all neighbouring values where these are at most
    ``max_bins`` - 1, else where the running count comes closest to each next
    multiple of n / ``max_bins``."""
    counts = rows.select(F.posexplode("x").alias("f", "v")).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = cut_lineage(grouped_scan(counts, ["f"], ["v"], {"cum": ("sum", "n"), "i": ("count", F.lit(1))}))
    # due: how many multiples lie before the middle of the value's rows
    due = F.ceil((F.col("cum") - F.col("n") / 2) / F.lit(n / max_bins)) - 1
    spans = ranked.groupBy("f", due.alias("due")).agg(F.min("i").alias("lo"), F.max("i").alias("hi")).toPandas()
    wanted = []
    for f, span in spans.sort_values(["f", "lo"]).groupby("f"):
        distinct = int(span["hi"].max())
        if distinct <= max_bins:
            wanted += [(int(f), i) for i in range(2, distinct + 1)]
            continue
        done = 0
        for due_, lo, hi in span[["due", "lo", "hi"]].itertuples(index=False):
            lo = max(int(lo), 2)  # a threshold lies before a value, not before the first
            more = max(0, min(int(due_) - done, int(hi) - lo + 1))
            wanted += [(int(f), lo + j) for j in range(more)]
            done += more
    found: dict = {f: [] for f in range(features)}
    if wanted:
        ends = {(f, j) for f, i in wanted for j in (i - 1, i)}
        asked = F.broadcast(rows.sparkSession.createDataFrame(sorted(ends), "f int, i long"))
        value = {(r["f"], r["i"]): r["v"] for r in ranked.join(asked, ["f", "i"], "left_semi").select("f", "i", "v").collect()}
        for f, i in wanted:
            found[f].append((value[f, i - 1] + value[f, i]) / 2)
    return [np.array(found[f], np.float64) for f in range(features)]


def _with_bins(rows: DataFrame, x, cuts) -> DataFrame:
    """``rows`` with ``_bins``: a byte for each feature, the thresholds below its value."""
    @F.arrow_udf("binary")
    def bins(col: pa.Array) -> pa.Array:
        v = col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), len(cuts))
        return _blobs(np.stack([np.searchsorted(c, v[:, j], side="left") for j, c in enumerate(cuts)], 1))
    return rows.withColumn("_bins", bins(x))


def _checked(vector):
    x = vector_to_array(vector)
    return F.when(vector.isNull(), F.raise_error(F.lit("Vectors MUST NOT be Null"))).otherwise(x)


def _tasks(nodes: int) -> int:
    return max(1, min(nodes, max(256, nodes // 8)))


class Forest(Estimator):
    """``label`` holds classes 0, 1, ..., ``features`` vectors."""

    def __init__(self, features="features", label="label", trees=100, max_depth=30, max_bins=32, seed=42):
        super().__init__()
        self.features, self.label, self.trees, self.max_depth = features, label, trees, max_depth
        self.max_bins, self.seed = max_bins, seed

    def _fit(self, dataset: DataFrame) -> ForestModel:
        y, vector = F.col(self.label).cast("double"), F.col(self.features)
        odd = F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
        rows = dataset.select(
            F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("Labels MUST NOT be Null or NaN")))
            .when((y < 0) | (y != y.cast("int")), F.raise_error(F.lit("Labels MUST be Integers from 0 on"))).otherwise(y.cast("int")).alias("y"),
            _checked(vector).alias("x"))
        rows = rows.withColumn("x", F.when(odd, F.raise_error(F.lit("Vector values MUST NOT be NaN or Infinity"))).otherwise(F.col("x")))
        n, classes, least, features = rows.agg(F.count(F.lit(1)), F.max("y"), F.min(F.size("x")), F.max(F.size("x"))).first()
        if not n or not features or least != features:
            raise ValueError("no rows to learn from" if not n else "vectors without values or of different sizes")
        max_bins = min(self.max_bins, n)
        cuts = split_points(rows, features, n, max_bins)
        s = Settings(classes + 1, features, max_bins, self.trees, self.max_depth, self.seed)
        slots = dataset.sparkSession.sparkContext.defaultParallelism
        data = _with_bins(rows, F.col("x"), cuts).groupBy("_bins", "y").agg(F.count(F.lit(1)).alias("w"))
        data = cut_lineage(data.withColumn("h", F.xxhash64("_bins", "y")).repartition(max(slots, n // 100_000)))
        top = _grow_top(data, s, n)
        nodes = int((top.feature == LOCAL).sum())
        small = data.mapInArrow(lambda it: _slices(it, s, top, True), "node int, bins binary, y binary, w binary").repartition(
            _tasks(nodes), "node").groupBy("node").applyInArrow(
            lambda t: _grown(t, s, top), "node int, n_nodes int, feature binary, bin binary, child binary, leaves binary")
        small = store(small)
        top = _merged(top, small, s)
        return ForestModel(self.features, s, cuts, top, small)


def _local_rows(s: Settings) -> int:
    return max(1, LOCAL_CELLS // (s.drawn * s.classes))


def _grow_top(data: DataFrame, s: Settings, n: int) -> Top:
    """Splits of all nodes of more rows than a task may hold."""
    local, ints = _local_rows(s), np.arange(s.trees)
    top = Top(ints, np.ones(s.trees, np.int64), np.full(s.trees, LOCAL if n <= local else OPEN), np.zeros(s.trees, np.int64),
              np.zeros(s.trees, np.int64), np.zeros((s.trees, s.classes), np.int64))
    share = max(1, PASS_BYTES // (8 * s.drawn * s.bins * s.classes))
    while (open_ := np.flatnonzero(top.feature == OPEN)).size:
        nodes = open_[np.argsort(top.tree[open_], kind="stable")][:share]
        found = data.mapInArrow(lambda it: _statistics(it, s, top, nodes), "node int, sums binary").repartition(  # noqa: B023
            _tasks(len(nodes)), "node").groupBy("node").applyInArrow(
            lambda t: _chosen(t, s, top), "node int, feature int, bin int, left array<bigint>, counts array<bigint>").toArrow()  # noqa: B023
        at, feature, cut = (found.column(c).to_numpy() for c in ("node", "feature", "bin"))
        left, counts = (np.array(found.column(c).to_pylist(), np.int64) for c in ("left", "counts"))
        order = np.argsort(at)
        at, feature, cut, left, counts = at[order], feature[order], cut[order], left[order], counts[order]
        top.feature[at], top.bin[at], top.counts[at] = feature, cut, counts
        at, left, counts = at[feature >= 0], left[feature >= 0], counts[feature >= 0]
        top.child[at] = len(top.feature) + 2 * np.arange(len(at))
        counts = np.stack([left, counts - left], 1).reshape(-1, s.classes)
        place = np.stack([2 * top.place[at], 2 * top.place[at] + 1], 1).ravel()
        rows, deep = counts.sum(1), place >= 1 << s.max_depth
        kind = np.where(deep | (counts.max(1, initial=0) == rows), LEAF, np.where(rows <= local, LOCAL, OPEN))
        new = (np.repeat(top.tree[at], 2), place, kind, np.zeros(len(place), np.int64), np.zeros(len(place), np.int64), counts)
        top = Top(*[np.concatenate([a, b]) for a, b in zip((top.tree, top.place, top.feature, top.bin, top.child, top.counts), new)])
    return top


def _merged(top: Top, small: DataFrame, s: Settings) -> Top:
    """``top`` with small trees of a single leaf taken in, and sibling leaves
    of one class merged."""
    for r in small.where("n_nodes = 1").select("node", "leaves").toLocalIterator():
        top.feature[r["node"]] = LEAF
        top.counts[r["node"]] = np.frombuffer(r["leaves"], "<i8")
    for i in range(len(top.feature) - 1, -1, -1):
        if top.feature[i] >= 0:
            _merge(top.feature, top.child, top.counts, np.array([i]))
    return top


class ForestModel(Model):
    """``small`` holds a row for each tree under a LOCAL node of ``top``: its
    nodes' features (-1: leaf), bins (a row goes left up to it) and first
    children, and the class counts of its leaves, as packed arrays."""

    def __init__(self, features: str, settings: Settings, cuts, top: Top, small: DataFrame):
        super().__init__()
        self.features, self.settings, self.cuts, self.top, self.small = features, settings, cuts, top, small

    @property
    def n_nodes(self) -> int:
        """Nodes of all trees."""
        top = self.top
        seen = list(range(self.settings.trees))
        for i in seen:
            if top.feature[i] >= 0:
                seen += [int(top.child[i]), int(top.child[i]) + 1]
        local = [i for i in seen if top.feature[i] == LOCAL]
        kept = self.small.sparkSession.createDataFrame([(i,) for i in local], "node int")
        return len(seen) - len(local) + (self.small.join(F.broadcast(kept), "node").agg(F.sum("n_nodes")).first()[0] or 0)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` with ``rawPrediction`` (summed votes), ``probability``
        and ``prediction`` (the class of most votes, the smallest among ties)."""
        s, top, names = self.settings, self.top, [f"v{j}" for j in range(self.settings.classes)]
        rows = _with_bins(dataset, _checked(F.col(self.features)), self.cuts)
        keys = cut_lineage(rows.select("_bins").distinct())
        n = keys.count()
        slots = dataset.sparkSession.sparkContext.defaultParallelism
        keys = keys.repartition(max(1, min(n // 1_000, slots), n // 100_000))
        vote = "_bins binary, " + ", ".join(f"{c} bigint" for c in names)
        votes = keys.mapInArrow(lambda it: _top_votes(it, s, top), vote)
        # a small tree meets at most SCORE_ROWS rows or so in a task
        parts, nodes = ceil(max(n, 1) / SCORE_ROWS), int((top.feature == LOCAL).sum())
        if nodes:
            tasks = _tasks(nodes * parts)
            ways = keys.mapInArrow(lambda it: _slices(it, s, top, False), "node int, bins binary").withColumn(
                "part", F.pmod(F.crc32("bins"), F.lit(parts))).repartition(tasks, "node", "part")
            trees = self.small.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>"))).repartition(
                tasks, "node", "part")
            votes = votes.unionByName(ways.groupBy("node", "part").cogroup(trees.groupBy("node", "part")).applyInArrow(
                lambda a, b: _scored(a, b, s), vote))
        votes = votes.groupBy("_bins").agg(*[F.sum(c).alias(c) for c in names]).select(
            "_bins", F.array(*names).alias("_votes"), sum(F.col(c) for c in names).alias("_all"))
        raw = F.transform("_votes", lambda v: v / F.lit(float(ONE)))
        share = F.transform("_votes", lambda v: F.when(F.col("_all") > 0, v / F.col("_all")).otherwise(F.lit(0.0)))
        return rows.join(votes, "_bins", "left").select(
            *dataset.columns, array_to_vector(raw).alias("rawPrediction"), array_to_vector(share).alias("probability"),
            (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double").alias("prediction"))
