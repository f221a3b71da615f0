"""Exact decision trees, grown level by level over count tables.

All nodes of a level share one pass: class counts by (node, feature, value)
are one partial/final aggregate, running sums over the values (a segmented
scan, so one node may hold all rows) give the classes on the left of every
value, and the best value of each node is an aggregate again. Thresholds are
mid-points of neighbouring values of the node, so no value is binned. The tree
is a table; rows move to the children by a join on the node, and pure nodes
leave the work. Nothing but the number of open nodes reaches the driver, and a
tree of at most ``SENT_NODES`` nodes when it predicts.
A node of at most ``LOCAL_ROWS`` rows and ``LOCAL_CELLS`` values is grown to its
leaves by one task, by the same splits, so the number of passes follows the
large nodes only. The task sorts its rows once by every feature and keeps these
orders from level to level.

A node's name is its path of ``L`` and ``R`` from the root; paths sorted as
text are the nodes in depth-first order, which numbers them.

Splits follow scikit-learn's ``DecisionTreeClassifier``: every node that is
not pure and has a feature with two values is split, by the smallest weighted
impurity (ties: the smallest feature, then threshold). Missing values (null or
NaN) lie below all numbers. Rows without a label are left out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import global_rank
from .scan import grouped_scan

#: Open nodes (a row each) that may be broadcast; more are joined by shuffles.
BROADCAST_NODES = 100_000
#: Rows, and rows times features, of a node that one task grows to its leaves.
LOCAL_ROWS, LOCAL_CELLS = 125_000, 8_000_000
#: Nodes of a tree that is sent to the tasks that predict.
SENT_NODES = 1_000_000


def _entropy(counts: list[Column], n: Column) -> Column:
    terms = [F.when(c > 0, c / n * F.log2(c / n)).otherwise(0.0) for c in counts]
    return -reduce(lambda a, b: a + b, terms)


def _gini(counts: list[Column], n: Column) -> Column:
    return 1 - reduce(lambda a, b: a + b, [(c / n) * (c / n) for c in counts])


IMPURITY = {"entropy": _entropy, "gini": _gini}


def _total(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def _few(nodes: DataFrame, n: int) -> DataFrame:
    return F.broadcast(nodes) if n <= BROADCAST_NODES else nodes


def _summed_impurity(n: int, criterion: str):
    """Rows times ``IMPURITY`` by class counts in the last axis, for at most ``n`` rows."""
    if criterion == "gini":
        return lambda c, size: size - (c.astype(float) ** 2).sum(-1) / np.maximum(size, 1)
    count = np.arange(n + 1.0)
    weight = count * (np.log(np.maximum(count, 1)) / np.log(2.0))
    return lambda c, size: weight[size] - weight[c].sum(-1)


def _best_splits(x: np.ndarray, orders: list, y: np.ndarray, at: np.ndarray, counts: np.ndarray, summed):
    """Feature (-1: none), value and next larger value (NaN: none) of the
    smallest rounded impurity of each node. ``orders`` has, by feature, the
    rows that have it by node and value; ``at`` is a row's node."""
    total = counts.sum(1)
    score, feature = np.full(len(counts), np.inf), np.full(len(counts), -1)
    value, after = np.full(len(counts), np.nan), np.full(len(counts), np.nan)
    hot = np.eye(counts.shape[1], dtype=np.int32)
    for f, o in enumerate(orders):
        if not len(o):
            continue
        v, node = x[f, o], at[o]
        edge = node[1:] != node[:-1]
        last = np.flatnonzero(np.append(edge | (v[1:] != v[:-1]), True))
        first = np.append(0, np.flatnonzero(edge) + 1)
        running = np.cumsum(hot[y[o]], axis=0, dtype=np.int32)
        before = np.zeros((len(counts), counts.shape[1]), np.int32)
        before[node[first[1:]]] = running[first[1:] - 1]
        start = np.zeros(len(counts), np.int64)
        start[node[first]] = first
        nl = last + 1 - start[node[last]]
        last = last[nl < total[node[last]]]
        if not len(last):
            continue
        of = node[last]
        nl, left = last + 1 - start[of], running[last] - before[of]
        tried = np.round((summed(left, nl) + summed(counts[of] - left, total[of] - nl)) / total[of], 12)
        first = np.append(0, np.flatnonzero(of[1:] != of[:-1]) + 1)
        least = np.full(len(counts), np.inf)
        least[of[first]] = np.minimum.reduceat(tried, first)
        hits = np.flatnonzero(tried == least[of])
        nodes, at_hit = np.unique(of[hits], return_index=True)
        better = least[nodes] < score[nodes]
        nodes, at_hit = nodes[better], last[hits[at_hit[better]]]
        score[nodes], feature[nodes], value[nodes] = least[nodes], f, v[at_hit]
        more = np.minimum(at_hit + 1, len(o) - 1)
        after[nodes] = np.where((more > at_hit) & (node[more] == nodes), v[more], np.nan)
    return feature, value, after


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of lists; a value that a row does not have is NaN."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(int)
    x = np.full((len(sizes), max(sizes, default=0)), np.nan)
    x[np.arange(x.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return x


def _grow_small(table: pa.Table, k: int, criterion: str, depth: int, max_depth: int | None) -> pa.Table:
    """All nodes under the one whose rows ``table`` holds, level by level. A
    feature that a row does not have is NaN: the row goes right."""
    x = np.ascontiguousarray(_matrix(table.column("x").combine_chunks()).T)
    y = table.column("y").to_numpy().astype(np.int64)
    summed = _summed_impurity(len(y), criterion)
    orders = []
    for v in x:
        here = np.flatnonzero(~np.isnan(v))
        orders.append(here[np.argsort(v[here], kind="stable")].astype(np.int32))
    at, paths = np.zeros(len(y), np.int32), [table.column("path")[0].as_py()]
    counts, done = np.bincount(y, minlength=k)[None], []
    while paths:
        deep = max_depth is None or depth < max_depth
        tried = np.flatnonzero((counts.max(1, initial=0) != counts.sum(1)) & deep)
        feature, threshold = np.full(len(paths), -1), np.full(len(paths), np.nan)
        done.append((paths, np.full(len(paths), depth), feature, threshold, counts))
        if not len(tried):
            break
        at = _renumbered(at, tried, len(paths))
        orders = [_regrouped(o, at) for o in orders]
        f, value, after = _best_splits(x, orders, y, at, counts[tried], summed)
        split = np.flatnonzero(f >= 0)
        middle = (value + after) / 2
        named = split[~np.isnan(after[split])]
        feature[tried[named]] = f[named]
        threshold[tried[named]] = np.where(middle == after, value, middle)[named]
        at = _renumbered(at, split, len(tried))
        on = np.flatnonzero(at >= 0)
        of = split[at[on]]
        at[on] = 2 * at[on] + ~(x[f[of], on] <= value[of])
        counts = np.bincount(at[on] * k + y[on], minlength=2 * len(split) * k).reshape(-1, k)
        paths = [paths[i] + side for i in tried[split] for side in "LR"]
        orders = [_regrouped(o, at) for o in orders]
        depth += 1
    paths, depths, feature, threshold, counts = ([p for d in done for p in d[0]], *(np.concatenate([d[i] for d in done]) for i in range(1, 5)))
    leaf = feature < 0
    cols = [pa.array(paths, pa.string()), pa.array(depths, pa.int32()), pa.array(feature, pa.int32(), mask=leaf),
            pa.array(threshold, pa.float64(), mask=leaf), *(pa.array(c, pa.int64()) for c in counts.T)]
    return pa.table(cols, names=["path", "depth", "feature", "threshold"] + [f"c{j}" for j in range(k)])


def _renumbered(at: np.ndarray, kept: np.ndarray, n: int) -> np.ndarray:
    """Rows' nodes as places in ``kept``; -1 for rows of other nodes."""
    place = np.full(n + 1, -1, np.int32)  # the last is for rows that left before
    place[kept] = np.arange(len(kept))
    return place[at]


def _regrouped(order: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rows that are in a node, by node and then as before."""
    node = at[order]
    order, node = order[node >= 0], node[node >= 0]
    if not len(node) or not (node[1:] < node[:-1]).any():
        return order
    return order[np.argsort(node.astype(np.uint16) if node.max() < 1 << 16 else node, kind="stable")]


def _grower(k: int, criterion: str, depth: int, max_depth: int | None):
    return lambda table: _grow_small(table, k, criterion, depth, max_depth)


def grow_tree(rows: DataFrame, k: int, label: str = "label", features: str = "features", criterion: str = "entropy",
              max_depth: int | None = None) -> DataFrame:
    """``(path, depth, feature, threshold, impurity, n_samples,
    class_counts)``, one row a node; ``feature`` is null at leaves. ``label``
    holds classes 0 to k - 1, ``features`` an array of doubles."""
    impurity = IMPURITY[criterion]
    names = [f"c{j}" for j in range(k)]
    cols = [F.col(c) for c in names]
    value = lambda x: F.when(x.isNull() | F.isnan(x), F.lit(float("-inf"))).otherwise(x)
    active = cut_lineage(rows.where(F.col(label).isNotNull()).select(
        F.lit("").alias("path"), F.col(label).cast("int").alias("y"),
        F.transform(F.col(features).cast("array<double>"), value).alias("x")))
    counts_of = [F.sum((F.col("y") == j).cast("long")) for j in range(k)]
    level = cut_lineage(active.groupBy("path").agg(*[c.alias(n) for c, n in zip(counts_of, names)]).withColumn("depth", F.lit(0)))
    widest = active.agg(F.max(F.size("x"))).first()[0] or 1
    local = min(LOCAL_ROWS, LOCAL_CELLS // max(widest, 1))
    done, done_small = [], []
    pure = F.greatest(*cols, F.lit(0)) == F.col("n")
    while True:
        level = level.withColumn("n", _total(cols)).withColumn("h", impurity(cols, F.col("n")))
        deep = max_depth is None or len(done) < max_depth
        open_ = level.where(~pure & (F.col("n") > local))
        if deep:
            small = level.where(~pure & (F.col("n") <= local)).select("path")
            grown = cut_lineage(active.join(small, "path", "left_semi").groupBy("path").applyInArrow(
                _grower(k, criterion, len(done), max_depth), "path string, depth int, feature int, threshold double, " + ", ".join(f"{c} long" for c in names)))
            done_small.append(grown.withColumn("n", _total(cols)).withColumn("h", impurity(cols, F.col("n"))).select(
                "path", "depth", "feature", "threshold", "h", "n", *names))
            level = level.where(pure | (F.col("n") > local))
        width = open_.count() if deep else 0
        if width == 0:
            done.append(level.select("path", "depth", F.lit(None).cast("int").alias("feature"),
                                     F.lit(None).cast("double").alias("threshold"), "h", "n", *names))
            break
        large = active.join(_few(open_.select("path"), width), "path", "left_semi")
        counts = large.select("path", "y", F.posexplode("x").alias("f", "v")).groupBy("path", "f", "v").agg(
            *[c.alias(f"w{j}") for j, c in enumerate(counts_of)])
        scan = grouped_scan(counts, ["path", "f"], ["v"], {f"l{j}": ("sum", f"w{j}") for j in range(k)})
        left = [F.col(f"l{j}") for j in range(k)]
        right = [F.col(f"c{j}") - F.col(f"l{j}") for j in range(k)]
        tried = scan.join(_few(open_, width), "path").withColumn("nl", _total(left)).withColumn(
            "nr", F.col("n") - F.col("nl")).where("nr > 0")
        score = (F.col("nl") * impurity(left, F.col("nl")) + F.col("nr") * impurity(right, F.col("nr"))) / F.col("n")
        best = cut_lineage(tried.groupBy("path", "depth", *names).agg(
            F.min(F.struct(F.round(score, 12).alias("score"), "f", "v", *left)).alias("b")).select("path", "depth", *names, "b.*"))
        split = _few(best.select("path", "f", F.col("v").alias("cut")), width)
        moved = active.join(split, "path").withColumn("at", F.get("x", F.col("f")))
        # the threshold lies half way to the node's next value
        after = moved.where("at > cut").groupBy("path", "f", "cut").agg(F.min("at").alias("next"))
        middle = (F.col("cut") + F.col("next")) / 2
        cuts = after.select("path", F.col("f").alias("feature"), F.when(
            middle == F.col("next"), F.col("cut")).otherwise(middle).alias("threshold"))
        done.append(level.join(cuts, "path", "left").select("path", "depth", "feature", "threshold", "h", "n", *names))
        side = lambda s, value: best.select(F.concat("path", F.lit(s)).alias("path"), (F.col("depth") + 1).alias("depth"),
                                            *[value(j).alias(f"c{j}") for j in range(k)])
        level = side("L", lambda j: F.col(f"l{j}")).unionByName(side("R", lambda j: F.col(f"c{j}") - F.col(f"l{j}")))
        active = cut_lineage(moved.select(F.concat("path", F.when(F.col("at") <= F.col("cut"), "L").otherwise("R")).alias("path"),
                                          "y", "x"))
        active = active.join(_few(level.withColumn("n", _total(cols)).where(~pure).select("path"), 2 * width), "path", "left_semi")
    whole = reduce(DataFrame.unionByName, done + done_small)
    return whole.select("path", "depth", "feature", "threshold", F.col("h").alias("impurity"), F.col("n").alias("n_samples"),
                        F.array(*cols).alias("class_counts"))


def majority(counts: str = "class_counts") -> Column:
    """The class of most rows (the smallest among ties)."""
    return (F.array_position(F.col(counts), F.array_max(counts)) - 1).cast("double")


def tree_table(tree: DataFrame, names=None) -> DataFrame:
    """The tree with depth-first numbers: ``(node, parent, depth, branch,
    feature, threshold, impurity, n_samples, class_counts, prediction)``;
    values <= threshold go left."""
    numbered = cut_lineage(global_rank(tree, ["path"], "_n").withColumn("node", (F.col("_n") - 1).cast("int")).drop("_n"))
    up = numbered.select(F.col("path").alias("_up"), F.col("node").alias("parent"))
    label = F.col("feature")
    name = F.get(F.array(*[F.lit(x) for x in names]), label) if names else F.when(label.isNotNull(), F.concat(F.lit("f"), label))
    side = F.when(F.col("depth") == 0, "root").when(F.col("path").endswith("L"), "left").otherwise("right")
    parent = F.when(F.col("depth") > 0, F.expr("substring(path, 1, length(path) - 1)"))
    return (numbered.withColumn("_p", parent).join(up, F.col("_p") == F.col("_up"), "left")
            .select("node", "parent", "depth", side.alias("branch"), name.alias("feature"), "threshold", "impurity", "n_samples",
                    "class_counts", majority().alias("prediction")))


def _leaf_finder(tree: DataFrame):
    """From lists of values to the class of the leaf that each reaches."""
    nodes = tree.orderBy("path").select("depth", "feature", "threshold", majority().alias("class")).toArrow()
    depth, right, waiting = nodes.column("depth").to_numpy(), np.zeros(len(nodes), np.int32), {}
    feature = pc.fill_null(nodes.column("feature"), -1).to_numpy()
    threshold, classes = (nodes.column(c).to_numpy() for c in ("threshold", "class"))
    # depth first: a left child follows its parent, the right one is the next of that depth
    for i, (d, f) in enumerate(zip(depth.tolist(), feature.tolist())):
        if d - 1 in waiting and waiting[d - 1] < i - 1 and not right[waiting[d - 1]]:
            right[waiting[d - 1]] = i
        waiting[d] = i
    sent = tree.sparkSession.sparkContext.broadcast((feature, threshold, right, classes))

    @F.arrow_udf("double")
    def leaf(lists: pa.Array) -> pa.Array:
        feature, threshold, right, classes = sent.value
        x = _matrix(lists)
        x = x if x.shape[1] else np.full((len(x), 1), np.nan)
        at, go = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(go := go[feature[at[go]] >= 0]):
            node = at[go]
            f = feature[node]
            v = np.where(f < x.shape[1], x[go, np.minimum(f, x.shape[1] - 1)], np.nan)
            at[go] = np.where(np.isnan(v) | (v <= threshold[node]), node + 1, right[node])
        return pa.array(classes[at])

    return leaf


def predict_tree(tree: DataFrame, rows: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
    """``rows`` with the class of the leaf that each reaches. The tree is sent
    to the rows; one of more than ``SENT_NODES`` nodes is joined level by level."""
    tree = cut_lineage(tree)
    n, depth = tree.agg(F.count(F.lit(1)), F.max("depth")).first()
    if 0 < n <= SENT_NODES:
        return rows.withColumn(out, _leaf_finder(tree)(F.col(features).cast("array<double>")))
    inner = _few(tree.where("feature is not null").select(F.col("path").alias("_path"), "feature", "threshold"), n)
    x = F.get(F.col(features).cast("array<double>"), F.col("feature"))
    left = x.isNull() | F.isnan(x) | (x <= F.col("threshold"))
    at = rows.withColumn("_path", F.lit(""))
    for _ in range(depth or 0):
        step = F.when(F.col("feature").isNull(), F.col("_path")).otherwise(
            F.concat("_path", F.when(left, "L").otherwise("R")))
        at = at.join(inner, "_path", "left").withColumn("_path", step).drop("feature", "threshold")
    leaf = _few(tree.select(F.col("path").alias("_path"), majority().alias(out)), n)
    return at.join(leaf, "_path", "left").drop("_path")
