"""Gradient boosted trees for several classes with one softmax.

Every row has one vector of scores, a score a class. A round fits a tree a
class to the first and second derivatives of the joint softmax loss at those
scores (so the classes' trees of a round belong together, unlike one-vs-rest)
and adds its leaves, times the step, to the scores.

Features are cut once into at most ``max_bins`` bins: at every distinct value
where there are so few, else at quantiles from the ranked count table. Rows
that agree in all bins and in the label are one row with a weight. A pass
sums the derivatives by (class tree, node, feature, bin), within the task
first; what comes together is at most classes x open nodes x features x bins
sums, whatever the number of rows, from which the driver picks the splits.
All trees of a level share a pass. Scores are written out every
``KEEP_ROUNDS`` rounds; in between a pass applies the trees since then.

Settings and formulas follow the usual second-order booster: gain of a split
G_l^2/(H_l+lambda) + G_r^2/(H_r+lambda) - G^2/(H+lambda), leaf weight
-G/(H+lambda), h = 2p(1-p), children of at least ``min_child`` second order
weight, and missing values (null, NaN) on the side of the larger gain. Gains
are compared to 9 digits; ties go to the smallest feature, bin and then to
missing values on the left.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .stats import ranked_values

KEEP_ROUNDS = 10
MIN_GAIN = 1e-6


@dataclass
class Booster:
    """Cuts by feature, and for each round and class a tree: arrays by node
    (children of node i: 2i + 1, 2i + 2) of feature (-1: leaf), bin, side of
    missing values and leaf weight."""
    classes: int
    cuts: list[np.ndarray]
    trees: list[list[dict]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def table(self, spark) -> DataFrame:
        """``(round, class, node, feature, threshold, missing_left, weight)``;
        a row goes left if its value is under the threshold."""
        rows = []
        for r, trees in enumerate(self.trees):
            for c, t in enumerate(trees):
                for n in np.flatnonzero(t["used"]):
                    f = int(t["feature"][n])
                    rows.append((r, c, int(n), f if f >= 0 else None, float(self.cuts[f][t["bin"][n]]) if f >= 0 else None,
                                 bool(t["left"][n]) if f >= 0 else None, None if f >= 0 else float(t["weight"][n])))
        return spark.createDataFrame(rows, "round int, class int, node int, feature int, threshold double, "
                                           "missing_left boolean, weight double")

    def loss_table(self, spark) -> DataFrame:
        """``(round, loss)``: mean training loss before each round and after the last."""
        return spark.createDataFrame(list(enumerate(self.losses)), "round int, loss double")


def bin_cuts(rows: DataFrame, n_features: int, features: str, max_bins: int) -> list[np.ndarray]:
    """Ascending lower ends of the bins 1, 2, ... of each feature (bin 0 is
    below the first)."""
    wide = rows.select(*[F.get(features, F.lit(j)).alias(f"x{j}") for j in range(n_features)])
    ranked = cut_lineage(ranked_values(wide, [f"x{j}" for j in range(n_features)]))
    sizes = ranked.groupBy("column").agg(F.count(F.lit(1)).alias("d"), F.max("cum").alias("total"))
    # a value opens a bin where its first row does: at most max_bins a feature
    first = F.col("cum") - F.col("n")
    slot = F.floor(first * F.lit(max_bins) / F.col("total"))
    opens = ranked.join(F.broadcast(sizes), "column").withColumn(
        "slot", F.when(F.col("d") <= max_bins, F.lit(None)).otherwise(slot)).groupBy(
        "column", F.coalesce(F.col("slot").cast("double"), F.col("value")).alias("g")).agg(F.min("value").alias("v"))
    found = {f"x{j}": [] for j in range(n_features)}
    for r in opens.select("column", "v").toLocalIterator():
        found[r["column"]].append(r["v"])
    return [np.array(sorted(found[f"x{j}"])[1:]) for j in range(n_features)]


def _binned(batches, cuts):
    """Bins of each row: 0 missing, else 1 + bin."""
    for batch in batches:
        x = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, len(cuts))
        out = np.empty(x.shape, ">u2")
        for j, c in enumerate(cuts):
            out[:, j] = np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(c, x[:, j], side="right"))
        rest = [n for n in batch.schema.names if n != "x"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in rest] + [pa.array([r.tobytes() for r in out], pa.binary())],
                                         names=rest + ["bins"])


def bin_rows(rows: DataFrame, cuts, features: str, keep: list[str]) -> DataFrame:
    x = F.col(features).cast("array<double>")
    source = rows.select(*keep, F.array(*[F.coalesce(F.get(x, F.lit(j)), F.lit(float("nan"))) for j in range(len(cuts))]).alias("x"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in source.dtypes if c != "x"), "bins binary"])
    return source.mapInArrow(lambda it: _binned(it, cuts), schema)


def _unpack(batch, n_features):
    col = batch.column(batch.schema.get_field_index("bins"))
    return np.frombuffer(b"".join(col.to_pylist()), ">u2").reshape(-1, n_features).astype(np.int64)


def _leaf_of(tree, bins):
    """Node in which each row ends."""
    at = np.zeros(len(bins), np.int64)
    while True:
        f = tree["feature"][at]
        go = np.flatnonzero(f >= 0)
        if not len(go):
            return at
        b = bins[go, f[go]]
        left = np.where(b == 0, tree["left"][at[go]], b <= tree["bin"][at[go]] + 1)
        at[go] = 2 * at[go] + np.where(left, 1, 2)


def _add(scores, trees, bins):
    for c, tree in enumerate(trees):
        scores[:, c] += tree["weight"][_leaf_of(tree, bins)]
    return scores


def _scores(batch, k, trees, bins):
    s = batch.column(batch.schema.get_field_index("scores")).flatten().to_numpy().reshape(-1, k).copy()
    for r in trees:
        _add(s, r, bins)
    return s


def softmax(s):
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _sums(batches, k, sizes, since, growing, low):
    """Derivative sums of the open nodes (numbers from ``low`` on) of this
    task's rows; feature -1 carries the loss and the weight."""
    width = low + 1
    offs = np.concatenate([[0], np.cumsum(sizes)])
    total = np.zeros((k, width, offs[-1], 2))
    loss = np.zeros(2)
    for batch in batches:
        if not batch.num_rows:
            continue
        bins = _unpack(batch, len(sizes))
        y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy().astype(np.float64)
        p = softmax(_scores(batch, k, since, bins))
        loss += [-(w * np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))).sum(), w.sum()]
        for c in range(k):
            node = _leaf_of(growing[c], bins) - low if growing else np.zeros(len(y), np.int64)
            on = np.flatnonzero(node >= 0)
            g = w * (p[:, c] - (y == c))
            h = w * np.maximum(2 * p[:, c] * (1 - p[:, c]), 1e-16)
            cell = node[on, None] * offs[-1] + offs[:-1] + bins[on]
            for a, v in enumerate((g, h)):
                total[c, :, :, a] += np.bincount(cell.ravel(), np.repeat(v[on], len(sizes)), width * offs[-1]).reshape(
                    width, offs[-1])
    c, n, b = np.nonzero(total[:, :, :, 1])
    v = total[c, n, b]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(c, -1), pa.int32()), pa.array(np.append(n, 0), pa.int32()), pa.array(np.append(b, 0), pa.int32()),
         pa.array(np.append(v[:, 0], loss[0])), pa.array(np.append(v[:, 1], loss[1]))], names=["c", "n", "b", "g", "h"])


def _best_split(g, h, sizes, lam, min_child):
    """(gain, feature, bin, missing left) of one node, or None."""
    offs = np.concatenate([[0], np.cumsum(sizes)])
    gt, ht = g[:offs[1]].sum(), h[:offs[1]].sum()
    parent = gt * gt / (ht + lam)
    best = None
    for f, (a, b) in enumerate(zip(offs, offs[1:])):
        gl, hl = np.cumsum(g[a + 1:b])[:-1], np.cumsum(h[a + 1:b])[:-1]
        for side, (gm, hm) in ((True, (g[a], h[a])), (False, (0.0, 0.0))):
            l, r = (gl + gm, hl + hm), (gt - gl - gm, ht - hl - hm)
            if not len(gl):
                continue
            gain = l[0] ** 2 / (l[1] + lam) + r[0] ** 2 / (r[1] + lam) - parent
            gain = np.round(np.where((l[1] >= min_child) & (r[1] >= min_child), gain, -np.inf), 9)
            j = int(np.argmax(gain))
            if gain[j] > MIN_GAIN and (best is None or gain[j] > best[0] or (gain[j] == best[0] and (f, j) < best[1:3])):
                best = (float(gain[j]), f, j, side)
    return best


def boost(rows: DataFrame, classes: int, n_features: int, label: str = "label", features: str = "features", rounds: int = 100,
          depth: int = 6, step: float = 0.3, lam: float = 1.0, min_child: float = 1.0, max_bins: int = 256) -> Booster:
    """Fit; ``label`` holds classes 0 to ``classes`` - 1 (rows without one are
    left out), ``features`` an array of ``n_features`` doubles."""
    rows = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("y"),
                                                       F.col(features).cast("array<double>").alias("x"))
    cuts = bin_cuts(rows, n_features, "x", max_bins)
    sizes = [len(c) + 2 for c in cuts]  # missing, and one more bin than cuts
    model = Booster(classes, cuts)
    zero = F.array(*[F.lit(0.0)] * classes)
    data = cut_lineage(bin_rows(rows, cuts, "x", ["y"]).groupBy("bins", "y").agg(F.count(F.lit(1)).alias("w"))
                       .withColumn("scores", zero))
    since: list = []

    def sums(growing, low):
        out = data.mapInArrow(lambda it: _sums(it, classes, sizes, since, growing, low),
                              "c int, n int, b int, g double, h double").groupBy("c", "n", "b").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        c, n, b, g, h = (out.column(x).to_numpy() for x in ("c", "n", "b", "g", "h"))
        table = np.zeros((classes, low + 1, sum(sizes), 2))
        on = c >= 0
        table[c[on], n[on], b[on], 0], table[c[on], n[on], b[on], 1] = g[on], h[on]
        return table, (g[~on].sum(), h[~on].sum())

    def blank():
        n = (2 << depth) - 1
        return {"feature": np.full(n, -1), "bin": np.zeros(n, np.int64), "left": np.zeros(n, bool), "weight": np.zeros(n),
                "used": np.zeros(n, bool)}

    for _ in range(rounds):
        growing = [blank() for _ in range(classes)]
        for t in growing:
            t["used"][0] = True
        for d in range(depth + 1):
            low = (1 << d) - 1
            if not any(t["used"][low:2 * low + 1].any() for t in growing):
                break
            table, (loss, weight) = sums(growing, low)
            if d == 0:
                model.losses.append(float(loss / max(weight, 1.0)))
            for c, t in enumerate(growing):
                for n in np.flatnonzero(t["used"][low:2 * low + 1]):
                    g, h = table[c, n, :, 0], table[c, n, :, 1]
                    best = _best_split(g, h, sizes, lam, min_child) if d < depth else None
                    at = low + n
                    if best is None:
                        t["weight"][at] = -step * g[:sizes[0]].sum() / (h[:sizes[0]].sum() + lam)
                    else:
                        _, t["feature"][at], t["bin"][at], t["left"][at] = best
                        t["used"][[2 * at + 1, 2 * at + 2]] = True
        model.trees.append(growing)
        since.append(growing)
        if len(since) == KEEP_ROUNDS:
            data = cut_lineage(_rescored(data, classes, n_features, list(since)))
            since = []
    loss, weight = sums([blank() for _ in range(classes)], 0)[1]
    model.losses.append(float(loss / max(weight, 1.0)))
    return model


def _rescored(data: DataFrame, classes: int, n_features: int, trees) -> DataFrame:
    def run(batches):
        for batch in batches:
            s = _scores(batch, classes, trees, _unpack(batch, n_features))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, s.size + 1, classes, dtype=np.int32)), pa.array(s.ravel()))
            yield batch.set_column(batch.schema.get_field_index("scores"), "scores", flat)
    return data.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in data.dtypes))


def predict(model: Booster, rows: DataFrame, features: str = "features") -> DataFrame:
    """``rows`` with ``probabilities`` (an array) and ``prediction`` (the
    class of the highest score, the smallest among ties)."""
    k, cuts, trees = model.classes, model.cuts, model.trees
    kept = [c for c in rows.columns if c != features]
    zero = F.array(*[F.lit(0.0)] * k)
    data = bin_rows(rows, cuts, features, kept).withColumn("scores", zero)

    def run(batches):
        for batch in batches:
            s = _scores(batch, k, trees, _unpack(batch, len(cuts)))
            p = softmax(s) if len(s) else s
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, k, dtype=np.int32)), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in range(len(kept))] + [
                flat, pa.array(s.argmax(1).astype(np.float64) if len(s) else np.empty(0))],
                names=kept + ["probabilities", "prediction"])

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.select(*kept).dtypes)
    return data.mapInArrow(run, f"{schema}, probabilities array<double>, prediction double")


def to_json(model: Booster) -> str:
    """The model as text (``from_json`` reads it back)."""
    return json.dumps({"classes": model.classes, "cuts": [c.tolist() for c in model.cuts], "losses": model.losses,
                       "trees": [[{n: v.tolist() for n, v in t.items()} for t in r] for r in model.trees]})


def from_json(text: str) -> Booster:
    d = json.loads(text)
    kind = {"feature": np.int64, "bin": np.int64, "left": bool, "weight": np.float64, "used": bool}
    return Booster(d["classes"], [np.array(c, np.float64) for c in d["cuts"]],
                   [[{n: np.array(v, kind[n]) for n, v in t.items()} for t in r] for r in d["trees"]], d["losses"])
