"""Exact trees and softmax boosting against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import boosting as BO
from sparkprep.operators import trees as TR

ROWS = "id long, label int, features array<double>"


def entropy(counts):
    n = sum(counts)
    return -sum(c / n * math.log2(c / n) for c in counts if c)


def gini(counts):
    return 1 - sum((c / sum(counts)) ** 2 for c in counts)


def brute_tree(rows, k, impurity, path="", max_depth=None):
    """{path: (feature, threshold, counts)} by trying every split."""
    counts = [sum(y == j for _, y, _ in rows) for j in range(k)]
    best = None
    if max(counts) < len(rows) and (max_depth is None or len(path) < max_depth):
        for f in range(len(rows[0][2])):
            values = sorted({x[f] for _, _, x in rows})
            for lo, hi in zip(values, values[1:]):
                left = [sum(y == j and x[f] <= lo for _, y, x in rows) for j in range(k)]
                right = [a - b for a, b in zip(counts, left)]
                score = round((sum(left) * impurity(left) + sum(right) * impurity(right)) / len(rows), 12)
                if best is None or (score, f, lo) < best[:3]:
                    best = (score, f, lo, hi)
    if best is None:
        return {path: (None, None, counts)}
    _, f, lo, hi = best
    mid = (lo + hi) / 2
    out = {path: (f, lo if mid == hi else mid, counts)}
    out |= brute_tree([r for r in rows if r[2][f] <= lo], k, impurity, path + "L", max_depth)
    return out | brute_tree([r for r in rows if r[2][f] > lo], k, impurity, path + "R", max_depth)


def made(n, k, seed, values=6):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, 4)).astype(float)
    y = (x[:, 0] * 2 + x[:, 1] > values).astype(int) + (x[:, 2] > values / 2) * (k > 2)
    y = np.where(rng.random(n) < 0.1, rng.integers(0, k, n), y)
    return [(i, int(y[i]), x[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("k, criterion, depth", [(3, "entropy", None), (2, "gini", 2)])
def test_tree_equals_brute_force(spark, k, criterion, depth):
    rows = made(50, k, 5, 5)
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    tree = TR.grow_tree(df, k, criterion=criterion, max_depth=depth)
    want = brute_tree(rows, k, {"entropy": entropy, "gini": gini}[criterion], max_depth=depth)
    got = {r["path"]: (r["feature"], r["threshold"], r["class_counts"]) for r in tree.collect()}
    assert got == want
    table = TR.tree_table(tree).orderBy("node").collect()
    paths = sorted(want)
    for i, (r, p) in enumerate(zip(table, paths)):
        assert (r["node"], r["depth"], r["n_samples"]) == (i, len(p), sum(want[p][2]))
        assert r["parent"] == (paths.index(p[:-1]) if p else None)
    # every training row reaches a leaf that holds it
    out = TR.predict_tree(tree, df).collect()
    assert len(out) == len(rows)
    for r in out:
        p = ""
        while want[p][0] is not None:
            p += "L" if r["features"][want[p][0]] <= want[p][1] else "R"
        assert r["prediction"] == float(np.argmax(want[p][2]))


def test_tree_edges(spark):
    same = spark.createDataFrame([(1, 0, [1.0]), (2, 1, [1.0]), (3, 1, [1.0])], ROWS)
    assert [(r["feature"], r["class_counts"]) for r in TR.grow_tree(same, 2).collect()] == [(None, [1, 2])]
    gaps = spark.createDataFrame([(1, 0, [None, 2.0]), (2, 1, [5.0, float("nan")]), (3, None, [9.0, 9.0]), (4, 0, [None, 7.0])], ROWS)
    tree = TR.grow_tree(gaps, 2)
    assert sorted((r["path"], r["feature"], r["class_counts"]) for r in tree.collect()) == [
        ("", 0, [2, 1]), ("L", None, [2, 0]), ("R", None, [0, 1])]
    assert [r["prediction"] for r in TR.predict_tree(tree, gaps).orderBy("id").collect()] == [0.0, 1.0, 1.0, 0.0]
    assert TR.grow_tree(gaps.limit(0), 2).count() == 0


@pytest.mark.parametrize("local", [0, 12])
def test_small_nodes_are_grown_by_one_task(spark, monkeypatch, local):
    """The same tree however many nodes are grown locally; missing features and vectors too."""
    rows = made(40, 3, 4, 4) + [(90, 1, None), (91, 2, [None, 1.0]), (92, 0, [2.0, float("nan"), 1.0, 1.0])]
    df = spark.createDataFrame(rows, ROWS).repartition(2)
    passes = []
    monkeypatch.setattr(TR, "grouped_scan", lambda *a, f=TR.grouped_scan, **kw: passes.append(1) or f(*a, **kw))
    whole = sorted(map(tuple, TR.grow_tree(df, 3).collect()), key=lambda r: r[0])
    assert not passes  # no pass over the table for a tree of small nodes only
    monkeypatch.setattr(TR, "LOCAL_ROWS", local)
    parts = sorted(map(tuple, TR.grow_tree(df, 3, max_depth=None if local else 3).collect()), key=lambda r: r[0])
    assert passes
    if local:
        assert parts == whole
    else:
        assert [r for r in parts if r[1] < 3] == [r for r in whole if r[1] < 3]


def test_leaf_counts_in_sql(spark, duck):
    """Every inner node's counts are the sums of its children's, and leaves hold all rows."""
    rows = made(40, 3, 9, 4)
    df = TR.tree_table(TR.grow_tree(spark.createDataFrame(rows, ROWS), 3)).toPandas()
    df["c"] = df["class_counts"].map(lambda c: list(map(int, c)))
    duck.register("tree", df[["node", "parent", "n_samples"]])
    assert duck.execute("SELECT sum(n_samples) FROM tree t WHERE NOT EXISTS (SELECT 1 FROM tree c WHERE c.parent = t.node)"
                        ).fetchall() == [(40,)]
    assert duck.execute("SELECT count(*) FROM (SELECT p.node FROM tree p JOIN tree c ON c.parent = p.node "
                        "GROUP BY p.node, p.n_samples HAVING sum(c.n_samples) <> p.n_samples OR count(*) <> 2)").fetchall() == [(0,)]


def brute_boost(x, y, k, rounds, depth, step, lam=1.0, min_child=1.0):
    """Scores and losses of a plain booster over exact splits."""
    n = len(y)
    s, losses = np.zeros((n, k)), []

    def grow(rows, g, h, d):
        gt, ht = g[rows].sum(), h[rows].sum()
        best = None
        if d < depth:
            for f in range(x.shape[1]):
                present = rows[~np.isnan(x[rows, f])]
                gone = rows[np.isnan(x[rows, f])]
                for cut in sorted(set(x[~np.isnan(x[:, f]), f]))[1:]:
                    for side in (True, False):
                        l = present[x[present, f] < cut]
                        l = np.concatenate([l, gone]) if side else l
                        gl, hl = g[l].sum(), h[l].sum()
                        if hl < min_child or ht - hl < min_child:
                            continue
                        gain = round(gl ** 2 / (hl + lam) + (gt - gl) ** 2 / (ht - hl + lam) - gt ** 2 / (ht + lam), 9)
                        key = (-gain, f, cut, not side)
                        if gain > 1e-6 and (best is None or key < best[0]):
                            best = (key, l)
        if best is None:
            return [(rows, -step * gt / (ht + lam))]
        l = best[1]
        return grow(l, g, h, d + 1) + grow(np.setdiff1d(rows, l), g, h, d + 1)

    for _ in range(rounds):
        p = BO.softmax(s)
        losses.append(-np.log(p[np.arange(n), y]).mean())
        new = s.copy()
        for c in range(k):
            g, h = p[:, c] - (y == c), np.maximum(2 * p[:, c] * (1 - p[:, c]), 1e-16)
            for rows, w in grow(np.arange(n), g, h, 0):
                new[rows, c] += w
        s = new
    losses.append(-np.log(BO.softmax(s)[np.arange(n), y]).mean())
    return s, losses


def test_boosting_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (120, 3)).astype(float)
    y = np.clip((x[:, 0] + x[:, 1] > 9).astype(int) + (x[:, 2] > 7) + (rng.random(120) < 0.1), 0, 2)
    x[rng.random(x.shape) < 0.1] = np.nan
    rows = [(i, int(y[i]), [None if np.isnan(v) and i % 2 else float(v) for v in x[i]]) for i in range(len(y))]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    model = BO.boost(df, 3, 3, rounds=11, depth=2)  # scores are written out once in between
    s, losses = brute_boost(x, y, 3, 11, 2, 0.3)
    assert np.allclose(model.losses, losses, atol=1e-9)
    assert all(a > b for a, b in zip(model.losses, model.losses[1:]))
    got = {r["id"]: (r["probabilities"], r["prediction"]) for r in BO.predict(BO.from_json(BO.to_json(model)), df).collect()}
    p = BO.softmax(s)
    for i in range(len(y)):
        assert np.allclose(got[i][0], p[i], atol=1e-9) and got[i][1] == s[i].argmax()
    table = model.table(spark)
    assert table.where("feature is null").groupBy("round", "class").count().count() == 33
    assert model.loss_table(spark).count() == 12


def test_quantile_bins_follow_the_rows(spark):
    df = spark.range(4000).select(F.array((F.col("id") % 1000).cast("double"), F.lit(1.0), F.lit(None).cast("double")).alias("features"))
    cuts = BO.bin_cuts(df, 3, "features", 16)
    assert len(cuts[0]) == 15 and len(cuts[1]) == 0 and len(cuts[2]) == 0
    sizes = np.diff([0, *cuts[0], 1000])
    assert sizes.max() <= 1000 / 16 + 1


def test_a_large_node_is_grown_by_one_task_and_a_deep_tree_predicts_in_one_step(spark, monkeypatch):
    """No pass over the table for 2,000 rows, and a plan without a join a level; the same rows as by joins."""
    rng = np.random.default_rng(8)
    x, y = rng.integers(0, 400, (2000, 3)).astype(float), rng.integers(0, 3, 2000)
    rows = [(i, int(c), [None if v == 7 else float(v) for v in r][:3 if i % 50 else 1]) for i, (c, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame([*rows, (2001, 1, None), (2002, 0, [float("nan"), 5.0, None])], ROWS).repartition(3)
    monkeypatch.setattr(TR, "grouped_scan", lambda *a, **kw: pytest.fail("a pass over the table"))
    tree = TR.grow_tree(df, 3)
    depth = tree.agg(F.max("depth")).first()[0]
    assert depth > 8
    out = TR.predict_tree(tree, df)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    small = TR.grow_tree(df, 3, max_depth=4).localCheckpoint()
    sent = {r["id"]: r["prediction"] for r in TR.predict_tree(small, df).collect()}
    monkeypatch.setattr(TR, "SENT_NODES", 0)
    assert {r["id"]: r["prediction"] for r in TR.predict_tree(small, df).collect()} == sent and len(sent) == 2002
    got = {r["id"]: r["prediction"] for r in out.collect()}
    leaves = {r["path"]: r for r in tree.collect()}
    for i, _, v in rows[::17]:
        p = ""
        while leaves[p]["feature"] is not None:
            f = leaves[p]["feature"]
            here = v[f] if f < len(v) else None
            p += "L" if here is None or here <= leaves[p]["threshold"] else "R"
        assert got[i] == float(np.argmax(leaves[p]["class_counts"]))
