"""Forests against brute force, pyspark's bins and other ways of running."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.operators import forest as FO
from sparkprep.operators import ml as ML

ROWS = "id long, label double, x array<double>"


def made(n, k, seed, d=4, values=12):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)) * values / 4) / 2
    y = (x[:, 0] + x[:, 1] > 0).astype(int) + (x[:, 2] > 1) * (k > 2)
    y = np.where(rng.random(n) < 0.2, rng.integers(0, k, n), y)
    return [(i, float(y[i]), x[i].tolist()) for i in range(n)]


def table(spark, rows, parts=3):
    return ML.vectorize(spark.createDataFrame(rows, ROWS).repartition(parts), array_col="x")


def nodes(model):
    """{(tree, place): (feature, bin) or leaf counts}."""
    top, small, out = model.top, {r["node"]: r for r in model.small.collect()}, {}

    def walk(tree, place, i, feature, cut, child, leaf):
        if feature[i] == FO.LOCAL:
            if i not in small:
                return
            r = small[i]
            f, c, h = (np.frombuffer(r[x], t) for x, t in (("feature", "<i4"), ("bin", "u1"), ("child", "<i4")))
            counts, number = np.frombuffer(r["leaves"], "<i8").reshape(-1, model.settings.classes), np.cumsum(f < 0) - 1
            walk(tree, place, 0, f, c, h, lambda j: counts[number[j]])
        elif feature[i] < 0:
            out[tree, place] = tuple(leaf(i).tolist())
        else:
            out[tree, place] = int(feature[i]), int(cut[i])
            for side in (0, 1):
                walk(tree, 2 * place + side, child[i] + side, feature, cut, child, leaf)

    for t in range(model.settings.trees):
        walk(t, 1, t, top.feature, top.bin, top.child, lambda j: top.counts[j])
    return out


def brute(s, tree, place, rows):
    """The same for the rows ``(bins, class, weight)`` under a node, by trying every split."""
    counts = [sum(w for _, y, w in rows if y == j) for j in range(s.classes)]
    square = lambda part: sum(sum(w for _, y, w in part if y == j) ** 2 for j in range(s.classes)) / sum(w for *_, w in part)
    best = None
    if max(counts) < sum(counts) and place.bit_length() <= s.max_depth:
        for f in FO._drawn_features(s, [tree], [place])[0].tolist():
            for cut in sorted({b[f] for b, *_ in rows})[:-1]:
                left, right = [r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut]
                gain = round((square(left) + square(right) - square(rows)) / sum(counts), 12)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, f, cut, left, right
    if best is None:
        return {(tree, place): tuple(counts)}
    sides = [brute(s, tree, 2 * place + i, part) for i, part in enumerate(best[3:])]
    if all(len(x) == 1 for x in sides) and len({int(np.argmax(c)) for x in sides for c in x.values()}) == 1:
        return {(tree, place): tuple(counts)}
    return {(tree, place): best[1:3]} | sides[0] | sides[1]


@pytest.mark.parametrize("k, depth, local", [(3, 30, 8_000_000), (3, 30, 60), (2, 3, 40)])
def test_forest_equals_brute_force(spark, monkeypatch, k, depth, local):
    """Grown by one task a tree, or by passes down to nodes of a few rows."""
    monkeypatch.setattr(FO, "LOCAL_CELLS", local)
    monkeypatch.setattr(FO, "PASS_BYTES", 8_000)  # open nodes share several passes
    rows = made(90, k, 3) + made(20, k, 3)  # some rows come twice
    df = table(spark, rows)
    model = ML.random_forest(trees=4, max_depth=depth).fit(df)
    s, groups = model.settings, {}
    seen = FO._with_bins(df, FO.vector_to_array("features"), model.cuts).groupBy("_bins", F.col("label").cast("int").alias("y")).agg(
        F.count(F.lit(1)).alias("w")).withColumn("h", F.xxhash64("_bins", "y")).toPandas()
    weights = FO._drawn_weights(s, seen["h"].to_numpy(), seen["w"].to_numpy())
    for i, (b, y) in enumerate(zip(seen["_bins"], seen["y"])):
        for t in range(s.trees):
            if weights[i, t]:
                groups.setdefault(t, []).append((tuple(b), y, int(weights[i, t])))
    want = {}
    for t, part in groups.items():
        want |= brute(s, t, 1, part)
    got = nodes(model)
    assert got == want and model.n_nodes == len(want)
    assert (len(model.top.feature) > s.trees) == (local < 1000)
    # votes: the class shares of the leaf of each tree
    bins = {r["id"]: tuple(r["_bins"]) for r in FO._with_bins(df, FO.vector_to_array("features"), model.cuts).collect()}
    monkeypatch.setattr(FO, "SCORE_ROWS", 10)
    out = model.transform(df).collect()
    assert sorted(r["id"] for r in out) == sorted(r[0] for r in rows)
    for r in out:
        votes = np.zeros(k)
        for t in range(s.trees):
            place = 1
            while place.bit_length() <= depth and (t, 2 * place) in want:
                f, cut = want[t, place]
                place = 2 * place + int(bins[r["id"]][f] > cut)
            votes += np.array(want[t, place]) / sum(want[t, place])
        assert np.allclose(r["rawPrediction"].toArray(), votes, atol=1e-9)
        assert np.allclose(r["probability"].toArray(), votes / s.trees, atol=1e-9)
        assert votes[int(r["prediction"])] == pytest.approx(votes.max())


def test_bins_are_those_of_pyspark(spark):
    """Thresholds of pyspark's forest are among ours: few values, many, and heavy ones."""
    rng = np.random.default_rng(1)
    x = np.stack([rng.integers(0, 9, 400), rng.normal(size=400), np.where(rng.random(400) < 0.5, 0.0, rng.normal(size=400)),
                  np.minimum(rng.geometric(0.05, 400), 90), np.ones(400)], 1)
    df = table(spark, [(i, float(rng.integers(0, 3)), r.tolist()) for i, r in enumerate(x)])
    theirs = RandomForestClassifier(numTrees=40, seed=1, maxDepth=8).fit(df)
    cuts = ML.random_forest(trees=1).fit(df).cuts
    seen = {}
    for line in theirs.toDebugString.splitlines():
        if "If (feature" in line:
            f, cut = line.split("feature ")[1].rstrip(")").split(" <= ")
            seen.setdefault(int(f), set()).add(float(cut))
    assert set(seen) == {0, 1, 2, 3}
    for f, found in seen.items():
        assert found <= set(cuts[f].tolist())
        assert len(found) >= 0.9 * len(cuts[f])
    assert [len(c) for c in cuts][:2] == [8, 31] and len(cuts[4]) == 0


def test_forest_does_not_move_with_the_layout(spark):
    """Before, bootstrap draws followed the partitions and passes followed the number of nodes."""
    rows = made(300, 3, 8)
    test = table(spark, made(100, 3, 9))

    def run(parts):
        model = ML.random_forest(trees=10).fit(table(spark, rows[::-1] if parts == 1 else rows, parts))
        return [(r["id"], r["prediction"], tuple(r["probability"])) for r in model.transform(test).orderBy("id").collect()]
    assert run(1) == run(5)


def test_forest_learns_as_pysparks(spark):
    train, test = table(spark, made(1500, 3, 11)), table(spark, made(600, 3, 12))
    share = lambda m: m.transform(test).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    theirs = RandomForestClassifier(numTrees=100, seed=42, featureSubsetStrategy="sqrt", maxDepth=30).fit(train)
    ours = ML.random_forest().fit(train)
    assert abs(share(ours) - share(theirs)) < 0.03
    assert abs(ours.n_nodes / theirs.totalNumNodes - 1) < 0.05


@pytest.mark.parametrize("row, said", [((1, None, [1.0, 2.0]), "Labels MUST NOT be Null"), ((1, 0.5, [1.0, 2.0]), "Labels MUST be Integers"),
                                       ((1, 1.0, None), "Vectors MUST NOT be Null"), ((1, 1.0, [float("nan"), 2.0]), "NaN or Infinity")])
def test_rows_that_cannot_be_learnt_are_errors(spark, row, said):
    rows = [(i, y, None if x is None else Vectors.dense(x)) for i, y, x in [(0, 0.0, [1.0, 1.0]), row]]
    schema = T.StructType().add("id", "long").add("label", "double").add("features", VectorUDT())
    df = spark.createDataFrame(rows, schema)
    with pytest.raises(Exception, match=said):
        ML.random_forest(trees=2).fit(df)


def test_equal_rows_and_one_class(spark):
    """Nodes without a split; a tree on which no draw falls has no vote."""
    same = table(spark, [(0, 0.0, [1.0]), (1, 1.0, [1.0]), (2, 1.0, [1.0])])
    model = ML.random_forest(trees=50).fit(same)
    assert {r["prediction"] for r in model.transform(same).collect()} == {1.0}
    one = table(spark, [(0, 1.0, [1.0])])
    out = ML.random_forest(trees=20).fit(one).transform(one).first()
    assert out["prediction"] == 1.0 and 0 < out["rawPrediction"][1] < 20 and out["probability"][1] == 1.0
