"""Pivot k-NN and quadtree geocoding against brute force."""

from collections import Counter

import numpy as np
import pytest

from sparkprep.operators import geo as G
from sparkprep.operators import knn as K
from sparkprep.operators import neighbours as NB


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 50, (6, 3))
    which = rng.integers(0, 6, n)
    return (centre[which] + rng.normal(0, 1, (n, 3))).round(3), which


def brute_knn(q, x, y, k):
    out = {}
    for i, v in enumerate(q):
        d = np.round(np.sqrt(np.cumsum((x - v) ** 2, axis=1)[:, -1]), 9)
        near = Counter(y[j] for j in np.lexsort((y, d))[:k])
        out[i] = min(((-c, label) for label, c in near.items()))[::-1] if len(y) else None
    return out


@pytest.mark.parametrize("pivots, ring_rows, k", [(256, 4096, 1), (12, 8, 5)])
def test_knn_equals_brute_force(spark, pivots, ring_rows, k):
    x, which = clustered(240, 1)
    x = np.concatenate([x, np.repeat(x[:1], 60, 0), x[5:25]])  # equal rows, and equal vectors of another label
    y = np.concatenate([which, np.repeat(which[:1], 60), which[5:25] + 1])
    q, _ = clustered(60, 1)
    train = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)] + [(None, 1)], "v array<double>, label int")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)] + [(999, None)], "id long, v array<double>")
    got = NB.knn_classify(queries, train, "id", "v", "label", k, pivots=pivots, ring_rows=ring_rows)
    want = brute_knn(q, x, y, k)
    assert {r["id"]: (r["pred"], -r["votes"]) for r in got.collect()} == want


def test_knn_visits_few_rings(spark):
    x, which = clustered(600, 3)
    q, _ = clustered(50, 3)
    train = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, which)], "v array<double>, y int")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "key long, v array<double>")
    _, first, second = K.visits(queries, train, 3, pivots=24, ring_rows=10)
    rings = 600 // 10
    assert first.count() == 50
    assert first.count() + second.count() < 50 * rings / 4


def test_knn_of_small_or_empty_tables(spark):
    queries = spark.createDataFrame([(1, [0.0]), (2, [5.0])], "id long, v array<double>")
    train = spark.createDataFrame([([1.0], 4)], "v array<double>, label int")
    got = NB.knn_classify(queries, train, "id", "v", "label", 3)  # fewer rows than k
    assert sorted((r["id"], r["pred"], r["votes"]) for r in got.collect()) == [(1, 4, 1), (2, 4, 1)]
    assert NB.knn_classify(queries, train.limit(0), "id", "v", "label").count() == 0
    assert NB.knn_classify(queries.limit(0), train, "id", "v", "label").count() == 0


def haversine(a, b, c, d):
    p, q = np.radians(a), np.radians(c)
    h = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin((np.radians(d) - np.radians(b)) / 2) ** 2
    return 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(h, 1)))


def globe(n, seed):
    rng = np.random.default_rng(seed)
    lat = np.concatenate([rng.uniform(-90, 90, n), 48.85 + rng.normal(0, 2.0, n), rng.choice([89.9, -89.95, 90, -90], n // 4)])
    lng = np.concatenate([rng.uniform(-180, 180, n), 2.35 + rng.normal(0, 2.0, n), rng.uniform(-180, 180, n // 4)])
    edge = rng.uniform(-60, 60, n // 4), rng.choice([179.99, -179.99, 180.0, -180.0], n // 4)
    return np.concatenate([lat, edge[0]]), np.concatenate([lng, edge[1]])


@pytest.mark.parametrize("cell_places", [8])
def test_geocoding_equals_brute_force(spark, cell_places):
    glat, glng = globe(30, 1)
    names = [f"p{i % 140}" for i in range(len(glat))]
    lat, lng = globe(16, 2)
    places = spark.createDataFrame([(n, float(a), float(b)) for n, a, b in zip(names, glat, glng)] + [
        ("p0", float(glat[5]), float(glng[5])), ("nowhere", None, 1.0)], "name string, lat double, lng double")
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lng))] + [
        (1000, None, 1.0), (0, float(lat[0]), float(lng[0]))], "k long, plat double, plng double")
    got = NB.geocode_reverse(pts, "plat", "plng", places, cell_places=cell_places).collect()
    assert len(got) == len(lat) + 2
    all_names = np.array(names + ["p0"])
    alat, alng = np.append(glat, glat[5]), np.append(glng, glng[5])
    for r in got:
        if r["plat"] is None:
            assert r["place"] is None and r["distance_km"] is None
            continue
        d = haversine(r["plat"], r["plng"], alat, alng)
        assert abs(r["distance_km"] - d.min()) < 2e-6
        assert r["place"] in all_names[d <= d.min() + 2e-6]


def test_dense_cells_split(spark):
    glat, glng = globe(80, 5)
    places = spark.createDataFrame([(f"p{i}", float(a), float(b)) for i, (a, b) in enumerate(zip(glat, glng))],
                                   "place string, glat double, glng double").dropDuplicates(["glat", "glng"])
    cells, leaves, deepest = G.cells_of(places.select("*", *G._cell("glat", "glng")), 8)
    assert deepest > 3
    assert leaves.count() == places.count()
    assert max(r["count"] for r in leaves.groupBy("level", "cx", "cy").count().collect()) <= 8
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(*globe(12, 6)))],
                                "_rid long, _lat double, _lng double")
    assert G.candidate_leaves(pts, cells, deepest).count() < 8 * pts.count()


def test_knn_comparison_takes_only_what_the_reach_allows():
    """The matrix product picks rows; distances, ties and copies are as in full."""
    import numpy as np
    import pyarrow as pa
    from sparkprep.operators import knn as KN
    rng = np.random.default_rng(5)
    ring = np.round(rng.normal(size=(300, 6)), 1) * 50
    ring[200:] = ring[:100]  # ties
    query = np.concatenate([ring[:40], rng.normal(size=(20, 6)) * 50])
    y, n = rng.integers(0, 4, 300), rng.integers(1, 3, 300)
    exact = KN._distances(query, ring)
    assert np.abs(KN._far(query, ring) - exact).max() < KN.SLACK / 10
    right = pa.table({"v": pa.array(ring.tolist()), "y": y, "n": n})
    for reach in (np.full(60, np.inf), np.sort(exact, axis=1)[:, 2]):
        left = pa.table({"key": np.arange(60), "v": pa.array(query.tolist()), "reach": reach})
        got = KN._nearest(left, right, 3)
        for q in range(60):
            order = np.lexsort((y, exact[q]))[:3]
            order = order[:int(np.searchsorted(np.cumsum(n[order]), 3)) + 1]
            mine = [(d, c) for k, d, c in zip(*(got.column(x).to_pylist() for x in ("key", "dist", "y"))) if k == q]
            assert mine == [(exact[q, r], y[r]) for r in order]
