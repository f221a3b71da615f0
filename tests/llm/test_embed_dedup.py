import numpy as np

from sparkprep.llm import embed_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    ok = [v is not None and len(v) > 0 and label is not None and None not in v and np.isfinite(np.array(v, float)).all()
          and any(v) for _, v, label in rows]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if k else None
            for k, (_, v, _) in zip(ok, rows)]
    n = len(rows)
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * n
    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and (
                    unit[a] @ unit[b] >= threshold):
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    out = []
    for a in range(n):
        c = min(rows[b][0] for b in range(n) if root(b) == root(a))
        out.append((rows[a][0], links[a], c, rows[a][0] == c))
    return sorted(out)


def run(spark, rows, **o):
    df = spark.createDataFrame([(i, v, k, "x") for i, v, k in rows], SCHEMA + ", rep string")
    return sorted(tuple(r) for r in E.near_duplicates(df, **o).collect())


def vectors(n=260, dim=12, seed=2):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(25, dim)) * np.linspace(2, .2, dim)
    rows = []
    for k in range(n):
        v = (centres[rnd.integers(25)] + rnd.normal(size=dim) * .12).astype(np.float32)
        rows.append((int(k * 7 % 1009), [float(x) for x in v], int(rnd.integers(3))))
    rows += [(2000 + k, rows[k][1], rows[k][2]) for k in range(0, 60, 3)]
    return rows


def test_brute_force_in_small_tiles(spark):
    rows = vectors()
    assert run(spark, rows, tile=32) == brute(rows)


def test_one_hot_label(spark):
    rows = [(i, v, 1) for i, v, _ in vectors(150)]
    assert run(spark, rows, tile=16) == brute(rows)


def test_edge_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1),
            (6, [1.0, 0.0], 1), (7, [2.0, 0.0], 1), (8, [1.0, 0.0], 2), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 1),
            (11, [-1.0, 0.0], 1), (12, [], 1), (13, [1e-30, 0.0], 1), (14, [1e30, 1e29], 1), (15, [1.0, 0.0], 2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_repeated_rows_are_separate_vectors(spark):
    got = run(spark, [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_bounds_lose_nothing():
    rnd = np.random.default_rng(3)
    for dim in (3, 16, 40):
        x, y = rnd.normal(size=(90, dim)), rnd.normal(size=(70, dim))
        y[:40] = x[:40] + rnd.normal(size=(40, dim)) * .25
        axes = np.linalg.eigh((x.T @ x))[1][:, ::-1]
        i, j = E.tile_links(x, y, axes, .9, False, step=4, block=16)
        cos = E._unit(x) @ E._unit(y).T
        assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(cos >= .9)))


def test_classes_of_null_ids_link(spark):
    rows = [(None, 1, [1.0, 0.0]), (2, 1, [1.0, 0.001]), (None, 2, [0.0, 1.0]), (None, 2, [0.0, 1.0]), (5, 3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in E.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 1, 2, False), (2, 1, 2, True), (None, 1, None, True), (None, 1, None, True), (5, 0, 5, True)], key=str)
