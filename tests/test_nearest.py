"""Nearest query by impact bounds and the similarity join against brute force."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import nearest as NQ
from sparkprep.operators import simjoin as SJ


def made(n, m, seed):
    """Documents and queries over a skewed vocabulary, with copies and ties."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(60)]
    p = 1 / np.arange(1, 61)
    draw = lambda size: Counter(rng.choice(words, size, p=p / p.sum()).tolist())
    docs = {i: draw(rng.integers(1, 40)) for i in range(n)}
    docs |= {n + i: docs[i] for i in range(n // 3)}
    queries = {100 + i: draw(rng.integers(1, 12)) for i in range(m)}
    queries |= {500 + i: queries[100 + i] for i in range(3)}
    docs[9_999] = Counter({"unknown": 3})
    return docs, queries, {w: 1.0 + math.log(2 + k) for k, w in enumerate(words)} | {"unknown": 2.0}


def tables(spark, docs, queries, idf):
    tf = spark.createDataFrame([(d, w, n) for d, c in docs.items() for w, n in c.items()], "doc_id long, token string, tf long")
    qf = spark.createDataFrame([(d, w, n) for d, c in queries.items() for w, n in c.items()], "query long, token string, tf long")
    return tf, qf, spark.createDataFrame(list(idf.items()), "token string, idf double")


@pytest.mark.parametrize("block_postings, docs_per_task", [(1 << 18, 2_000), (30, 7)])
def test_nearest_query_equals_brute_force(spark, block_postings, docs_per_task):
    docs, queries, idf = made(60, 25, 3)
    weigh = lambda c: {w: n * idf[w] for w, n in c.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    want = {}
    for d, c in docs.items():
        v = weigh(c)
        scored = []
        for q, e in queries.items():
            u = weigh(e)
            dot = sum(v[w] * u[w] for w in u if w in v)
            if dot:
                scored.append((-round(dot / norm(v) / norm(u), 9), q))
        if scored:
            want[d] = min(scored)[::-1]
    tf, qf, idft = tables(spark, docs, queries, idf)
    got = NQ.nearest_query(tf, qf, idft, block_postings=block_postings, docs_per_task=docs_per_task)
    rows = {r["doc_id"]: (r["query"], -r["cosine"]) for r in got.collect()}
    assert rows.keys() == want.keys()
    for d in want:
        assert rows[d][0] == want[d][0] and abs(rows[d][1] - want[d][1]) < 2e-9


def test_blocks_and_terms_are_passed_over(spark):
    # queries that share a common term, of which each document fits one only
    words = lambda i: [(i, "the", 5), (i, f"a{i}", 9), (i, f"b{i}", 9)]
    tf = spark.createDataFrame([r for i in range(80) for r in words(i)], "doc_id long, token string, tf long")
    qf = tf.withColumnRenamed("doc_id", "query")
    idf = tf.select("token").distinct().withColumn("idf", F.lit(1.0))
    seen = NQ.visited(tf, qf, idf, block_postings=30)
    assert seen.count() == 80  # of 80 x 80 pairs, and of 80 x 8 blocks
    assert seen.where("doc <> query").count() == 0
    one = NQ.visited(tf, qf, idf).agg(F.max("postings_read")).first()[0]
    assert one < 80  # a plain scan of a document's terms reads 82


def test_nearest_query_of_empty_tables(spark):
    tf, qf, idf = tables(spark, *made(5, 4, 1))
    assert NQ.nearest_query(tf.limit(0), qf, idf).count() == 0
    assert NQ.nearest_query(tf, qf.limit(0), idf).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_similarity_join_equals_brute_force(spark, threshold):
    docs, _, idf = made(70, 3, 8)
    docs[7_000] = Counter({w: n * 2 for w, n in docs[3].items()})  # another length, the same direction
    vec = {d: {w: n * idf[w] for w, n in c.items()} for d, c in docs.items()}
    unit = {d: {w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()} for d, v in vec.items()}
    rep, by = {}, defaultdict(list)
    for d in sorted(unit):
        by[tuple(sorted((w, round(x, 9)) for w, x in unit[d].items()))].append(d)
    for members in by.values():
        rep |= {d: members[0] for d in members}
    reps = sorted(set(rep.values()))
    want = {}
    for i, a in enumerate(reps):
        for b in reps[i + 1:]:
            dot = round(sum(x * unit[b].get(w, 0.0) for w, x in unit[a].items()), 9)
            if dot >= threshold:
                want[a, b] = dot
    df = spark.createDataFrame([(d, w, x) for d, v in vec.items() for w, x in v.items()], "doc_id long, token string, weight double")
    pairs, member = SJ.similarity_join(df, threshold)
    assert {r["doc"]: r["rep"] for r in member.collect()} == rep
    got = {(r["a"], r["b"]): r["cosine"] for r in pairs.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-9 for k in want)


def test_common_terms_are_not_looked_up(spark):
    # 300 rows share a common term; a rare one makes them differ
    df = spark.createDataFrame([r for i in range(300) for r in ((i, "the", 1.0), (i, f"x{i}", 2.0))], "doc_id long, token string, weight double")
    rows = SJ.unit_rows(df)
    entry = rows.mapInArrow(lambda it: SJ._prefixes(it, 0.8), "doc long, token string, w double, rest double")
    assert entry.where("token = 'the'").count() == 0 and entry.count() == 300
    assert SJ.similarity_join(df, 0.8)[0].count() == 0
    with pytest.raises(ValueError):
        SJ.similarity_join(df, 0.0)


def test_sketches_bound_products_and_drop_most_candidates(spark):
    # all rows share a heavy term, the rest differs; 0 and 1 are nearly equal
    docs = {i: {"both": 1.0} | {f"w{0 if i < 2 else i}_{j}": 0.2 for j in range(100)} for i in range(30)}
    docs[1]["more"] = 0.3
    df = spark.createDataFrame([(i, t, w) for i, d in docs.items() for t, w in d.items()], "doc_id long, token string, weight double")
    short = {r["doc"]: np.frombuffer(r["sketch"], np.uint8) * r["step"] for r in SJ.sketches(SJ.unit_rows(df)).collect()}
    unit = {i: {t: w / math.sqrt(sum(x * x for x in d.values())) for t, w in d.items()} for i, d in docs.items()}
    for a in docs:
        for b in range(a + 1, 30):
            bound = float(short[a] @ short[b])
            assert bound >= sum(w * unit[b].get(t, 0.0) for t, w in unit[a].items())
            assert (bound >= 0.8) == ((a, b) == (0, 1))
    assert [(r["a"], r["b"]) for r in SJ.similarity_join(df, 0.8)[0].collect()] == [(0, 1)]


def test_sparse_rows_to_dense_centroids(spark):
    rows = spark.createDataFrame([(1, "0", 3.0), (1, "2", 4.0), (2, "1", 1.0), (3, "9", 1.0), (4, "0", 0.0)], "doc_id long, token string, weight double")
    dense = spark.createDataFrame([(0, [3.0, 0.0, 4.0]), (1, [0.0, 2.0, 0.0]), (2, [0.0, 0.0, 0.0])], "c int, v array<double>")
    out = SJ.centroid_distances(rows, SJ.long_form(dense, "c", "v"), 3)
    got = {(r["doc_id"], r["cluster"]): round(r["distance"], 9) for r in out.collect()}
    want = {(1, 0): 0.0, (2, 1): 0.0}
    assert got == {(d, c): want.get((d, c), 1.0) for d in (1, 2, 3, 4) for c in range(3)}


def test_candidates_stay_in_the_task(spark, monkeypatch):
    """400 rows share their rarest term, so all pairs may be near: none becomes a row unless it is; blocks of any size."""
    import itertools
    near = lambda i, j, k, more=0.0: [(i, "s", 0.6), (i, f"c{j}", 0.8 / 2 ** 0.5 + more), (i, f"c{k}", 0.8 / 2 ** 0.5)]
    rows = [r for i, (j, k) in enumerate(itertools.islice(itertools.combinations(range(30), 2), 400)) for r in near(i, j, k)]
    rows += [r for i in range(400, 900) for r in ((i, f"c{j}", 1.0) for j in range(30))]  # makes the others common
    rows += near(1000, 0, 1, 0.1)
    df = spark.createDataFrame(rows, "doc_id long, token string, weight double")
    kept = []
    for name in ("cut_lineage", "store"):
        made_by = getattr(SJ, name)
        monkeypatch.setattr(SJ, name, lambda *args, f=made_by, **kw: kept.append((out := f(*args, **kw)).count()) or out)
    pairs, member = SJ.similarity_join(df, 0.8)
    got = [(r["a"], r["b"]) for r in pairs.collect()]
    assert got == [(0, 1000)] and member.select("rep").distinct().count() == 402
    assert max(kept) < 40_000  # no table of the 79,800 pairs
    monkeypatch.setattr(SJ, "BLOCK_POSTINGS", 100)
    monkeypatch.setattr(SJ, "MEET_CELLS", 64)
    monkeypatch.setattr(SJ, "BROADCAST_REPS", 0)
    assert [(r["a"], r["b"]) for r in SJ.similarity_join(df, 0.8)[0].collect()] == got


def test_similarity_join_of_bags_with_factors(spark):
    from sparkprep.operators.bags import term_bags
    tf = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 4), (2, "b", 2), (3, "a", 1), (4, "z", 1), (None, "a", 1)], "doc_id long, token string, n long")
    idf = spark.createDataFrame([("a", 1.0), ("b", 0.5)], "token string, idf double")
    pairs, member = SJ.similarity_join(term_bags(tf, value="n"), 0.8, factors=idf)
    assert {(r["doc"], r["rep"]) for r in member.collect()} == {(1, 1), (2, 1), (3, 3), (None, 3)}  # z has no factor
    assert [tuple(r) for r in pairs.collect()] == [(1, 3, round(2 / (4 + 0.25) ** 0.5, 9))]
    assert SJ.similarity_join(tf.limit(0), 0.8, w="n")[0].count() == 0
