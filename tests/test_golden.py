"""Operators on the reference's inline examples; expected values are the
"""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkprep.operators import binning as B
from sparkprep.operators import consolidate as C
from sparkprep.operators import index as IX
from sparkprep.operators import models as M
from sparkprep.operators import retrieval as R
from sparkprep.operators import scaling as SC
from sparkprep.operators import sequences as SQ
from sparkprep.operators import stats as S
from sparkprep.operators import vectors as V
from sparkprep.operators.association import pmi

BINS = [35, 21, 10, 37, 19, 21, 41, 13, 62, 66, 73, 64, 20, 39, 58, 72, 13, 34, 33, 11]
NORM = [5, 27, 100, 59, 28, 48, 50, 39, 9, 7, 20, 63, 10, 41, 9]


def _col(spark, values, name="x"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def _sizes(df, k):
    got = {r["bin"]: r["n"] for r in df.groupBy("bin").count().withColumnRenamed("count", "n").collect()}
    return [got.get(i, 0) for i in range(k)]


@pytest.mark.parametrize("k,textbook,cursor", [(3, [8, 6, 6], [8, 6, 6]), (4, [8, 6, 0, 6], [8, 6, 1, 5])])
def test_equal_width_bins(spark, k, textbook, cursor):
    df = _col(spark, BINS)
    assert _sizes(B.equal_width_bins(df, "x", k), k) == textbook
    cur = B.equal_width_bins(df, "x", k, mode="cursor")
    assert _sizes(cur, k) == cursor
    if k == 4:
        assert cur.filter(F.col("x") == 58).first()["bin"] == 2


def test_bin_boundaries(spark):
    got = [r["boundary"] for r in B.bin_boundaries(_col(spark, BINS), "x", 4).orderBy("i").collect()]
    assert got == pytest.approx([25.75, 41.5, 57.25])


def test_equal_depth_and_smoothing(spark):
    df = _col(spark, BINS)
    b = B.equal_depth_bins(df, "x", 4)
    assert _sizes(b, 4) == [5, 5, 5, 5]
    sm = B.smooth_depth_boundary(b, "x").orderBy("x").collect()
    assert sm[0]["smoothed"] == 10 and sm[1]["smoothed"] == 10  # 11 is nearer 10 than 19
    mean = B.smooth_by_mean(B.equal_width_bins(df, "x", 3), "x").filter(F.col("bin") == 0).first()
    assert mean["smoothed"] == pytest.approx(round(sum([10, 11, 13, 13, 19, 20, 21, 21]) / 8, 6))


def test_normalisation(spark):
    df = _col(spark, NORM)
    mm = {r["x0"]: r["x"] for r in SC.minmax(df.withColumn("x0", F.col("x")), ["x"]).collect()}
    assert mm[27.0] == pytest.approx(22 / 95)
    z = {r["x0"]: r["x"] for r in SC.zscore(df.withColumn("x0", F.col("x")), ["x"], ddof=0).collect()}
    assert z[100.0] == pytest.approx((100 - 34.333333) / 25.850209, rel=1e-5)
    rb = {r["x0"]: r["x"] for r in SC.robust(df.withColumn("x0", F.col("x")), ["x"]).collect()}
    assert rb[100.0] == pytest.approx((100 - 28) / 19)


def test_exact_quantiles_match_linear_interpolation(spark):
    df = _col(spark, NORM)
    q = {r["prob"]: r["value"] for r in S.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0]).collect()}
    srt = sorted(NORM)
    assert q[0.5] == 28 and q[0.0] == 5 and q[1.0] == 100
    pos = 0.25 * (len(srt) - 1)
    lo = srt[int(pos)]
    assert q[0.25] == pytest.approx(lo + (srt[int(pos) + 1] - lo) * (pos - int(pos)))


EDU = [("ssn1", "Alice", "Smith", datetime(2022, 1, 1)), ("ssn1", "Bob", "Johnson", datetime(2022, 2, 1)),
       ("ssn3", "Charlie", "Williams", datetime(2022, 3, 1)), ("ssn4", "David", "Brown", datetime(2021, 4, 1)),
       ("ssn5", "Eva", "Jones", datetime(2021, 5, 1)), ("ssn6", "Frank", "Garcia", datetime(2022, 6, 1)),
       ("ssn7", "Grace", "Miller", datetime(2021, 7, 1)), ("ssn8", "Hannah", "Davis", datetime(2022, 8, 1)),
       ("ssn9", "Ivy", "Rodriguez", datetime(2022, 9, 1)), ("ssn10", "Jack", "Martinez", datetime(2022, 10, 1))]
MED = [("ssn1", None, "Smith", datetime(2022, 5, 1)), ("ssn2", "Bob", "Johnson", datetime(2022, 4, 1)),
       ("ssn4", "Dave", "Brown", datetime(2022, 2, 1)), ("ssn5", "Eve", "Jones", datetime(2022, 6, 1)),
       ("ssn6", "Franklin", "Garcia", datetime(2022, 7, 1)), ("ssn8", "Hannah", "Davis", datetime(2022, 9, 1)),
       ("ssn9", "Ivy", "Rodriguez", datetime(2022, 10, 1)), ("ssn11", "Kevin", "Wilson", datetime(2022, 8, 1)),
       ("ssn12", "Linda", "Anderson", datetime(2021, 11, 1)), ("ssn13", "Mike", "Thomas", datetime(2021, 12, 1))]


def _merged(spark):
    edu = spark.createDataFrame(EDU, "ssn string, first_name string, last_name string, employment_timestamp timestamp")
    med = spark.createDataFrame(MED, "ssn string, first_name string, last_name string, consultation_timestamp timestamp")
    edu = C.dedup_keep_latest(edu, ["ssn"], "employment_timestamp")
    return C.full_outer_merge(edu, med, "ssn")


def test_dedup_merge_conflicts_survivorship(spark):
    m = _merged(spark)
    assert m.count() == 13
    conf = {r["attribute"]: r["n_conflicts"] for r in C.conflict_counts(m, ["first_name", "last_name"]).collect()}
    assert conf == {"first_name": 3, "last_name": 1}
    s = C.survivorship(m, ["first_name", "last_name"], "employment_timestamp", "consultation_timestamp")
    r = s.filter(F.col("ssn") == "ssn1").first()
    assert (r["first_name_final"], r["last_name_final"]) == ("Bob", "Smith")


def test_tfidf_raw_cosine_rank(spark):
    rows = []
    for doc, counts in enumerate([[3, 0, 2], [0, 1, 1], [0, 3, 6]], start=1):
        for term, n in zip(["quick", "brown", "fox"], counts):
            if n:
                rows.append((doc, term, n))
    tf = spark.createDataFrame(rows, "doc_id int, token string, tf long")
    w = IX.tfidf_raw(tf, F.lit(3)).withColumnRenamed("tfidf", "weight")
    idf = w.select("token", (F.col("weight") / F.col("tf")).alias("idf")).distinct()
    q = spark.createDataFrame([("quick", 1), ("fox", 1)], "token string, tf long").join(idf, "token")
    qw = q.select("token", (F.col("tf") * F.col("idf")).alias("weight"))
    sims = {r["doc_id"]: r["cosine"] for r in IX.cosine_to_query(w.drop("tf"), qw).collect()}
    assert sims[1] == pytest.approx(1.0) and sims[2] == pytest.approx(0.0) and sims[3] == pytest.approx(0.0)


def test_ir_metrics(spark):
    rel = [1, 0, 1, 1, 0, 1, 1, 1, 1, 1]
    df = spark.createDataFrame([("q", i + 1, r) for i, r in enumerate(rel)], "q string, pos int, rel int")
    totals = spark.createDataFrame([("q", 12)], "q string, total_rel long")
    m = R.metrics_at_k(df, "q", ["pos"], "rel", (5,), totals).first()
    assert m["precision"] == pytest.approx(0.6) and m["recall"] == pytest.approx(0.25)
    assert m["f1"] == pytest.approx(0.352941, abs=1e-6)
    curve = R.pr_curve(df, "q", ["pos"], "rel", totals)
    interp = R.interpolated_at_recall(curve, "q", [0.2]).first()["interpolated"]
    assert interp == pytest.approx(0.8)
    tail = {r["rank"]: r["interpolated"] for r in R.interpolated_precision(curve, "q").collect()}
    assert tail[2] == pytest.approx(0.8) and tail[10] == pytest.approx(0.8)


def test_pmi(spark):
    table = {"car": [27, 35, 15, 8], "bus": [2, 1, 12, 17], "cat": [10, 23, 15, 4], "dog": [1, 31, 18, 2]}
    ctx = ["drive", "run", "fluffy", "broken"]
    rows = [(w, c, n) for w, ns in table.items() for c, n in zip(ctx, ns)]
    df = spark.createDataFrame(rows, "word string, context string, n int").select(
        "word", "context", F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("_"))
    v = pmi(df, "word", "context").filter((F.col("word") == "dog") & (F.col("context") == "fluffy")).first()
    assert v["pmi"] == pytest.approx(0.242946, abs=1e-6)


def test_sigmoid_softmax_attention(spark):
    one = spark.range(1)
    z = V.dot(F.array(*map(F.lit, [0.1, -0.2, 0.4])), F.array(*map(F.lit, [0.2, 0.5, -0.3]))) + 0.6
    assert one.select(V.sigmoid(z)).first()[0] == pytest.approx(0.598688, abs=1e-6)

    h = [[0.3, -0.1, 0.4], [0.5, 1, 0.2], [-0.3, 0.2, -1], [0.5, -1, -0.5]]
    d = [0.2, 1.1, 0.2]
    df = spark.createDataFrame([("g", i, sum(a * b for a, b in zip(r, d))) for i, r in enumerate(h)],
                               "g string, i int, s double")
    w = [r["weight"] for r in V.group_softmax(df, ["g"], "s").orderBy("i").collect()]
    assert w == pytest.approx([0.178288, 0.597885, 0.166234, 0.057593], abs=1e-6)

    wq = [[0.4, 0.2], [0.1, 0.5], [-0.2, -0.1]]
    wk = [[-0.5, 0.1], [0.2, 0.1], [0.2, 0.4]]
    xs = [[0.2, 0.5, 0.4], [0.1, 0.2, 0.5], [0, 0.2, 0.4]]

    def proj(m, x):
        return [sum(m[r][c] * x[r] for r in range(3)) for c in range(2)]
    keys = spark.createDataFrame([("g", i, proj(wk, x)) for i, x in enumerate(xs)], "g string, i int, k array<double>")
    qs = spark.createDataFrame([("g", proj(wq, xs[1]))], "g string, q array<double>")
    aw = [r["weight"] for r in V.attention_weights(keys, qs, ["g"], "k", "q", scaled=False).orderBy("i").collect()]
    assert aw == pytest.approx([0.333944, 0.333811, 0.332245], abs=1e-6)


def test_sentence_logprob(spark):
    model = spark.createDataFrame([("<s>", "i", 0.1), ("i", "love", 0.001), ("love", "you", 0.05),
                                   ("you", "</s>", 0.1)], "w1 string, w2 string, p double")
    s = spark.createDataFrame([(1, ["i", "love", "you"])], "sid int, toks array<string>")
    lp = SQ.sentence_logprob(s, ["sid"], "toks", model).first()["logprob"]
    assert lp == pytest.approx(-14.508658, abs=1e-6)


def test_cosine_distance(spark):
    one = spark.range(1)
    d1 = one.select(V.cosine_distance(F.array(*map(F.lit, [2.0, 3, 4, 5])), F.array(*map(F.lit, [4.0, 5, 6, 7])))).first()[0]
    d2 = one.select(V.cosine_distance(F.array(*map(F.lit, [2.0, 0, 0, 5])), F.array(*map(F.lit, [0.0, 5, 6, 7])))).first()[0]
    zero = one.select(V.cosine_distance(F.array(*map(F.lit, [0.0, 0.0])), F.array(*map(F.lit, [1.0, 2.0])))).first()[0]
    assert d1 == pytest.approx(0.005896, abs=1e-6) and d2 == pytest.approx(0.380313, abs=1e-6) and zero == 1.0


def test_gaussian_nb(spark):
    X = [[2, 3], [3, 4], [4, 5], [2, 1], [3, 2], [4, 3]]
    y = ["Spam", "Spam", "Not Spam", "Spam", "Not Spam", "Not Spam"]
    train = spark.createDataFrame([(float(a), float(b), c) for (a, b), c in zip(X, y)], "a double, b double, label string")
    fit = M.gaussian_nb_fit(train, ["a", "b"], "label")
    q = spark.createDataFrame([(1, 3.0, 3.0)], "id int, a double, b double")
    r = M.gaussian_nb_predict(q, fit, ["a", "b"], "label", "id").first()
    assert r["prob"] == pytest.approx(0.5, abs=1e-6)


def test_entropy_of_tree_root(spark):
    df = spark.createDataFrame([(c,) for c, n in [(0, 40), (1, 41), (2, 39)] for _ in range(n)], "y int")
    ent = M.class_impurity(df, "y").first()["entropy"]
    assert round(ent, 3) == 1.585


def test_char_encoding(spark):
    df = spark.createDataFrame([("Ann",), ("Christopher Columbus Jr",)], "name string")
    rows = df.select(SQ.encode_chars(F.col("name"), 20).alias("ids")).collect()
    assert rows[0]["ids"][:4] == [29, 16, 16, 2] and rows[0]["ids"][4:] == [0] * 16
    assert len(rows[1]["ids"]) == 20 and 2 not in rows[1]["ids"]  # truncated: end mark lost
    assert math.isclose(SQ.logprob_of([0.1, 0.001, 0.05, 0.1]), -14.508658, abs_tol=1e-6)


def test_full_outer_merge_null_keys(spark):
    a = spark.createDataFrame([("k1", 1), (None, 2)], "k string, v int")
    b = spark.createDataFrame([("k1", 10), (None, 20)], "k string, v int")
    assert C.full_outer_merge(a, b, "k").count() == 3
    pairs = {(r["v_x"], r["v_y"]) for r in C.full_outer_merge(a, b, "k", null_safe=True).collect()}
    assert pairs == {(1, 10), (2, 20)}
