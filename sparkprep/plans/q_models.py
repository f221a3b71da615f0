"""Queries: vector functions (2.8), closed-form models, clustering step,
evaluation and lookups (2.3, 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clustering as KM
from ..operators import evaluate as EV
from ..operators import models as M
from ..operators import neighbours as NB
from ..operators import vectors as V
from ..operators.sampling import split_hash
from ..sources.tables import load
from .common import rounded, sig_round, sig_round_sql
from .registry import query


def _emb(spark, sf):
    return load(spark, sf, "embeddings")


def _pairs(spark, sf):
    e = _emb(spark, sf)
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id")


_PAIRS_SQL = """
WITH p AS (SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS a, CAST(b.embedding AS DOUBLE[]) AS b
           FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
"""


@query("vec_dot", _PAIRS_SQL + "SELECT vec_id, round(list_inner_product(a, b), 9) AS dot FROM p")
def q_vec_dot(spark, sf):
    p = _pairs(spark, sf)
    return rounded(p.select("vec_id", V.dot(F.col("embedding"), F.col("other")).alias("dot")), 9)


@query("vec_norm", """
SELECT vec_id, round(sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 9)
       AS norm FROM embeddings
""")
def q_vec_norm(spark, sf):
    return rounded(_emb(spark, sf).select("vec_id", V.norm(F.col("embedding")).alias("norm")), 9)


@query("vec_cosine", _PAIRS_SQL + """
, s AS (SELECT vec_id, list_inner_product(a, b) / nullif(sqrt(list_inner_product(a, a))
               * sqrt(list_inner_product(b, b)), 0.0) AS sim FROM p)
SELECT vec_id, round(sim, 9) AS similarity, round(coalesce(1 - sim, 1.0), 9) AS distance FROM s
""")
def q_vec_cosine(spark, sf):
    p = _pairs(spark, sf)
    a, b = F.col("embedding"), F.col("other")
    return rounded(p.select("vec_id", V.cosine_similarity(a, b).alias("similarity"),
                            V.cosine_distance(a, b).alias("distance")), 9)


@query("vec_add", _PAIRS_SQL + """
SELECT vec_id, list_transform(range(1, len(a) + 1), lambda i: (a[i] + b[i]) * 0.5) AS midpoint FROM p
""")
def q_vec_add(spark, sf):
    p = _pairs(spark, sf)
    return p.select("vec_id", V.scale(V.add(F.col("embedding"), F.col("other")), 0.5).alias("midpoint"))


@query("vec_reshape", """
SELECT vec_id, list_transform(range(8), lambda i: list_slice(embedding, i * 8 + 1, i * 8 + 8)) AS matrix
FROM embeddings
""")
def q_vec_reshape(spark, sf):
    return _emb(spark, sf).select("vec_id", V.reshape(F.col("embedding"), 8).alias("matrix"))


@query("vec_argminmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax,
       CAST(list_position(embedding, list_min(embedding)) - 1 AS INTEGER) AS argmin FROM embeddings
""")
def q_vec_argminmax(spark, sf):
    e = _emb(spark, sf)
    return e.select("vec_id", V.argmax(F.col("embedding")).alias("argmax"),
                    V.argmin(F.col("embedding")).alias("argmin"))


def _first_vector(e):
    """Weights taken from the data: the vector with the smallest id."""
    return e.filter(F.col("vec_id") == e.select(F.min("vec_id")).scalar()).select(
        F.col("embedding").cast("array<double>")).scalar()


_W_SQL = """
w AS (SELECT CAST(embedding AS DOUBLE[]) AS w FROM embeddings
      WHERE vec_id = (SELECT min(vec_id) FROM embeddings)),
z AS (SELECT vec_id, label, list_inner_product(CAST(embedding AS DOUBLE[]), w) AS dotw FROM embeddings, w)
"""


@query("sigmoid_score", "WITH " + _W_SQL + """
SELECT vec_id, round(1 / (1 + exp(-(dotw + 0.6))), 9) AS score FROM z
""")
def q_sigmoid_score(spark, sf):
    e = _emb(spark, sf)
    e = e.withColumn("_w", _first_vector(e))
    z = V.dot(F.col("embedding"), F.col("_w")) + 0.6
    return rounded(e.select("vec_id", V.sigmoid(z).alias("score")), 9)


@query("softmax_weights", """
SELECT event_id, user_id, round(e / sum(e) OVER (PARTITION BY user_id), 9) AS weight
FROM (SELECT event_id, user_id, exp(value - max(value) OVER (PARTITION BY user_id)) AS e FROM events)
""")
def q_softmax_weights(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "value")
    return rounded(V.group_softmax(ev, ["user_id"], "value").drop("value"), 9)


_CENTROID_SQL = """
c AS (SELECT label, list(m ORDER BY dim) AS centroid FROM (
        SELECT label, dim, avg(v) AS m FROM (
          SELECT label, unnest(range(64)) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)
        GROUP BY label, dim) GROUP BY label)
"""


@query("attention_pool", "WITH " + _CENTROID_SQL + """
, s AS (SELECT e.vec_id, e.label, list_inner_product(CAST(e.embedding AS DOUBLE[]), c.centroid) / sqrt(64.0) AS sc
        FROM embeddings e JOIN c USING (label))
SELECT vec_id, label, {w} AS weight FROM (
  SELECT vec_id, label, e / sum(e) OVER (PARTITION BY label) AS w FROM (
    SELECT vec_id, label, exp(sc - max(sc) OVER (PARTITION BY label)) AS e FROM s))
""".format(w=sig_round_sql("w", 8)))
def q_attention_pool(spark, sf):
    e = _emb(spark, sf).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    cents = V.group_mean_vector(e, ["label"], "v", out="q")
    w = V.attention_weights(e, cents, ["label"], "v", "q")
    return w.select("vec_id", "label", sig_round(F.col("weight"), 8).alias("weight"))


@query("cosine_pairwise", "WITH " + _CENTROID_SQL + """
SELECT e.vec_id, c.label AS label_ref,
       {d} AS distance
FROM embeddings e, c
""".format(d=sig_round_sql(
    "coalesce(1 - list_inner_product(CAST(e.embedding AS DOUBLE[]), c.centroid) / nullif("
    "sqrt(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))"
    " * sqrt(list_inner_product(c.centroid, c.centroid)), 0.0), 1.0)", 8)))
def q_cosine_pairwise(spark, sf):
    e = _emb(spark, sf).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    cents = V.group_mean_vector(e, ["label"], "v", out="centroid").withColumnRenamed("label", "cluster")
    e = e.withColumn("_cents", KM.centroid_array(cents))
    d = F.transform(F.col("_cents"), lambda c: F.struct(c["cluster"].alias("label_ref"),
                                            V.cosine_distance(F.col("v"), c["centroid"]).alias("distance")))
    out = e.select("vec_id", F.inline(d))
    return out.select("vec_id", "label_ref", sig_round(F.col("distance"), 8).alias("distance"))


@query("math_fns", """
SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 9) AS ln_price,
       round(log10(l_extendedprice), 9) AS log10_price, round(exp(l_discount), 9) AS exp_discount,
       round(sqrt(l_quantity), 9) AS sqrt_quantity, round(abs(l_extendedprice - 40000), 9) AS abs_dev,
       round(pow(l_tax, 2), 9) AS tax_sq
FROM lineitem
""")
def q_math_fns(spark, sf):
    li = load(spark, sf, "lineitem")
    return rounded(li.select("l_orderkey", "l_linenumber", F.log("l_extendedprice").alias("ln_price"),
                             F.log10("l_extendedprice").alias("log10_price"),
                             F.exp("l_discount").alias("exp_discount"),
                             F.sqrt("l_quantity").alias("sqrt_quantity"),
                             F.abs(F.col("l_extendedprice") - 40000).alias("abs_dev"),
                             F.pow("l_tax", 2).alias("tax_sq")), 9)


# ------------------------------------------------------------ regression

@query("ols_simple", """
SELECT {s} AS slope, {i} AS intercept FROM lineitem
""".format(s=sig_round_sql("regr_slope(l_extendedprice, l_quantity)", 9),
           i=sig_round_sql("regr_intercept(l_extendedprice, l_quantity)", 9)))
def q_ols_simple(spark, sf):
    fit = M.ols_simple(load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return fit.select(sig_round(F.col("slope"), 9).alias("slope"),
                      sig_round(F.col("intercept"), 9).alias("intercept"))


_OLS2_SQL = """
m AS (SELECT avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
             covar_pop(l_quantity, l_quantity) AS s11, covar_pop(l_discount, l_discount) AS s22,
             covar_pop(l_quantity, l_discount) AS s12, covar_pop(l_quantity, l_extendedprice) AS s1y,
             covar_pop(l_discount, l_extendedprice) AS s2y FROM lineitem),
b AS (SELECT (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
             (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2, my, m1, m2 FROM m),
f AS (SELECT my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM b)
"""


@query("ols_multi", "WITH " + _OLS2_SQL + "SELECT {a} AS b0, {b} AS b1, {c} AS b2 FROM f".format(
    a=sig_round_sql("b0", 8), b=sig_round_sql("b1", 8), c=sig_round_sql("b2", 8)))
def q_ols_multi(spark, sf):
    fit = M.ols_two(load(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", "l_discount")
    return fit.select(*[sig_round(F.col(c), 8).alias(c) for c in ("b0", "b1", "b2")])


@query("reg_metrics", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i
           FROM lineitem),
e AS (SELECT l_extendedprice AS y, l_extendedprice - (i + s * l_quantity) AS err FROM lineitem, f)
SELECT {sse} AS sse, {mse} AS mse, {mae} AS mae, {rmse} AS rmse, {r2} AS r2 FROM (
  SELECT sum(err * err) AS sse, avg(err * err) AS mse, avg(abs(err)) AS mae, sqrt(avg(err * err)) AS rmse,
         1 - sum(err * err) / sum(pow(y - (SELECT avg(l_extendedprice) FROM lineitem), 2)) AS r2 FROM e)
""".format(**{k: sig_round_sql(k, 8) for k in ("sse", "mse", "mae", "rmse", "r2")}))
def q_reg_metrics(spark, sf):
    li = load(spark, sf, "lineitem")
    pred = M.ols_predict(li, M.ols_simple(li, "l_quantity", "l_extendedprice"), "l_quantity")
    out = EV.regression_metrics(pred, "l_extendedprice", "prediction")
    return out.select(*[sig_round(F.col(c), 8).alias(c) for c in out.columns])


@query("grid_score", "WITH " + _OLS2_SQL + """
, r AS (SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_discount) AS d0, max(l_discount) AS d1
        FROM lineitem),
g AS (SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, q0 + i * (q1 - q0) / 49 AS x1,
             d0 + j * (d1 - d0) / 49 AS x2 FROM range(50) a(i), range(50) b(j), r)
SELECT i, j, round(x1, 9) AS x1, round(x2, 9) AS x2, {s} AS score FROM g, f
""".format(s=sig_round_sql("b0 + b1 * x1 + b2 * x2", 8)))
def q_grid_score(spark, sf):
    from ..operators.grid import mesh
    li = load(spark, sf, "lineitem")
    fit = M.ols_two(li, "l_extendedprice", "l_quantity", "l_discount")
    g = mesh(li, "l_quantity", "l_discount", 50, "x1", "x2")
    b0, b1, b2 = (fit.select(c).scalar() for c in ("b0", "b1", "b2"))
    score = b0 + b1 * F.col("x1") + b2 * F.col("x2")
    return g.select("i", "j", F.round("x1", 9).alias("x1"), F.round("x2", 9).alias("x2"),
                    sig_round(score, 8).alias("score"))


# ------------------------------------------------------------ losses

@query("hinge_objective", "WITH " + _W_SQL + """
, f AS (SELECT CASE WHEN label < 5 THEN 1 ELSE -1 END AS y, dotw + 0.1 AS f FROM z)
SELECT {o} AS objective, count_if(sign(f) <> y) AS n_misclassified,
       {m} AS margin FROM f, w
""".format(o=sig_round_sql("0.5 * max(list_inner_product(w, w)) + sum(greatest(0.0, 1 - y * f))", 9),
           m=sig_round_sql("2 / sqrt(max(list_inner_product(w, w)))", 9)))
def q_hinge_objective(spark, sf):
    e = _emb(spark, sf)
    df = e.select("embedding", F.when(F.col("label") < 5, 1).otherwise(-1).alias("y"))
    out = M.hinge_objective(df, "embedding", "y", _first_vector(e), 0.1)
    return out.select(sig_round(F.col("objective"), 9).alias("objective"), "n_misclassified",
                      sig_round(F.col("margin"), 9).alias("margin"))


@query("log_loss", "WITH " + _W_SQL + """
, p AS (SELECT CAST(label < 5 AS INTEGER) AS y,
               least(greatest(1 / (1 + exp(-(dotw + 0.6))), 1e-15), 1 - 1e-15) AS p FROM z)
SELECT {l} AS log_loss FROM (SELECT avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS l FROM p)
""".format(l=sig_round_sql("l", 9)))
def q_log_loss(spark, sf):
    e = _emb(spark, sf)
    e = e.withColumn("_w", _first_vector(e))
    p = V.sigmoid(V.dot(F.col("embedding"), F.col("_w")) + 0.6)
    df = e.select((F.col("label") < 5).cast("int").alias("y"), p.alias("p"))
    return M.log_loss(df, "y", "p").select(sig_round(F.col("log_loss"), 9).alias("log_loss"))


# ------------------------------------------------------------ naive Bayes

_NB_SQL = """
WITH x AS (SELECT vec_id, label, unnest(range(64)) AS d, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
eps AS (SELECT max(vp) * 1e-9 AS eps FROM (SELECT var_pop(v) AS vp FROM x GROUP BY d)),
fit AS (SELECT label AS c, d, avg(v) AS mu, var_pop(v) + (SELECT eps FROM eps) AS var FROM x GROUP BY label, d),
prior AS (SELECT label AS c, count(*) / (SELECT count(*) FROM embeddings) AS prior FROM embeddings GROUP BY label),
j AS (SELECT x.vec_id, x.label AS truth, fit.c,
             ln(any_value(prior)) + sum(-0.5 * ln(2 * pi() * var) - 0.5 * pow(v - mu, 2) / var) AS jll
      FROM x JOIN fit USING (d) JOIN prior ON prior.c = fit.c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY jll DESC, c) AS rn,
             max(jll) OVER (PARTITION BY vec_id) AS mx FROM j),
lse AS (SELECT vec_id, max(mx) + ln(sum(exp(jll - mx))) AS lse FROM r GROUP BY vec_id),
pred AS (SELECT r.vec_id, r.truth AS label, r.c AS pred, exp(r.jll - lse.lse) AS prob
         FROM r JOIN lse USING (vec_id) WHERE rn = 1)
"""


def _nb_predictions(spark, sf):
    names = [f"x{i}" for i in range(64)]
    e = _emb(spark, sf).select("vec_id", "label", *[
        F.element_at("embedding", i + 1).cast("double").alias(x) for i, x in enumerate(names)])
    fit = M.gaussian_nb_fit(e, names, "label")
    pred = M.gaussian_nb_predict(e, fit, names, "label", "vec_id")
    return pred.join(e.select("vec_id", "label"), "vec_id")


@query("gaussian_nb", _NB_SQL + "SELECT vec_id, pred, {p} AS prob FROM pred".format(p=sig_round_sql("prob", 7)))
def q_gaussian_nb(spark, sf):
    p = _nb_predictions(spark, sf)
    return p.select("vec_id", "pred", sig_round(F.col("prob"), 7).alias("prob"))


@query("accuracy", _NB_SQL + """
SELECT round(avg(CAST(label = pred AS DOUBLE)), 9) AS accuracy, count(*) AS n FROM pred
""")
def q_accuracy(spark, sf):
    return rounded(EV.accuracy(_nb_predictions(spark, sf), "label", "pred"), 9)


_REPORT_SQL = _NB_SQL + """
, cls AS (SELECT label AS c FROM pred UNION SELECT pred FROM pred),
per AS (SELECT CAST(c AS VARCHAR) AS class,
               coalesce((SELECT count(*) FROM pred WHERE label = c AND pred = c)
                        / nullif((SELECT count(*) FROM pred WHERE pred = c), 0), 0.0) AS precision,
               coalesce((SELECT count(*) FROM pred WHERE label = c AND pred = c)
                        / nullif((SELECT count(*) FROM pred WHERE label = c), 0), 0.0) AS recall,
               (SELECT count(*) FROM pred WHERE label = c) AS support FROM cls),
perf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                        ELSE 0.0 END AS f1 FROM per),
rep AS (SELECT class, precision, recall, support, f1 FROM perf
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), sum(support), avg(f1) FROM perf
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                         sum(recall * support) / sum(support), sum(support), sum(f1 * support) / sum(support)
                  FROM perf)
"""


@query("classification_report", _REPORT_SQL + """
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, CAST(support AS BIGINT) AS support,
       round(f1, 9) AS f1 FROM rep
""")
def q_classification_report(spark, sf):
    rep = EV.classification_report(_nb_predictions(spark, sf), "label", "pred")
    return rounded(rep.withColumn("support", F.col("support").cast("long")), 9)


@query("macro_f1", _REPORT_SQL + "SELECT round(f1, 9) AS macro_f1 FROM rep WHERE class = 'macro avg'")
def q_macro_f1(spark, sf):
    return rounded(EV.macro_f1(_nb_predictions(spark, sf), "label", "pred"), 9)


def _orders_cat(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                    F.floor(F.col("o_totalprice") / 100000).cast("int").alias("o_band"),
                    F.year("o_orderdate").alias("o_year"))


_ORD_SQL = """
o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(floor(o_totalprice / 100000) AS INTEGER) AS o_band,
             year(o_orderdate) AS o_year FROM orders)
"""


@query("categorical_nb", "WITH " + _ORD_SQL + """
, pr AS (SELECT o_orderstatus, count(*) AS nc FROM o GROUP BY 1),
c1 AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n1 FROM o GROUP BY ALL),
c2 AS (SELECT o_orderstatus, o_band, count(*) AS n2 FROM o GROUP BY ALL),
s AS (SELECT pr.o_orderstatus, c1.o_orderpriority, c2.o_band,
             ln(nc / (SELECT count(*) FROM o)) + ln(n1 / nc) + ln(n2 / nc) AS s
      FROM pr JOIN c1 USING (o_orderstatus) JOIN c2 USING (o_orderstatus)),
r AS (SELECT o.o_orderkey, s.o_orderstatus AS pred, s.s,
             row_number() OVER (PARTITION BY o.o_orderkey ORDER BY s.s DESC, s.o_orderstatus) AS rn
      FROM o JOIN s USING (o_orderpriority, o_band))
SELECT o_orderkey, pred, round(s, 9) AS log_score FROM r WHERE rn = 1
""")
def q_categorical_nb(spark, sf):
    o = _orders_cat(spark, sf)
    return rounded(M.categorical_nb_predict(o, ["o_orderpriority", "o_band"], "o_orderstatus", "o_orderkey"), 9)


_IMP_SQL = "WITH " + _ORD_SQL + """
, p AS (SELECT count(*) / (SELECT count(*) FROM o) AS p FROM o GROUP BY o_orderstatus)
"""


@query("impurity_entropy", _IMP_SQL + "SELECT round(-sum(p * log2(p)), 9) AS entropy FROM p")
def q_impurity_entropy(spark, sf):
    return rounded(M.class_impurity(_orders_cat(spark, sf), "o_orderstatus").select("entropy"), 9)


@query("impurity_gini", _IMP_SQL + "SELECT round(1 - sum(p * p), 9) AS gini FROM p")
def q_impurity_gini(spark, sf):
    return rounded(M.class_impurity(_orders_cat(spark, sf), "o_orderstatus").select("gini"), 9)


def _gain_sql(attr):
    return f"""
SELECT '{attr}' AS attribute, (SELECT -sum(p * log2(p)) FROM p) - sum(nv / (SELECT count(*) FROM o) * hv) AS gain
FROM (SELECT v, sum(n) AS nv, -sum(n / sum(n) OVER (PARTITION BY v) * log2(n / sum(n) OVER (PARTITION BY v)))
             OVER (PARTITION BY v) AS hv
      FROM (SELECT CAST({attr} AS VARCHAR) AS v, o_orderstatus, count(*) AS n FROM o GROUP BY ALL)
      GROUP BY v, n, o_orderstatus)
"""


_ATTRS = ["o_orderpriority", "o_band", "o_year"]
_GAIN_SQL = _IMP_SQL + """
, cv AS (SELECT a, v, o_orderstatus, count(*) AS n FROM (
           SELECT 'o_orderpriority' AS a, CAST(o_orderpriority AS VARCHAR) AS v, o_orderstatus FROM o
           UNION ALL SELECT 'o_band', CAST(o_band AS VARCHAR), o_orderstatus FROM o
           UNION ALL SELECT 'o_year', CAST(o_year AS VARCHAR), o_orderstatus FROM o) GROUP BY ALL),
hv AS (SELECT a, v, sum(n) AS nv, -sum(n / nt * log2(n / nt)) AS h FROM (
         SELECT *, sum(n) OVER (PARTITION BY a, v) AS nt FROM cv) GROUP BY a, v),
g AS (SELECT a AS attribute, (SELECT -sum(p * log2(p)) FROM p) - sum(nv / (SELECT count(*) FROM o) * h) AS gain
      FROM hv GROUP BY a)
"""


@query("info_gain", _GAIN_SQL + "SELECT attribute, round(gain, 9) AS gain FROM g")
def q_info_gain(spark, sf):
    return rounded(M.info_gain(_orders_cat(spark, sf), "o_orderstatus", _ATTRS), 9)


@query("best_split", _GAIN_SQL + "SELECT attribute, round(gain, 9) AS gain FROM g ORDER BY gain DESC, attribute LIMIT 1")
def q_best_split(spark, sf):
    return rounded(M.best_split(_orders_cat(spark, sf), "o_orderstatus", _ATTRS), 9)


# ------------------------------------------------------------ clustering (one step)

_KM_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, v AS c
      FROM (SELECT * FROM e ORDER BY vec_id LIMIT 4)),
d AS (SELECT e.vec_id, e.v, s.cluster,
             round(coalesce(1 - list_inner_product(e.v, s.c) / nullif(sqrt(list_inner_product(e.v, e.v))
                   * sqrt(list_inner_product(s.c, s.c)), 0.0), 1.0), 9) + 0.0 AS distance FROM e, s),
a AS (SELECT vec_id, v, cluster, distance FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS rn FROM d) WHERE rn = 1)
"""


def _km_assigned(spark, sf):
    e = _emb(spark, sf).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    seeds = KM.seed_centroids(e, "vec_id", "v", 4)
    return e, seeds, KM.assign_clusters(e, "v", KM.centroid_array(seeds))


@query("kmeans_assign", _KM_SQL + "SELECT vec_id, cluster, distance FROM a")
def q_kmeans_assign(spark, sf):
    return _km_assigned(spark, sf)[2].select("vec_id", "cluster", "distance")


@query("kmeans_cosine_step", _KM_SQL + """
, m AS (SELECT cluster, dim, avg(x) AS value FROM (
          SELECT cluster, unnest(range(64)) AS dim, unnest(v) AS x FROM a) GROUP BY ALL),
allc AS (SELECT s.cluster, unnest(range(64)) AS dim, unnest(s.c) AS seedv FROM s)
SELECT allc.cluster, CAST(allc.dim AS INTEGER) AS dim, {v} AS value
FROM allc LEFT JOIN m USING (cluster, dim)
""".format(v=sig_round_sql("coalesce(m.value, allc.seedv)", 8)))
def q_kmeans_cosine_step(spark, sf):
    _, seeds, assigned = _km_assigned(spark, sf)
    upd = KM.update_centroids(assigned, seeds, "v", dim=64)
    return upd.select("cluster", F.posexplode("centroid").alias("dim", "value")).select(
        "cluster", "dim", sig_round(F.col("value"), 8).alias("value"))


def _kmeans_full_sql(k=4, iters=10, dim=64, final=None):
    """Ten unrolled assign/update rounds. Once an assignment repeats, the
    centroids and hence all later assignments stay the same, so the last
    round equals the result of stopping at convergence."""
    parts = [f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, v AS c
       FROM (SELECT * FROM e ORDER BY vec_id LIMIT {k}))"""]
    for i in range(iters):
        parts.append(f""", d{i} AS (SELECT e.vec_id, e.v, c{i}.cluster,
             round(coalesce(1 - list_inner_product(e.v, c{i}.c) / nullif(sqrt(list_inner_product(e.v, e.v))
                   * sqrt(list_inner_product(c{i}.c, c{i}.c)), 0.0), 1.0), 9) + 0.0 AS distance FROM e, c{i}),
a{i} AS (SELECT vec_id, v, cluster, distance FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS rn FROM d{i}) WHERE rn = 1)""")
        if i + 1 < iters:
            parts.append(f""", m{i} AS (SELECT cluster, list(x ORDER BY dim) AS c FROM (
          SELECT cluster, dim, avg(x) AS x FROM (
            SELECT cluster, unnest(range({dim})) AS dim, unnest(v) AS x FROM a{i}) GROUP BY ALL) GROUP BY cluster),
c{i + 1} AS (SELECT c{i}.cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    parts.append(final or f"\nSELECT vec_id, cluster, distance FROM a{iters - 1}")
    return "".join(parts)


def _kmeans_history_sql(iters=10):
    rows = ["SELECT 0 AS iteration, sum(distance) AS inertia, count(*) AS changed FROM a0"]
    for i in range(1, iters):
        rows.append(f"SELECT {i}, (SELECT sum(distance) FROM a{i}), (SELECT count(*) FROM a{i} "
                    f"JOIN a{i - 1} USING (vec_id) WHERE a{i}.cluster <> a{i - 1}.cluster)")
    body = "\nUNION ALL ".join(rows)
    final = f""", h AS ({body}),
st AS (SELECT min(iteration) AS s FROM h WHERE iteration > 0 AND changed = 0)
SELECT CAST(iteration AS INTEGER) AS iteration, {sig_round_sql("inertia", 9)} AS inertia,
       CAST(changed AS BIGINT) AS changed
FROM h WHERE iteration <= coalesce((SELECT s FROM st), {iters - 1})"""
    return _kmeans_full_sql(iters=iters, final=final)


@query("kmeans_cosine", _kmeans_full_sql())
def q_kmeans_cosine(spark, sf):
    e = _emb(spark, sf)
    _, assigned, _ = KM.kmeans_cosine(e, "vec_id", "embedding", 4, max_iter=10)
    return assigned.select("vec_id", "cluster", "distance")


@query("kmeans_inertia", _kmeans_history_sql())
def q_kmeans_inertia(spark, sf):
    """Total distance to the nearest centroid, per iteration of the full
    run, with the number of changed assignments."""
    _, _, hist = KM.kmeans_cosine(_emb(spark, sf), "vec_id", "embedding", 4, max_iter=10)
    return hist.select("iteration", sig_round(F.col("inertia"), 9).alias("inertia"), "changed")


@query("early_stop_select", """
WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rk,
                  max({'m': value, 'ns': -event_id}) OVER (PARTITION BY user_id ORDER BY event_id
                                                        ROWS UNBOUNDED PRECEDING) AS best
           FROM events),
b AS (SELECT r.user_id, r.event_id, r.rk, r.best.m AS best_metric, -r.best.ns AS best_step, r2.rk AS best_rk
      FROM r JOIN r r2 ON r2.user_id = r.user_id AND r2.event_id = -r.best.ns),
st AS (SELECT user_id, min(event_id) AS stop_step FROM b WHERE rk - best_rk >= 6 GROUP BY user_id),
fin AS (SELECT b.user_id, b.best_step, b.best_metric, st.stop_step,
               row_number() OVER (PARTITION BY b.user_id ORDER BY
                 CASE WHEN b.event_id = st.stop_step THEN 0 ELSE 1 END, b.rk DESC) AS pick
        FROM b LEFT JOIN st USING (user_id))
SELECT user_id, best_step, best_metric, stop_step FROM fin WHERE pick = 1
""")
def q_early_stop_select(spark, sf):
    ev = load(spark, sf, "events").select("user_id", "event_id", "value")
    return EV.early_stop_select(ev, "user_id", "event_id", "value", patience=6)


# ------------------------------------------------------------ lookups

def _gazetteer(spark, sf):
    """Places derived from ``nation``: name and coordinates by key arithmetic."""
    n = load(spark, sf, "nation")
    return n.select(F.col("n_name").alias("name"),
                    (F.col("n_nationkey") * 7.0 - 84.0).alias("lat"),
                    (F.col("n_nationkey") * 14.0 - 168.0).alias("lng"))


_GAZ_SQL = """
g AS (SELECT n_name AS name, CAST(n_nationkey * 7.0 - 84.0 AS DOUBLE) AS lat,
             CAST(n_nationkey * 14.0 - 168.0 AS DOUBLE) AS lng FROM nation)
"""


@query("geocode_forward", "WITH " + _GAZ_SQL + r"""
, c AS (SELECT c_custkey, '  nation_' || CAST(c_nationkey AS VARCHAR) || ' ' AS place FROM customer)
SELECT c_custkey, place, g.name, g.lat, g.lng FROM c
LEFT JOIN g ON upper(regexp_replace(trim(place), '\s+', ' ', 'g')) = upper(regexp_replace(trim(g.name), '\s+', ' ', 'g'))
""")
def q_geocode_forward(spark, sf):
    c = load(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("  nation_"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("place"))
    return NB.geocode_forward(c, "place", _gazetteer(spark, sf))


_PTS = """
p AS (SELECT c_custkey, CAST((c_custkey * 37) % 170 AS DOUBLE) - 84.75 AS lat,
             CAST((c_custkey * 53) % 350 AS DOUBLE) - 174.5 AS lng FROM customer)
"""


@query("geocode_reverse", "WITH " + _GAZ_SQL + "," + _PTS + """
, d AS (SELECT p.c_custkey, p.lat, p.lng, g.name AS place,
               round(2 * 6371.0 * asin(sqrt(pow(sin((radians(g.lat) - radians(p.lat)) / 2), 2)
                 + cos(radians(p.lat)) * cos(radians(g.lat)) * pow(sin((radians(g.lng) - radians(p.lng)) / 2), 2))), 6)
               AS distance_km FROM p, g)
SELECT c_custkey, lat, lng, place, distance_km FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance_km, place) AS rn FROM d) WHERE rn = 1
""")
def q_geocode_reverse(spark, sf):
    c = load(spark, sf, "customer")
    pts = c.select("c_custkey", ((F.col("c_custkey") * 37) % 170).cast("double") - 84.75,
                   ((F.col("c_custkey") * 53) % 350).cast("double") - 174.5).toDF("c_custkey", "lat", "lng")
    return NB.geocode_reverse(pts, "lat", "lng", _gazetteer(spark, sf))


@query("knn_join", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
                  CASE WHEN ((vec_id % 1000003) * 2654435761) % 1000003 < 0.8 * 1000003 THEN 'train' ELSE 'test' END AS split
           FROM embeddings),
d AS (SELECT q.vec_id, t.label AS y,
             round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (t.v[i] - q.v[i]) * (t.v[i] - q.v[i])))), 9) AS d
      FROM e q, e t WHERE q.split = 'test' AND t.split = 'train'),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, y) AS rn FROM d) WHERE rn <= 3),
v AS (SELECT vec_id, y, count(*) AS c FROM nn GROUP BY ALL)
SELECT vec_id, pred, votes FROM (
  SELECT vec_id, y AS pred, c AS votes, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, y) AS rn FROM v)
WHERE rn = 1
""")
def q_knn_join(spark, sf):
    e = split_hash(_emb(spark, sf), "vec_id", (0.8, 0.2), ("train", "test"))
    return NB.knn_classify(e.filter(F.col("split") == "test"), e.filter(F.col("split") == "train"),
                           "vec_id", "embedding", "label", k=3)
