"""Queries: fitted models and end-to-end pipelines (2.5 horse_features,
2.6 top_features, 2.9). Model outputs have no SQL oracle (rows-only
check); their invariants live in the unit tests."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import RegexTokenizer
from pyspark.sql import functions as F

from ..functions.text import WORD2
from ..operators import boosting as BO
from ..operators import logistic as LG
from ..operators import ml as ML
from ..operators import trees as TR
from ..operators.encoding import label_encode, label_index
from ..operators.sampling import split_hash
from ..session import cut_lineage, store
from ..sources import files as IO
from ..sources.tables import load
from .registry import query


#: a pass over the rows a level: 20 rounds of depth 6 are 140 Spark jobs
GBT_ROUNDS = 20


def _emb_split(spark, sf, binary: bool):
    e = load(spark, sf, "embeddings")
    e = e.withColumn("label", ((F.col("label") < 5).cast("double") if binary
                               else F.col("label").cast("double")))
    e = ML.vectorize(e, array_col="embedding")
    e = split_hash(e, "vec_id", (0.8, 0.2), ("train", "test"))
    return e.filter(F.col("split") == "train"), e.filter(F.col("split") == "test")


@query("logistic")
def q_logistic(spark, sf):
    train, test = _emb_split(spark, sf, binary=True)
    model = ML.logistic(1.0, train.count()).fit(train)
    out = ML.probability_of(model.transform(test), 1)
    return out.select("vec_id", "label", "prediction", "p")


@query("linear_svm")
def q_linear_svm(spark, sf):
    train, test = _emb_split(spark, sf, binary=True)
    model = ML.linear_svm(1.0, train.count()).fit(train)
    w = model.coefficients.toArray()
    margin = float(2.0 / (w @ w) ** 0.5) if (w @ w) > 0 else None
    return model.transform(test).select("vec_id", "label", "prediction",
                                        F.lit(margin).cast("double").alias("margin"))


def _emb_classes(spark, sf):
    """Training and test rows, and the number of classes (labels are 0, 1, ...)."""
    e = split_hash(load(spark, sf, "embeddings").select("vec_id", "label", "embedding"), "vec_id", (0.8, 0.2), ("train", "test"))
    k = e.agg(F.max("label")).first()[0]
    return e.filter(F.col("split") == "train"), e.filter(F.col("split") == "test"), 0 if k is None else int(k) + 1


@query("tree_entropy")
def q_tree_entropy(spark, sf):
    train, test, k = _emb_classes(spark, sf)
    out = TR.predict_tree(TR.grow_tree(train, k, features="embedding"), test, "embedding")
    return out.select("vec_id", F.col("label").cast("double").alias("label"), "prediction")


@query("tree_rules")
def q_tree_rules(spark, sf):
    train, _, k = _emb_classes(spark, sf)
    return TR.tree_table(TR.grow_tree(train, k, features="embedding"), [f"dim_{i}" for i in range(64)])


@query("random_forest")
def q_random_forest(spark, sf):
    train, test = _emb_split(spark, sf, binary=False)
    model = ML.random_forest().fit(train)
    return model.transform(test).select("vec_id", "label", "prediction")


def _orders_features(spark, sf):
    o = load(spark, sf, "orders")
    f = o.select("o_orderkey",
                 F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "O", 1.0)
                  .otherwise(2.0).alias("label"),
                 F.col("o_totalprice"), F.substring("o_orderpriority", 1, 1).cast("double").alias("prio"),
                 F.year("o_orderdate").cast("double").alias("year"))
    f = ML.vectorize(f, ["o_totalprice", "prio", "year"])
    return split_hash(f, "o_orderkey", (0.8, 0.2), ("train", "test"))


@query("gbt_multiclass")
def q_gbt_multiclass(spark, sf):
    f = _orders_features(spark, sf).withColumn("x", F.array("o_totalprice", "prio", "year"))
    model = BO.boost(f.filter(F.col("split") == "train"), 3, 3, features="x", rounds=GBT_ROUNDS)
    test = f.filter(F.col("split") == "test").select("o_orderkey", "label", "x")
    return BO.predict(model, test, "x").select("o_orderkey", "label", "prediction")


@query("mlp_grid")
def q_mlp_grid(spark, sf):
    from ..operators.scaling import standard_fit, standard_transform
    cols = ["o_totalprice", "prio", "year"]
    # one split: a second one by the same hash would find all training rows under its threshold
    f = split_hash(_orders_features(spark, sf).drop("features", "split"), "o_orderkey", (0.72, 0.08, 0.2), ("train", "val", "test"))
    fit = standard_fit(f.filter(F.col("split") != "test"), cols)
    f = ML.vectorize(standard_transform(f, fit, cols), cols)
    tv = cut_lineage(f.filter(F.col("split") != "test"))  # all fits read it
    grid = [{"layers": [3, h, 3], "step_size": s} for h in (4, 8, 16, 32) for s in (0.01, 0.03, 0.1, 0.3)]
    best, model, scores = ML.grid_search(tv.filter(F.col("split") == "train"),
                                         tv.filter(F.col("split") == "val"),
                                         lambda layers, step_size: ML.mlp(layers, step_size), grid)
    return model.transform(f.filter(F.col("split") == "test")).select("o_orderkey", "label", "prediction")


def _labelled_docs(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "text")
    lab = load(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return split_hash(d.join(lab, "doc_id"), "doc_id", (0.7, 0.1, 0.2), ("train", "val", "test"))


def _bow(spark, sf):
    """The term counts of all labelled documents, and by row of that matrix
    the label (NaN where it is null) and the split."""
    tok = RegexTokenizer(inputCol="text", outputCol="tokens", pattern=WORD2, gaps=False, toLowercase=True)
    docs = tok.transform(_labelled_docs(spark, sf).fillna("", ["text"]))
    m = LG.matrix(docs, "tokens", ["doc_id", "label", "split"])
    rows = m.rows.select("row", "label", "split").toPandas().sort_values("row")
    t, split = rows["label"].to_numpy(float, na_value=float("nan")), rows["split"].to_numpy()
    if not set(t[~np.isnan(t)]) <= {0.0, 1.0}:
        raise ValueError("labels other than 0 and 1")
    return m, t, split


def _accuracy(fit, t, rows) -> float:
    """Share of the labelled ``rows`` that a fit predicts (0 without any)."""
    rows = rows & ~np.isnan(t)
    _, z, b = fit
    return float(((z + b > 0) == (t == 1))[rows].mean()) if rows.any() else 0.0


def _text_sweep(spark, sf):
    """Eleven logistic fits (C = 3^-5 .. 3^5) on the terms of the training
    part share their passes (or run side by side, each in a task); the first best validation accuracy wins; refit on
    train + validation, whose terms are then the vocabulary."""
    m, t, split = _bow(spark, sf)
    train, val, test = (split == s for s in ("train", "val", "test"))
    known, directions = ~np.isnan(t), LG.sketch(m)
    grid = range(-5, 6)
    fits = LG.fit_all(m, t, [(train & known, 3.0 ** e) for e in grid], directions, apart=m.whole)
    rows = [(e, 3.0 ** e, _accuracy(f, t, val)) for e, f in zip(grid, fits)]
    top = max(a for _, _, a in rows)
    best = next(r for r in rows if r[2] == top)  # first (smallest C) among ties
    final = LG.fit_all(m, t, [((train | val) & known, best[1])], directions, apart=m.whole)[0]
    m.entries.unpersist()
    return rows, best, final, _accuracy(final, t, test)


@query("text_logistic_sweep")
def q_text_logistic_sweep(spark, sf):
    rows, best, _, test_acc = _text_sweep(spark, sf)
    out = [(e, c, a, e == best[0], test_acc if e == best[0] else None) for e, c, a in rows]
    return spark.createDataFrame(out, "exponent int, c double, val_accuracy double, best boolean, "
                                      "test_accuracy double")


@query("top_features")
def q_top_features(spark, sf):
    """Largest positive and negative coefficients of the text model, each with
    its term and the term's place in the vocabulary by occurrences."""
    m, t, split = _bow(spark, sf)
    fitted = (split != "test") & ~np.isnan(t)
    a, _, _ = LG.fit_all(m, t, [(fitted, 1.0)], apart=m.whole)[0]
    m.entries.unpersist()
    terms = cut_lineage(LG.weights(m, a, split != "test"))
    pos = terms.orderBy(F.col("weight").desc(), "term").limit(10).withColumn("side", F.lit("positive"))
    neg = terms.orderBy(F.col("weight").asc(), "term").limit(10).withColumn("side", F.lit("negative"))
    top = cut_lineage(pos.unionByName(neg))
    more = terms.select(F.col("term").alias("_t"), F.col("total").alias("_n"))
    before = (F.col("_n") > F.col("total")) | ((F.col("_n") == F.col("total")) & (F.col("_t") < F.col("term")))
    idx = more.join(F.broadcast(top.select("term", "total").distinct()), before).groupBy("term").agg(F.count(F.lit(1)).alias("idx"))
    return top.join(F.broadcast(idx), "term", "left").select(
        F.coalesce("idx", F.lit(0)).cast("int").alias("idx"), "term", "weight", "side")


@query("embedding_classifier")
def q_embedding_classifier(spark, sf):
    """Multinomial logistic regression over a pooled document vector
    concatenated with a second block (log length), predicting language."""
    from ..operators import index as IX
    from ..operators.vectors import concat_features, doc_mean_vectors
    from ..plans.q_text import token_vectors, vec_token_lists
    tf = IX.term_bags(vec_token_lists(spark, sf))
    pooled = doc_mean_vectors(tf, token_vectors(spark, sf, tf), "doc_id", "token", "embedding", 64
                              ).withColumnRenamed("mean", "pooled")
    docs = load(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    d = docs.join(pooled, "doc_id")
    # every language that occurs, by its place in alphabetical order
    d = label_encode(d.where("lang is not null"), "lang", out="label", index=label_index(docs, "lang")).withColumn(
        "label", F.col("label").cast("double"))
    d = d.withColumn("x", concat_features(F.col("pooled"), F.array(F.log1p(F.col("n_chars")))))
    # the count, the fit and the test rows read one stored table
    d = store(d.select("doc_id", "label", "x"))
    d = split_hash(ML.vectorize(d, array_col="x"), "doc_id", (0.8, 0.2), ("train", "test"))
    train = d.filter(F.col("split") == "train")
    model = ML.logistic(1.0, train.count(), multinomial=True).fit(train)
    return model.transform(d.filter(F.col("split") == "test")).select("doc_id", "label", "prediction")


@query("model_io")
def q_model_io(spark, sf):
    """Fit, save to shared storage, load back and score: scores must equal
    those of the in-memory model (checked in the tests)."""
    train, test = _emb_split(spark, sf, binary=True)
    model = ML.pipeline(ML.logistic(1.0, train.count())).fit(train)
    path = IO.save_model(model, IO.scratch_path(spark, "model"))
    loaded = IO.load_pipeline_model(path)
    return ML.probability_of(loaded.transform(test), 1).select("vec_id", "prediction", "p")


@query("titanic_pipeline")
def q_titanic_pipeline(spark, sf):
    from .pipelines import titanic_like
    return titanic_like(spark, sf)


@query("defects_pipeline")
def q_defects_pipeline(spark, sf):
    from .pipelines import defects_like
    return defects_like(spark, sf)


_HORSE_SQL = """
WITH o AS (SELECT o_orderkey, o_totalprice,
                  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                  CAST(year(o_orderdate) AS VARCHAR) AS o_year,
                  CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
                       WHEN '3-MEDIUM' THEN 'medium' WHEN '4-NOT SPECIFIED' THEN 'unspecified'
                       WHEN '5-LOW' THEN 'low' END AS priority
           FROM orders),
m AS (SELECT o_orderstatus AS v FROM o WHERE o_orderstatus IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
f AS (SELECT o_orderkey, o_totalprice, coalesce(o_orderstatus, (SELECT v FROM m)) AS o_orderstatus, o_year,
             CASE priority WHEN 'low' THEN 0 WHEN 'unspecified' THEN 1 WHEN 'medium' THEN 2
                           WHEN 'high' THEN 3 WHEN 'urgent' THEN 4 END AS priority_ord FROM o),
s AS (SELECT avg(o_totalprice) AS mu,
             CASE WHEN stddev_pop(o_totalprice) = 0 THEN 1.0 ELSE stddev_pop(o_totalprice) END AS sd FROM f)
SELECT o_orderkey, round((o_totalprice - mu) / sd, 6) AS o_totalprice, o_orderstatus,
       CAST(priority_ord AS INTEGER) AS priority_ord, CAST(o_year = '1996' AS DOUBLE) AS o_year_1996, CAST(o_year = '1997' AS DOUBLE) AS o_year_1997, CAST(o_year = '1998' AS DOUBLE) AS o_year_1998, CAST(o_year = '1999' AS DOUBLE) AS o_year_1999, CAST(o_year = '2000' AS DOUBLE) AS o_year_2000, CAST(o_year = '2001' AS DOUBLE) AS o_year_2001,
       CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS target
FROM f, s
"""


@query("horse_features", _HORSE_SQL)
def q_horse_features(spark, sf):
    from .common import rounded
    from .pipelines import horse_like_features
    return rounded(horse_like_features(spark, sf))
