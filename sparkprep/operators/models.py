"""Closed-form models as aggregates (SQL-checkable) and thin wrappers that
map the reference's estimator settings onto ``pyspark.ml``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V

# ------------------------------------------------------------ linear regression


def ols_simple(df: DataFrame, x: str, y: str) -> DataFrame:
    """y = intercept + slope * x by least squares (one aggregate)."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def ols_predict(df: DataFrame, fit: DataFrame, x: str, out: str = "prediction") -> DataFrame:
    from .stats import fetch_row
    r = fetch_row(fit)
    slope, icpt = r["slope"], r["intercept"]
    return df.withColumn(out, icpt + slope * F.col(x))


def ols_two(df: DataFrame, y: str, x1: str, x2: str) -> DataFrame:
    """Two predictors by the normal equations on centred moments (Cramer's
    rule on the 2x2 covariance system), then the intercept from the means."""
    m = df.agg(F.avg(y).alias("my"), F.avg(x1).alias("m1"), F.avg(x2).alias("m2"),
               F.covar_pop(x1, x1).alias("s11"), F.covar_pop(x2, x2).alias("s22"),
               F.covar_pop(x1, x2).alias("s12"), F.covar_pop(x1, y).alias("s1y"),
               F.covar_pop(x2, y).alias("s2y"))
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    b1 = (F.col("s1y") * F.col("s22") - F.col("s2y") * F.col("s12")) / det
    b2 = (F.col("s2y") * F.col("s11") - F.col("s1y") * F.col("s12")) / det
    return m.select(b1.alias("b1"), b2.alias("b2"), "my", "m1", "m2").select(
        (F.col("my") - F.col("b1") * F.col("m1") - F.col("b2") * F.col("m2")).alias("b0"), "b1", "b2")


# ------------------------------------------------------------ losses


def hinge_objective(df: DataFrame, x: str, y: str, w, b: float, c: float = 1.0) -> DataFrame:
    """Decision sign(w.x + b) and the soft-margin objective
    0.5 ||w||^2 + C * sum(max(0, 1 - y f(x))) for given weights (labels +-1)."""
    d = df.withColumn("_w", w if isinstance(w, Column) else F.lit(w))
    d = d.withColumn("_f", V.dot(F.col(x), F.col("_w")) + b).withColumn("_wn2", V.dot(F.col("_w"), F.col("_w")))
    f, wnorm2 = F.col("_f"), F.max("_wn2")
    return d.agg((0.5 * wnorm2 + c * F.sum(F.greatest(F.lit(0.0), 1 - F.col(y) * f))).alias("objective"),
                  F.count_if(F.signum(f) != F.col(y)).alias("n_misclassified"),
                  (2 / F.sqrt(wnorm2)).alias("margin"))


def log_loss(df: DataFrame, y: str, p: str, eps: float = 1e-15) -> DataFrame:
    """Mean negative log-likelihood of binary labels, p clipped to [eps, 1-eps]."""
    pc = F.least(F.greatest(F.col(p), F.lit(eps)), F.lit(1 - eps))
    yy = F.col(y).cast("double")
    return df.agg(F.avg(-(yy * F.log(pc) + (1 - yy) * F.log(1 - pc))).alias("log_loss"))


# ------------------------------------------------------------ naive Bayes


def gaussian_nb_fit(df: DataFrame, features, label: str, var_smoothing: float = 1e-9) -> DataFrame:
    """Per class and feature: prior, mean, population variance plus
    ``var_smoothing`` x the largest feature variance (over all rows)."""
    from .stats import fetch_row
    g = fetch_row(df.agg(F.count(F.lit(1)).alias("n"),
                         (F.greatest(*[F.var_pop(f) for f in features], F.lit(0.0)) * var_smoothing).alias("eps")))
    n, eps = g["n"], g["eps"]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for f in features:
        aggs += [F.avg(f).alias(f"mu_{f}"), F.var_pop(f).alias(f"var_{f}")]
    fit = df.groupBy(label).agg(*aggs)
    return fit.select(label, (F.col("_n") / n).alias("prior"),
                      *[F.col(f"mu_{f}") for f in features],
                      *[(F.col(f"var_{f}") + eps).alias(f"var_{f}") for f in features])


def gaussian_nb_predict(df: DataFrame, fit: DataFrame, features, label: str, key: str) -> DataFrame:
    """Posterior over classes via log-sum-exp; ``(key, pred, prob)``. The
    class table (one row per class) is gathered into an array scalar, so
    scoring is a projection without a join."""
    classes = fit.select(F.array_sort(F.collect_list(F.struct(
        F.col(label).alias("c"), F.col("prior"),
        *[F.col(f"mu_{f}") for f in features], *[F.col(f"var_{f}") for f in features])))).scalar()

    def jll(c):
        s = F.log(c["prior"])
        for f in features:
            v = c[f"var_{f}"]
            s = s - 0.5 * F.log(2 * math.pi * v) - 0.5 * F.pow(F.col(f) - c[f"mu_{f}"], 2) / v
        return F.struct(c["c"].alias("c"), s.alias("j"))

    scored = df.withColumn("_classes", classes).select(key, F.transform("_classes", jll).alias("_j"))
    mx = F.array_max(F.transform("_j", lambda t: t["j"]))
    lse = mx + F.log(F.aggregate(F.transform("_j", lambda t: F.exp(t["j"] - mx)), F.lit(0.0),
                                 lambda a, x: a + x))
    best = F.array_min(F.transform("_j", lambda t: F.struct((-t["j"]).alias("nj"), t["c"].alias("c"))))
    return scored.select(key, best["c"].alias("pred"), F.exp(-best["nj"] - lse).alias("prob"))


def categorical_nb_predict(df: DataFrame, features, label: str, key: str) -> DataFrame:
    """Frequency naive Bayes: argmax_c ln P(c) + sum_f ln P(f = v | c), with
    unsmoothed counts (an unseen (value, class) excludes the class); ties
    go to the smallest class."""
    n = df.select(F.count(F.lit(1))).scalar()
    prior = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    score = prior.select(label, "_nc", F.log(F.col("_nc") / n).alias("_s"))
    for f in features:
        cnt = df.groupBy(label, f).agg(F.count(F.lit(1)).alias(f"_n_{f}"))
        score = score.join(cnt, label)
        score = score.withColumn("_s", F.col("_s") + F.log(F.col(f"_n_{f}") / F.col("_nc"))).drop(f"_n_{f}")
    # score: one row per (class, value combination) seen with that class
    cand = df.select(key, *features).join(score.drop("_nc"), list(features))
    best = F.min(F.struct((-F.col("_s")).alias("ns"), F.col(label).alias("c")))
    return cand.groupBy(key).agg(best.alias("_b")).select(
        key, F.col("_b.c").alias("pred"), (-F.col("_b.ns")).alias("log_score"))


# ------------------------------------------------------------ impurity


def entropy_of_counts(counts: Column, total: Column) -> Column:
    """-sum p log2 p over an array of counts."""
    return -F.aggregate(counts, F.lit(0.0), lambda a, c: a + F.when(
        c > 0, (c / total) * F.log2(c / total)).otherwise(F.lit(0.0)))


def _impurity_from_counts(cnt: DataFrame, n) -> DataFrame:
    p = cnt.select((F.col("n") / n).alias("p"))
    return p.agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"),
                 (1 - F.sum(F.col("p") * F.col("p"))).alias("gini"))


def class_impurity(df: DataFrame, label: str) -> DataFrame:
    """Entropy (bits) and Gini impurity of the label distribution. The
    class counts (one row per class) are materialised once and the total is
    read from them, not from a second scan of the data."""
    from ..session import cut_lineage
    cnt = cut_lineage(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    return _impurity_from_counts(cnt, cnt.select(F.sum("n")).scalar())


def info_gain(df: DataFrame, label: str, attrs) -> DataFrame:
    """``(attribute, gain)``: H(label) - sum_v p(v) H(label | v) for every
    attribute. All attributes are unpivoted into one (attribute, value,
    class) count aggregate, a single scan of the data; that table is small
    (attributes x values x classes) and is materialised once."""
    from ..session import cut_lineage
    long = df.select(label, F.inline(F.array(*[
        F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("v")) for a in attrs])))
    cv = cut_lineage(long.groupBy("attribute", "v", label).agg(F.count(F.lit(1)).alias("n")))
    first = cv.filter(F.col("attribute") == attrs[0])
    classes = first.groupBy(label).agg(F.sum("n").alias("n"))
    n = classes.select(F.sum("n")).scalar()
    h = _impurity_from_counts(classes, n).select("entropy").scalar()
    per_v = cv.groupBy("attribute", "v").agg(F.sum("n").alias("nv"), F.collect_list("n").alias("ns"))
    # one row per (attribute, value); ns holds one count per class (bounded)
    cond = per_v.select("attribute", (F.col("nv") / n * entropy_of_counts(F.col("ns"), F.col("nv"))).alias("hv"))
    return cond.groupBy("attribute").agg((h - F.sum("hv")).alias("gain"))


def best_split(df: DataFrame, label: str, attrs) -> DataFrame:
    return info_gain(df, label, attrs).orderBy(F.col("gain").desc(), F.col("attribute")).limit(1)
