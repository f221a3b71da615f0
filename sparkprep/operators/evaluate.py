"""Model evaluation as aggregates: accuracy, per-class report, macro F1,
regression metrics, early-stopping selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import grouped_scan


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class over truth U prediction: precision, recall, f1, support
    (0/0 -> 0), plus 'macro avg' and 'weighted avg' rows (class as string)."""
    truth = df.groupBy(F.col(label).alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    predicted = df.groupBy(F.col(pred).alias("cls")).agg(F.count(F.lit(1)).alias("n_pred"))
    tp = (df.filter(F.col(label) == F.col(pred)).groupBy(F.col(label).alias("cls"))
            .agg(F.count(F.lit(1)).alias("tp")))
    per = (truth.join(predicted, "cls", "full").join(tp, "cls", "left")
                .na.fill(0, ["support", "n_pred", "tp"]))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = per.select(F.col("cls").cast("string").alias("class"), p.alias("precision"),
                     r.alias("recall"), F.col("support").cast("long").alias("support"))
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.sum("support").alias("support"),
                    F.avg("f1").alias("f1"))
    tot = F.sum("support")
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                       tot.alias("support"),
                       (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"))
    return per.unionByName(macro).unionByName(weighted)


def macro_f1(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Unweighted mean F1 over the labels present in truth or prediction."""
    rep = classification_report(df, label, pred)
    return rep.filter(F.col("class") == "macro avg").select(F.col("f1").alias("macro_f1"))


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """SSE, MSE, MAE, RMSE and R^2 (1 - SSE / total sum of squares)."""
    err = F.col(y) - F.col(yhat)
    mean_y = df.select(F.avg(y)).scalar()
    one = df.agg(F.sum(err * err).alias("sse"), F.avg(err * err).alias("mse"),
                 F.avg(F.abs(err)).alias("mae"),
                 F.sum(F.pow(F.col(y) - mean_y, 2)).alias("_sst"))
    return one.select("sse", "mse", "mae", F.sqrt("mse").alias("rmse"),
                      (1 - F.col("sse") / F.col("_sst")).alias("r2"))


def early_stop_select(df: DataFrame, run: str, step: str, metric: str,
                      patience: int = 6) -> DataFrame:
    """Per run: walk the steps in order keeping the best metric (strict
    improvement); stop at the first step that is ``patience`` steps after
    the best. Returns ``(run, best_step, best_metric, stop_step)`` with
    stop_step null when training ran to the end.

    A NaN metric is no improvement. Step numbers and the running best (with
    its own step number) come from segmented scans, so one run with most of
    the steps is still spread over all tasks."""
    m = F.when(~F.isnan(F.col(metric).cast("double")), F.col(metric))
    numbered = grouped_scan(df, [run], [step], {"_rank": ("count", F.lit(1))})
    best = F.when(m.isNotNull(), F.struct(m.alias("m"), (-F.col("_rank")).alias("r"), F.col(step).alias("s")))
    s = grouped_scan(numbered, [run], ["_rank"], {"_best": ("max", best)}).select(
        run, step, "_rank", F.col("_best.m").alias("best_metric"), F.col("_best.s").alias("best_step"),
        (-F.col("_best.r")).alias("_best_rank"))
    done = F.when(F.col("_rank") - F.col("_best_rank") >= patience, F.struct("_rank", step, "best_step", "best_metric"))
    out = s.groupBy(run).agg(F.min(done).alias("_stop"), F.max(F.struct("_rank", "best_step", "best_metric")).alias("_last"))
    return out.select(run,
                      F.coalesce(F.col("_stop.best_step"), F.col("_last.best_step")).alias("best_step"),
                      F.coalesce(F.col("_stop.best_metric"), F.col("_last.best_metric")).alias("best_metric"),
                      F.col(f"_stop.{step}").alias("stop_step"))
