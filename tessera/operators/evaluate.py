"""Evaluation tables (E1-E9) over any (label, prediction/score) DataFrame.

Every metric is one aggregate with a partial phase.  The exact ROC-AUC uses a
distributed prefix scan over distinct scores (no global sort in one task) and
the threshold sweep counts each row once into the slot of its threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["accuracy", "confusion_counts", "prf", "classification_metrics", "roc_auc", "r2", "half_mse",
           "SWEEP", "threshold_sweep", "confusion", "scores_by_split", "metrics_table"]

# fixed values: the 17 probability cut-offs 0.10, 0.15, ..., 0.90 (start + i * step)
SWEEP = [0.1 + 0.05 * i for i in range(17)]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def accuracy(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """E1."""
    a = F.avg((_c(y) == _c(pred)).cast("double")).alias("accuracy")
    return df.groupBy(*by).agg(a) if by else df.agg(a)


def confusion_counts(y, pred) -> list[Column]:
    """tp, fp, fn, tn for class 1 as aggregate expressions."""
    yy, pp = _c(y), _c(pred)
    return [F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy != 1) & (pp == 1)).alias("fp"),
            F.count_if((yy == 1) & (pp != 1)).alias("fn"), F.count_if((yy != 1) & (pp != 1)).alias("tn")]


def _ratios(tp, fp, fn, tn) -> list[Column]:
    z = F.lit(0.0)
    prec = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), z)
    rec = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), z)
    f1 = F.coalesce(F.try_divide((2 * tp).cast("double"), 2 * tp + fp + fn), z)
    acc = F.try_divide((tp + tn).cast("double"), tp + fp + fn + tn)
    return [acc.alias("accuracy"), prec.alias("precision"), rec.alias("recall"), f1.alias("f1")]


def prf(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 (zero division -> 0)."""
    counts = df.groupBy(*by).agg(*confusion_counts(y, pred)) if by else df.agg(*confusion_counts(y, pred))
    return counts.select(*by, *_ratios(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC (ties count one half): sum over positives of the negatives
    scored below plus half the tied negatives, over P*N.

    Counts per (group, distinct score), then a distributed prefix sum of negatives in
    score order -- the scores of a group are split into range chunks, never sorted
    in a single task.
    """
    from tessera.operators.windows import prefix_scan

    by = list(by)
    yy = _c(y)
    per = df.where(_c(score).isNotNull() & yy.isNotNull()).groupBy(*by, _c(score).alias("__s")).agg(
        F.count_if(yy == 1).alias("__p"), F.count_if(yy != 1).alias("__n"))
    scanned = prefix_scan(per, by, ["__s"], {"__nb": ("sum", F.col("__n"))}, inclusive=False)
    tot = scanned.groupBy(*by).agg(
        F.sum(F.col("__p") * (F.col("__nb") + F.col("__n") / 2.0)).alias("__num"),
        F.sum("__p").alias("__P"), F.sum("__n").alias("__N"))
    return tot.select(*by, F.try_divide(F.col("__num"), F.col("__P") * F.col("__N")).alias("auc"))


def r2(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - SS_res / SS_tot in one pass (SS_tot from the stable ``var_pop``)."""
    res = F.sum((_c(y) - _c(pred)) ** 2)
    tot = F.var_pop(_c(y)) * F.count(_c(y))
    a = (F.lit(1.0) - F.try_divide(res, tot)).alias("r2")
    return df.groupBy(*by).agg(a) if by else df.agg(a)


def half_mse(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """E5: J = sum((h - y)^2) / (2 m)."""
    a = (F.sum((_c(pred) - _c(y)) ** 2) / (2 * F.count(F.lit(1)))).alias("J")
    return df.groupBy(*by).agg(a) if by else df.agg(a)


def threshold_sweep(df: DataFrame, y: str, prob: str, thresholds: Sequence[float] = SWEEP) -> DataFrame:
    """Recall, precision, F1 and accuracy of ``prob >= t`` for every threshold.

    One scan: each row goes to slot j = number of thresholds <= prob; counts per
    (slot, class) are then summed from the top slot down, so the positives at
    threshold i are the rows in slots > i.  The threshold axis is a small literal
    table joined by slot -- no per-threshold job and no pairing of rows with thresholds.
    """
    ts = [float(t) for t in thresholds]
    slot = sum(((_c(prob) >= F.lit(t)).cast("int") for t in ts), F.lit(0))
    counts = (df.withColumn("__j", slot).groupBy("__j")
                .agg(F.count_if(_c(y) == 1).alias("__pos"), F.count_if(_c(y) != 1).alias("__neg")))
    spark = df.sparkSession
    axis = spark.createDataFrame([(i + 1, t) for i, t in enumerate(ts)] + [(0, None)],
                                 "__j int, threshold double")
    full = axis.join(counts, "__j", "left").fillna(0, ["__pos", "__neg"])
    above = Window.orderBy(F.col("__j").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = full.select("__j", "threshold",
                      F.sum("__pos").over(above).alias("tp"), F.sum("__neg").over(above).alias("fp"),
                      F.sum("__pos").over(Window.rowsBetween(Window.unboundedPreceding,
                                                             Window.unboundedFollowing)).alias("P"),
                      F.sum("__neg").over(Window.rowsBetween(Window.unboundedPreceding,
                                                             Window.unboundedFollowing)).alias("N"))
    cum = cum.where(F.col("threshold").isNotNull())
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    return cum.select("threshold", *_ratios(tp, fp, fn, tn))


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """E7."""
    return df.groupBy(_c(y).alias("actual"), _c(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def scores_by_split(df: DataFrame, y: str, pred: str, split: str) -> DataFrame:
    """Train score against test score (accuracy per split flag)."""
    return accuracy(df, y, pred, by=[split])


def classification_metrics(df: DataFrame, y: str, pred: str, prob: str | None = None) -> DataFrame:
    """E2 + E3 as one row: accuracy, precision, recall, f1 (and auc when ``prob`` is given)."""
    base = prf(df, y, pred)
    if prob is None:
        return base
    # both sides are single aggregate rows: an equi-join on a constant key, broadcast
    auc = F.broadcast(roc_auc(df, y, prob).withColumn("__k", F.lit(1)))
    return base.withColumn("__k", F.lit(1)).join(auc, "__k").drop("__k")


def metrics_table(results: Mapping[str, DataFrame], wide: bool = True) -> DataFrame:
    """One-row metric frames per model -> long (model, metric, value) or pivoted wide."""
    longs = []
    for name, m in results.items():
        longs.append(m.select(F.lit(name).alias("model"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in m.columns
        ])).alias("kv")).select("model", "kv.*"))
    out = longs[0]
    for x in longs[1:]:
        out = out.unionByName(x)
    if not wide:
        return out
    return out.groupBy("model").pivot("metric").agg(F.first("value"))
