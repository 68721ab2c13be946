"""Classification metrics (A1, A10-A13) computed by aggregation.

All metrics are exact and come from ``groupBy`` counts: nothing is collected
row-wise. ROC AUC (A12) is the Mann-Whitney statistic with ties counted
half, over one row per distinct score with distributed running totals, so it
stays parallel when scores are nearly all distinct (SURVEY H4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cumulative import running_totals


def split_summary(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """A1: rows and label rate per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).cast("long").alias("rows"),
                                     F.avg(F.col(label).cast("double")).alias("label_rate"))


def _safe(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1; a zero denominator
    gives 0 (scikit-learn ``zero_division`` default behaviour). Rows without
    a label or a prediction don't count, as in A10 and A13."""
    y, p = F.col(label), F.col(pred)
    agg = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((y == p).cast("long")).alias("correct"),
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum((p == 1).cast("long")).alias("pp"),
        F.sum((y == 1).cast("long")).alias("ap"),
    )
    prec = _safe(F.col("tp"), F.col("pp"))
    rec = _safe(F.col("tp"), F.col("ap"))
    return agg.select(
        _safe(F.col("correct"), F.col("n")).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        _safe(F.lit(2.0) * prec * rec, prec + rec).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str, score: str, parts: int | None = None) -> DataFrame:
    """Exact ROC AUC of ``score`` for class 1 (ties count half); NULL
    when only one class is present. Equals ``BinaryClassificationEvaluator``
    with ``numBins=0``."""
    y = F.col(label)
    per_score = df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.sum((y == 1).cast("long")).alias("_pos"),
        F.sum((y != 1).cast("long")).alias("_neg"))
    rt = running_totals(per_score, [], "_s", ["_neg"], parts)
    agg = rt.agg(
        F.sum(F.col("_pos").cast("double") * ((F.col("_neg_cum") - F.col("_neg")).cast("double")
                                              + F.col("_neg").cast("double") * 0.5)).alias("_u"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    return agg.select(F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                             F.col("_u") / (F.col("_p").cast("double") * F.col("_n").cast("double")))
                      .alias("auc"))


# classes that a confusion matrix may have
MAX_CLASSES = 1000


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """A10: ``(actual, predicted, count)`` over the sorted union of label
    values, zeros filled. Rows without a label or a prediction don't count, as
    in A11 and A13. The grid has (classes)^2 rows: it is meant for labels, and
    more than ``MAX_CLASSES`` distinct values raise an error."""
    counts = df.where(F.col(label).isNotNull() & F.col(pred).isNotNull()) \
        .groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")) \
        .agg(F.count(F.lit(1)).cast("long").alias("count"))
    found = counts.select("actual").union(counts.select("predicted")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label} and {pred}")
    classes = sorted(r[0] for r in found)
    spark: SparkSession = df.sparkSession
    dtype = dict(counts.dtypes)["actual"]
    grid = spark.createDataFrame([(a, p) for a in classes for p in classes],
                                 f"actual {dtype}, predicted {dtype}")
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision / recall / F1 / support, then accuracy, macro
    and weighted averages (labels as strings, as the printed report)."""
    cm = confusion_matrix(df, label, pred)
    per = cm.groupBy(F.col("actual").alias("c")).agg(
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)).alias("tp"),
        F.sum("count").alias("support"))
    predicted = cm.groupBy(F.col("predicted").alias("c")).agg(F.sum("count").alias("pp"))
    per = per.join(predicted, "c")
    prec = _safe(F.col("tp"), F.col("pp"))
    rec = _safe(F.col("tp"), F.col("support"))
    per = per.select(F.col("c").cast("string").alias("class"), prec.alias("precision"),
                     rec.alias("recall"), _safe(2.0 * prec * rec, prec + rec).alias("f1_score"),
                     F.col("support").cast("long").alias("support"), F.col("tp"))
    # one-row global aggregate over the per-class table
    extra = per.agg(
        F.sum("support").alias("_total"), F.sum("tp").alias("_tp_total"),
        F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1_score").alias("_mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("_wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("_wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("_wf"),
    )
    none = F.lit(None).cast("double")
    acc = extra.select(F.lit("accuracy").alias("class"), none.alias("precision"), none.alias("recall"),
                       (F.col("_tp_total") / F.col("_total")).alias("f1_score"),
                       F.col("_total").cast("long").alias("support"))
    macro = extra.select(F.lit("macro avg").alias("class"), F.col("_mp").alias("precision"),
                         F.col("_mr").alias("recall"), F.col("_mf").alias("f1_score"),
                         F.col("_total").cast("long").alias("support"))
    weighted = extra.select(F.lit("weighted avg").alias("class"), F.col("_wp").alias("precision"),
                            F.col("_wr").alias("recall"), F.col("_wf").alias("f1_score"),
                            F.col("_total").cast("long").alias("support"))
    return per.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)
