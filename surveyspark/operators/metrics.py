"""Classification audit tables (A15-A19, V6) computed with Spark SQL over (y, pred) columns.

Everything is derived from one grouped count of (y, pred) -- a table of at most k*k rows for
k classes -- so the data are scanned once regardless of how many metrics are reported.
Metrics are computed on the original labels, never on indexer outputs (an indexer with
``handleInvalid=keep`` would add a phantom class).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from surveyspark.functions.expressions import safe_div
from surveyspark.session import reliable_checkpoint


def pair_counts(df: DataFrame, y: str, pred: str) -> DataFrame:
    """The one pass over the scored rows: counts per (y, pred), at most k*k rows.

    Checkpointed (shared storage) so that the class list, the confusion matrix and the
    real-vs-predicted series all read this small table instead of re-scanning the data.
    Columns: y, pred (as text), n.
    """
    return reliable_checkpoint(
        df.filter(F.col(y).isNotNull())
        .groupBy(F.col(y).cast("string").alias("y"), F.col(pred).cast("string").alias("pred"))
        .agg(F.count(F.lit(1)).alias("n")))


def classes(counts: DataFrame) -> DataFrame:
    """(clase): the classes of a pair-count table, true or predicted. Stays in Spark, however many there are."""
    both = counts.select(F.col("y").alias("clase")).union(counts.select(F.col("pred").alias("clase")))
    return both.filter(F.col("clase").isNotNull()).distinct()


def known_pairs(counts: DataFrame) -> DataFrame:
    """The cells that occur, without rows that have no prediction. Every metric but the full matrix follows from these."""
    return counts.filter(F.col("pred").isNotNull())


def confusion_from_counts(counts: DataFrame) -> DataFrame:
    """Long confusion matrix (y, pred, n) with its zero cells (k*k rows, as its definition asks).

    Each class is unfolded by the array of all classes, a scalar of k names that Spark makes."""
    names = classes(counts)
    every = names.agg(F.sort_array(F.collect_list("clase")).alias("a")).scalar()
    grid = names.select(F.col("clase").alias("y"), F.explode(every).alias("pred"))
    return (grid.join(known_pairs(counts), ["y", "pred"], "left")
            .select("y", "pred", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def confusion_matrix(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Long confusion matrix (y, pred, n) over all classes, zero cells kept."""
    return confusion_from_counts(pair_counts(df, y, pred))


def class_counts(cm: DataFrame) -> DataFrame:
    """Per class TP, FP, FN, TN from the cells (y, pred, n); zero cells may be left out."""
    tot = cm.agg(F.sum("n")).scalar()
    rows = cm.groupBy(F.col("y").alias("clase")).agg(
        F.sum(F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum("n").alias("_row"))
    cols = cm.groupBy(F.col("pred").alias("clase")).agg(F.sum("n").alias("_col"))
    j = rows.join(cols, "clase", "full").fillna(0, ["tp", "_row", "_col"])
    return j.select(
        "clase",
        F.col("tp").cast("bigint").alias("tp"),
        (F.col("_col") - F.col("tp")).cast("bigint").alias("fp"),
        (F.col("_row") - F.col("tp")).cast("bigint").alias("fn"),
        (tot - F.col("_row") - F.col("_col") + F.col("tp")).cast("bigint").alias("tn"))


def per_class(cm: DataFrame) -> DataFrame:
    """Per-class precision, recall, F1, support (``zero_division=0``)."""
    cc = class_counts(cm)
    p = F.coalesce(safe_div(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(safe_div(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    with_pr = cc.withColumn("precision", p).withColumn("recall", r)
    f1 = F.coalesce(safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return with_pr.withColumn("f1_score", f1).withColumn("support", (F.col("tp") + F.col("fn")).cast("bigint"))


def weighted_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1. One row."""
    return weighted_from_confusion(known_pairs(pair_counts(df, y, pred)))


def weighted_from_confusion(cm: DataFrame) -> DataFrame:
    pc = per_class(cm)
    return pc.agg(
        safe_div(F.sum("tp"), F.sum("support")).alias("accuracy"),
        safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("precision_weighted"),
        safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("recall_weighted"),
        safe_div(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("f1_weighted"))


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per-class rows plus 'accuracy', 'macro avg' and 'weighted avg' rows.

    Columns: etiqueta, precision, recall, f1_score, support (the accuracy row carries only
    f1_score = accuracy and the total support, like the text report).
    """
    return report_from_confusion(known_pairs(pair_counts(df, y, pred)))


def report_from_confusion(cm: DataFrame) -> DataFrame:
    pc = per_class(cm)
    per = pc.select(F.col("clase").alias("etiqueta"), "precision", "recall", "f1_score", "support")
    acc = pc.agg(
        F.lit("accuracy").alias("etiqueta"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"), safe_div(F.sum("tp"), F.sum("support")).alias("f1_score"),
        F.sum("support").cast("bigint").alias("support"))
    macro = pc.agg(
        F.lit("macro avg").alias("etiqueta"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("f1_score").alias("f1_score"), F.sum("support").cast("bigint").alias("support"))
    weighted = pc.agg(
        F.lit("weighted avg").alias("etiqueta"),
        safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("precision"),
        safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("recall"),
        safe_div(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("f1_score"),
        F.sum("support").cast("bigint").alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def real_vs_predicted_from_counts(counts: DataFrame) -> DataFrame:
    real = counts.groupBy(F.col("y").alias("clase")).agg(F.sum("n").cast("bigint").alias("real"))
    predicted = counts.groupBy(F.col("pred").alias("clase")).agg(F.sum("n").cast("bigint").alias("predicho"))
    return real.join(predicted, "clase", "left").select(
        "clase", "real", F.coalesce("predicho", F.lit(0)).cast("bigint").alias("predicho"))


def real_vs_predicted(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per class seen in y, the true count and the predicted count."""
    return real_vs_predicted_from_counts(pair_counts(df, y, pred))


def audit_series_from_counts(counts: DataFrame) -> DataFrame:
    pc = per_class(known_pairs(counts))
    rvp = real_vs_predicted_from_counts(counts)
    return pc.join(rvp, "clase", "left").select(
        "clase", "tp", "fp", "fn", "tn", "precision", "recall", "f1_score", "support",
        F.coalesce("real", F.lit(0)).cast("bigint").alias("real"),
        F.coalesce("predicho", F.lit(0)).cast("bigint").alias("predicho"))


def audit_series(df: DataFrame, y: str, pred: str) -> DataFrame:
    """V6: one row per class with confusion counts, P/R/F1/support and real vs predicted."""
    return audit_series_from_counts(pair_counts(df, y, pred))
