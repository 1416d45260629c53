"""The training summary as text lines, built from the evaluation record
and the importance table with ``format_string`` -- tiny, after the Spark aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary_report(evaluation: DataFrame, importance: DataFrame, version: str, top: int = 10) -> DataFrame:
    """One row per report line (column ``line``), in order (column ``n``)."""
    e = evaluation.select(
        F.col("model_name"), F.col("auc_score"),
        F.col("confusion_matrix.*"), F.col("business_metrics.*"))
    head = e.select(F.explode(F.array(
        F.lit("PREDICTIVE MAINTENANCE MODEL - TRAINING SUMMARY"),
        F.format_string("Model version: %s", F.lit(version)),
        F.format_string("Model: %s", F.col("model_name")),
        F.lit("PERFORMANCE"),
        F.format_string("ROC AUC: %.4f", F.col("auc_score")),
        F.format_string("Precision: %.3f", F.col("precision")),
        F.format_string("Recall: %.3f", F.col("recall")),
        F.format_string("False alarm rate: %.3f", F.col("false_alarm_rate")),
        F.format_string("Miss rate: %.3f", F.col("miss_rate")),
        F.lit("CONFUSION MATRIX"),
        F.format_string("True negatives: %d", F.col("true_negatives")),
        F.format_string("False positives: %d", F.col("false_positives")),
        F.format_string("False negatives: %d", F.col("false_negatives")),
        F.format_string("True positives: %d", F.col("true_positives")),
        F.lit("TOP FEATURES"),
    )).alias("line")).select(F.monotonically_increasing_id().alias("n"), "line")
    feats = (importance.orderBy(F.col("importance").desc(), "feature").limit(top)
             .select(F.format_string("%s: %.4f", F.col("feature"), F.col("importance")).alias("line")))
    feats = feats.select((F.lit(1000) + F.monotonically_increasing_id()).alias("n"), "line")
    return head.unionByName(feats).orderBy("n")


def write_report(report: DataFrame, path: str) -> None:
    report.orderBy("n").select("line").coalesce(1).write.mode("overwrite").text(path)
