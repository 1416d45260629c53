"""Queries: evaluation on a deterministic score (E1-E5). The score is props.k/99 of the
same event, the label is J1's; no model enters an oracle query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators.labels import failure_labels
from ..sources import adapt as A
from . import register
from .prep import LABELED

SCORED_SQL = f"""SELECT failure_within_window AS y, rotate / 99.0 AS score,
  CAST(rotate / 99.0 > 0.5 AS INTEGER) AS prediction FROM ({LABELED})"""
CM_SQL = f"""SELECT count(*) FILTER (WHERE y = 0 AND prediction = 0) AS true_negatives,
  count(*) FILTER (WHERE y = 0 AND prediction = 1) AS false_positives,
  count(*) FILTER (WHERE y = 1 AND prediction = 0) AS false_negatives,
  count(*) FILTER (WHERE y = 1 AND prediction = 1) AS true_positives FROM ({SCORED_SQL})"""


def scored(spark, sf):
    ev = A.table(spark, sf, "events")
    lab = failure_labels(A.telemetry_from_events(ev), A.failures_from_events(ev))
    s = F.col("rotate") / 99.0
    return lab.select(F.col("failure_within_window"), s.alias("score"), (s > 0.5).cast("int").alias("prediction"))


@register("confusion_matrix", sql=CM_SQL)
def confusion_matrix_q(spark, sf):
    """Tn, fp, fn, tp in one aggregation."""
    return E.confusion(scored(spark, sf))


BM_SQL = f"""SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS "precision",
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END AS false_alarm_rate,
  CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0.0 END AS miss_rate
FROM (SELECT true_negatives AS tn, false_positives AS fp, false_negatives AS fn, true_positives AS tp FROM ({CM_SQL}))"""


@register("business_metrics", sql=f"""
SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
  round("precision", 6) AS "precision", round(recall, 6) AS recall, round(false_alarm_rate, 6) AS false_alarm_rate,
  round(miss_rate, 6) AS miss_rate FROM ({BM_SQL})""")
def business_metrics_q(spark, sf):
    """Precision, recall, false-alarm and miss rate."""
    return E.business_metrics(E.confusion(scored(spark, sf)))


AUC_SQL = f"""
WITH s AS ({SCORED_SQL}),
g AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM s GROUP BY score),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS below FROM g)
SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
  THEN sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END AS auc_score FROM c"""


@register("roc_auc", headline=True, sql=f"SELECT round(auc_score, 6) AS auc_score FROM ({AUC_SQL})")
def roc_auc_q(spark, sf):
    """Exact ROC AUC, ties half."""
    return E.roc_auc(scored(spark, sf))


@register("classification_report", sql=f"""
WITH c AS (SELECT CAST(true_negatives AS DOUBLE) AS tn, CAST(false_positives AS DOUBLE) AS fp,
  CAST(false_negatives AS DOUBLE) AS fn, CAST(true_positives AS DOUBLE) AS tp FROM ({CM_SQL})),
m AS (SELECT *, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1,
  tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n FROM c),
f AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0,
  CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1 FROM m)
SELECT '0' AS class, round(p0, 6) AS "precision", round(r0, 6) AS recall, round(f0, 6) AS f1_score,
  CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round((tn + tp) / n, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6),
  CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
  round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM f""")
def classification_report_q(spark, sf):
    """Per-class precision/recall/f1/support, accuracy, macro and weighted averages."""
    return E.classification_report(scored(spark, sf))


@register("deploy_gate", sql=f"""
WITH b AS ({BM_SQL}), a AS ({AUC_SQL})
SELECT round(a.auc_score, 6) AS auc_score, round(b."precision", 6) AS "precision", round(b.recall, 6) AS recall,
  coalesce(a.auc_score >= 0.75, false) AS auc_check, b."precision" >= 0.2 AS precision_check,
  b.recall >= 0.5 AS recall_check,
  CASE WHEN coalesce(a.auc_score >= 0.75, false) AND b."precision" >= 0.2 AND b.recall >= 0.5
       THEN 'APPROVE' ELSE 'REJECT' END AS decision
FROM a, b""")
def deploy_gate_q(spark, sf):
    """E5: AUC >= 0.75, precision >= 0.2, recall >= 0.5 -> APPROVE / REJECT."""
    s = scored(spark, sf)
    ev = E.business_metrics(E.confusion(s))
    auc = E.roc_auc(s)
    one = F.lit(1)
    j = ev.withColumn("_one", one).join(auc.withColumn("_one", one), "_one")
    return E.deploy_gate(j.select("auc_score", "precision", "recall"))
