"""Queries: the model-run table (R1-R9, J5, W7, P14, P18) over runs derived from ``part``."""

from __future__ import annotations

from ..operators import evaluate as E
from ..operators import runs as R
from ..sources import adapt as A
from . import register
from .evaluation import AUC_SQL, BM_SQL, scored

RUNS = A.SQL_MODEL_RUNS
AT = "2024-06-01T00:00:00"
COLS = ("version, model_group, model_name, algorithm, round(auc_score, 6) AS auc_score, "
        "round(\"precision\", 6) AS \"precision\", round(recall, 6) AS recall, training_date, training_samples, "
        "feature_count, file_path, status, deployment_date, notes")
ACTIVE = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_group ORDER BY training_date DESC, version)
  AS rn FROM r WHERE status = 'active') WHERE rn = 1"""
BEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_group
  ORDER BY auc_score DESC, training_date, version) AS rn FROM r WHERE status = 'candidate') WHERE rn = 1"""


def _runs(spark, sf):
    return A.model_runs_from_part(A.table(spark, sf, "part"))


@register("active_run", sql=f"WITH r AS ({RUNS}) SELECT {COLS} FROM ({ACTIVE})")
def active_run_q(spark, sf):
    """R2: latest active run per model group."""
    return R.active_runs(_runs(spark, sf))


@register("best_run", sql=f"WITH r AS ({RUNS}) SELECT {COLS} FROM ({BEST})")
def best_run_q(spark, sf):
    """Best candidate by AUC per group."""
    return R.best_candidates(_runs(spark, sf))


@register("run_compare", sql=f"""
WITH r AS ({RUNS}), a AS ({ACTIVE}), b AS ({BEST})
SELECT a.model_group, a.version AS version1, b.version AS version2,
  round(a.auc_score, 6) AS auc_score_1, round(b.auc_score, 6) AS auc_score_2,
  round(b.auc_score - a.auc_score, 6) AS auc_difference,
  round(CASE WHEN a.auc_score > 0 THEN (b.auc_score - a.auc_score) / a.auc_score * 100.0 ELSE 0.0 END, 6)
    AS auc_improvement_pct,
  round(a."precision", 6) AS precision_1, round(b."precision", 6) AS precision_2,
  round(b."precision" - a."precision", 6) AS precision_difference,
  round(a.recall, 6) AS recall_1, round(b.recall, 6) AS recall_2, round(b.recall - a.recall, 6) AS recall_difference,
  CASE WHEN b.auc_score - a.auc_score > 0.01 THEN 'DEPLOY - Significant AUC improvement'
       WHEN b.auc_score - a.auc_score > 0.005 AND b."precision" - a."precision" > 0.02
         THEN 'DEPLOY - Good AUC and precision improvement'
       WHEN b.auc_score - a.auc_score < -0.01 THEN 'REJECT - AUC degradation too high'
       WHEN b."precision" - a."precision" < -0.05 THEN 'REJECT - Precision degradation too high'
       ELSE 'HOLD - Marginal improvement, consider more data' END AS recommendation
FROM a JOIN b USING (model_group)""")
def run_compare_q(spark, sf):
    """Active vs best candidate per group, differences and recommendation."""
    return R.compare_active_vs_best(_runs(spark, sf))


_PROMOTE = f"""
c AS (SELECT model_group, version AS chosen FROM ({{chosen}})),
a AS (SELECT model_group, version AS retire FROM ({ACTIVE}) WHERE model_group IN (SELECT model_group FROM c)),
s AS (SELECT r.*, CASE WHEN r.version = c.chosen THEN 'active' WHEN r.version = a.retire THEN 'retired'
        ELSE r.status END AS new_status,
      CASE WHEN r.version = c.chosen THEN '{AT}' ELSE r.deployment_date END AS new_date
      FROM r LEFT JOIN c USING (model_group) LEFT JOIN a USING (model_group))
SELECT version, model_group, model_name, algorithm, round(auc_score, 6) AS auc_score,
  round("precision", 6) AS "precision", round(recall, 6) AS recall, training_date, training_samples,
  feature_count, file_path, new_status AS status, new_date AS deployment_date, notes FROM s"""


@register("run_promote", sql=f"WITH r AS ({RUNS}), " + _PROMOTE.format(chosen=BEST))
def run_promote_q(spark, sf):
    """Promote each group's best candidate; the group's latest active run retires."""
    runs = _runs(spark, sf)
    return R.promote(runs, R.best_candidates(runs).select("model_group", "version"), AT)


_DECIDE = f"""
bc AS (SELECT model_group, version AS candidate_version, auc_score AS candidate_auc FROM ({BEST})),
ac AS (SELECT model_group, version AS active_version, auc_score AS active_auc FROM ({ACTIVE})),
d AS (SELECT bc.*, ac.active_version, ac.active_auc, candidate_auc - active_auc AS improvement,
  candidate_auc >= 0.75 AND (active_auc IS NULL OR candidate_auc - active_auc >= 0.005) AS promote,
  CASE WHEN candidate_auc < 0.75 THEN 'below AUC threshold'
       WHEN active_auc IS NOT NULL AND candidate_auc - active_auc < 0.005 THEN 'improvement below threshold'
       ELSE 'promoted' END AS reason
  FROM bc LEFT JOIN ac USING (model_group))"""


@register("run_auto_promote", sql=f"""
WITH r AS ({RUNS}), {_DECIDE}
SELECT model_group, candidate_version, round(candidate_auc, 6) AS candidate_auc, active_version,
  round(active_auc, 6) AS active_auc, round(improvement, 6) AS improvement, promote, reason FROM d""")
def run_auto_promote_q(spark, sf):
    """Per group, promote the best candidate if AUC >= 0.75 and it beats the active run by 0.005."""
    return R.auto_decisions(_runs(spark, sf))


@register("run_auto_promote_snapshot", sql=f"""
WITH r AS ({RUNS}), {_DECIDE}, """ + _PROMOTE.format(
    chosen="SELECT model_group, candidate_version AS version FROM d WHERE promote").lstrip())
def run_auto_promote_snapshot_q(spark, sf):
    """R7 -> R6: the run table after automatic promotion."""
    return R.auto_promote(_runs(spark, sf), AT)


@register("run_summary", sql=f"""
WITH r AS ({RUNS})
SELECT model_group, count(*) AS total_models, count(*) FILTER (WHERE status = 'active') AS active_models,
  count(*) FILTER (WHERE status = 'candidate') AS candidate_models,
  count(*) FILTER (WHERE status = 'retired') AS retired_models, round(max(auc_score), 6) AS best_auc,
  arg_min(version, (-auc_score, training_date, version)) AS best_model_version,
  max(training_date) AS latest_training FROM r GROUP BY model_group""")
def run_summary_q(spark, sf):
    """Registry summary per group."""
    return R.summary(_runs(spark, sf))


@register("run_list", sql=f"""
WITH r AS ({RUNS})
SELECT version, algorithm, round(auc_score, 6) AS auc_score, round("precision", 6) AS "precision",
  round(recall, 6) AS recall, status, substr(training_date, 1, 10) AS training_date, notes FROM r""")
def run_list_q(spark, sf):
    """Runs newest first, date only."""
    return R.listing(_runs(spark, sf))


@register("run_assessment", sql=f"""
WITH r AS ({RUNS})
SELECT version, round(auc_score, 6) AS auc_score, CASE WHEN auc_score >= 0.85 THEN 'EXCELLENT'
  WHEN auc_score >= 0.75 THEN 'GOOD' ELSE 'NEEDS_IMPROVEMENT' END AS assessment FROM r""")
def run_assessment_q(spark, sf):
    """Model quality band per run."""
    return R.assessment(_runs(spark, sf))


@register("run_register", sql=f"""
WITH r AS ({RUNS}), b AS ({BM_SQL}), a AS ({AUC_SQL})
SELECT {COLS} FROM r
UNION ALL
SELECT 'v_eval', 'Brand#1', 'Random Forest', 'RandomForestClassifier', round(coalesce(a.auc_score, 0.0), 6),
  round(b."precision", 6), round(b.recall, 6), '2024-02-01T00:00:00', 0, 36, 'models/v_eval', 'candidate',
  CAST(NULL AS VARCHAR), 'registered from evaluation' FROM a, b""")
def run_register_q(spark, sf):
    """A new candidate row from an evaluation record (the scored events' evaluation)."""
    ev = E.evaluation_record(scored(spark, sf), label="failure_within_window")
    return R.register_run(_runs(spark, sf), ev, "v_eval", "2024-02-01T00:00:00", file_path="models/v_eval",
                          notes="registered from evaluation", extra={"model_group": "Brand#1"})
