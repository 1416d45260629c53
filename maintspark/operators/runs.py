"""The model-run table as set-based queries.

The reference keeps runs in a dict and decides for one model family. Here the
runs are a DataFrame (T7) with an optional group column, so one job decides
for every family: "active", "best candidate", "compare", "promote" are
per-group window/aggregate/join steps. Comparison is active vs best candidate
per group (an equi-join on the group), never all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import quality_band

GROUP = "model_group"

# Recommendation texts and thresholds (fixed values of the reference's decision rule).
RECOMMENDATIONS = [
    ("auc", 0.01, "DEPLOY - Significant AUC improvement"),
    ("auc_prec", (0.005, 0.02), "DEPLOY - Good AUC and precision improvement"),
    ("auc_drop", -0.01, "REJECT - AUC degradation too high"),
    ("prec_drop", -0.05, "REJECT - Precision degradation too high"),
    ("else", None, "HOLD - Marginal improvement, consider more data"),
]


def _group(df: DataFrame, group: str | None) -> list[str]:
    return [group] if group and group in df.columns else []


def _join(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on the group keys; without a group, on a constant key (both sides are
    one row per group, so this is never a cartesian product of large inputs)."""
    if on:
        # null-safe: runs without a group are a group of their own
        named = b.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in b.columns])
        cond = F.lit(True)
        for c in on:
            cond = cond & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
        keys = [f"_on_{c}" for c in on]
        j = a.join(named, cond, how)
        if how in ("left_semi", "left_anti"):
            return j
        rest = [c for c in j.columns if c not in on and c not in keys]
        pick = [F.coalesce(F.col(c), F.col(f"_on_{c}")).alias(c) if how == "full_outer" else F.col(c) for c in on]
        return j.select(*pick, *rest)
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one", how).drop("_one")


def active_runs(runs: DataFrame, group: str | None = GROUP) -> DataFrame:
    """R2: the latest active run per group (ties on date: smallest version)."""
    g = _group(runs, group)
    w = Window.partitionBy(*g).orderBy(F.col("training_date").desc(), F.col("version"))
    return (runs.filter(F.col("status") == "active").withColumn("_rn", F.row_number().over(w))
                .filter("_rn = 1").drop("_rn"))


def best_candidates(runs: DataFrame, group: str | None = GROUP) -> DataFrame:
    """The candidate with the highest AUC per group (ties: first registered,
    i.e. earliest training date, then version)."""
    g = _group(runs, group)
    w = Window.partitionBy(*g).orderBy(F.col("auc_score").desc(), F.col("training_date"), F.col("version"))
    return (runs.filter(F.col("status") == "candidate").withColumn("_rn", F.row_number().over(w))
                .filter("_rn = 1").drop("_rn"))


def recommendation(d_auc: Column, d_prec: Column) -> Column:
    """First matching rule."""
    return (F.when(d_auc > 0.01, RECOMMENDATIONS[0][2])
             .when((d_auc > 0.005) & (d_prec > 0.02), RECOMMENDATIONS[1][2])
             .when(d_auc < -0.01, RECOMMENDATIONS[2][2])
             .when(d_prec < -0.05, RECOMMENDATIONS[3][2])
             .otherwise(RECOMMENDATIONS[4][2]))


def compare(base: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Model 1 = ``base`` row, model 2 = ``other`` row, matched on ``on``."""
    a = base.select(*on, *[F.col(c).alias(f"{c}_1") for c in ("version", "auc_score", "precision", "recall")])
    b = other.select(*on, *[F.col(c).alias(f"{c}_2") for c in ("version", "auc_score", "precision", "recall")])
    j = _join(a, b, list(on))
    d_auc = F.col("auc_score_2") - F.col("auc_score_1")
    d_prec = F.col("precision_2") - F.col("precision_1")
    d_rec = F.col("recall_2") - F.col("recall_1")
    improvement = F.when(F.col("auc_score_1") > 0, d_auc / F.col("auc_score_1") * 100.0).otherwise(F.lit(0.0))
    return j.select(*on, F.col("version_1").alias("version1"), F.col("version_2").alias("version2"),
                    "auc_score_1", "auc_score_2", d_auc.alias("auc_difference"), improvement.alias("auc_improvement_pct"),
                    "precision_1", "precision_2", d_prec.alias("precision_difference"),
                    "recall_1", "recall_2", d_rec.alias("recall_difference"),
                    recommendation(d_auc, d_prec).alias("recommendation"))


def compare_active_vs_best(runs: DataFrame, group: str | None = GROUP) -> DataFrame:
    """Per group: active run (model 1) vs best candidate (model 2)."""
    g = _group(runs, group)
    return compare(active_runs(runs, group), best_candidates(runs, group), g)


def promote(runs: DataFrame, chosen: DataFrame, at: str, group: str | None = GROUP) -> DataFrame:
    """New snapshot -- per group of a chosen version: the latest active run becomes
    'retired', the chosen one 'active' with ``deployment_date = at``. A chosen
    version that is not in the table changes nothing (also nothing is retired); two chosen
    versions of one group raise ``ValueError``. Runs without a group are one group."""
    g = _group(runs, group)
    known = _join(chosen.select(*g, F.col("version").alias("_chosen")).distinct(),
                  runs.select(*g, F.col("version").alias("_chosen")), g + ["_chosen"], "left_semi")
    # one version a group can be active: more choices are refused (one row a group, few rows)
    if not known.groupBy(*g).count().filter("count > 1").isEmpty():
        raise ValueError("more than one version chosen for a group")
    retire = _join(active_runs(runs, group), known.select(*g).distinct() if g else known.limit(1).select(),
                   g, "left_semi").select(*g, F.col("version").alias("_retire"))
    marks = _join(known, retire, g, "full_outer")
    cols = runs.columns
    tagged = _join(runs, marks, g, "left")
    is_new = F.col("version") == F.col("_chosen")
    is_old = (F.col("version") == F.col("_retire")) & ~F.coalesce(is_new, F.lit(False))
    out = tagged.select(*[
        F.when(F.coalesce(is_new, F.lit(False)), F.lit("active"))
         .when(F.coalesce(is_old, F.lit(False)), F.lit("retired")).otherwise(F.col("status")).alias("status")
        if c == "status" else
        F.when(F.coalesce(is_new, F.lit(False)), F.lit(at)).otherwise(F.col("deployment_date")).alias(c)
        if c == "deployment_date" else F.col(c) for c in cols])
    return out


def auto_decisions(runs: DataFrame, min_auc: float = S.PROMOTE_MIN_AUC,
                   min_improvement: float = S.PROMOTE_MIN_IMPROVEMENT, group: str | None = GROUP) -> DataFrame:
    """Per group -- best candidate, active run, improvement, promote flag and reason."""
    g = _group(runs, group)
    best = best_candidates(runs, group).select(*g, F.col("version").alias("candidate_version"),
                                               F.col("auc_score").alias("candidate_auc"))
    act = active_runs(runs, group).select(*g, F.col("version").alias("active_version"),
                                          F.col("auc_score").alias("active_auc"))
    j = _join(best, act, g, "left")
    imp = F.col("candidate_auc") - F.col("active_auc")
    promote_flag = (F.col("candidate_auc") >= min_auc) & (F.col("active_auc").isNull() | (imp >= min_improvement))
    reason = (F.when(F.col("candidate_auc") < min_auc, "below AUC threshold")
               .when(F.col("active_auc").isNotNull() & (imp < min_improvement), "improvement below threshold")
               .otherwise("promoted"))
    return j.select(*g, "candidate_version", "candidate_auc", "active_version", "active_auc",
                    imp.alias("improvement"), promote_flag.alias("promote"), reason.alias("reason"))


def auto_promote(runs: DataFrame, at: str, group: str | None = GROUP, **kw) -> DataFrame:
    """R7 -> R6: the snapshot after promoting every group's qualifying candidate."""
    g = _group(runs, group)
    d = auto_decisions(runs, group=group, **kw).filter("promote").select(*g, F.col("candidate_version").alias("version"))
    return promote(runs, d, at, group)


def summary(runs: DataFrame, group: str | None = GROUP) -> DataFrame:
    """Counts by status, best AUC and its version, latest training, per group."""
    g = _group(runs, group)
    return runs.groupBy(*g).agg(
        F.count(F.lit(1)).alias("total_models"),
        F.count_if(F.col("status") == "active").alias("active_models"),
        F.count_if(F.col("status") == "candidate").alias("candidate_models"),
        F.count_if(F.col("status") == "retired").alias("retired_models"),
        F.max("auc_score").alias("best_auc"),
        F.min_by("version", F.struct(-F.col("auc_score"), F.col("training_date"), F.col("version")))
        .alias("best_model_version"),
        F.max("training_date").alias("latest_training"))


def listing(runs: DataFrame) -> DataFrame:
    """Chosen columns, date only, newest first."""
    return (runs.select("version", "algorithm", "auc_score", "precision", "recall", "status",
                        F.substring("training_date", 1, 10).alias("training_date"), "notes",
                        F.col("training_date").alias("_ts"))
                .orderBy(F.col("_ts").desc(), "version").drop("_ts"))


def assessment(runs: DataFrame) -> DataFrame:
    """Quality band of every run's AUC."""
    return runs.select("version", "auc_score", quality_band("auc_score").alias("assessment"))


def register_run(runs: DataFrame, evaluation: DataFrame, version: str, training_date: str,
                 algorithm: str = "RandomForestClassifier", training_samples: int = 0,
                 feature_count: int = 36, file_path: str = "", notes: str = "", extra: dict | None = None) -> DataFrame:
    """A 'candidate' row from an evaluation (T6); absent metrics default to 0.0;
    an existing row with the same version is replaced."""
    e = evaluation.select(
        F.lit(version).alias("version"),
        F.coalesce(F.col("model_name"), F.lit("Unknown")).alias("model_name"),
        F.lit(algorithm).alias("algorithm"),
        F.coalesce(F.col("auc_score"), F.lit(0.0)).alias("auc_score"),
        F.coalesce(F.col("business_metrics.precision"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.col("business_metrics.recall"), F.lit(0.0)).alias("recall"),
        F.lit(training_date).alias("training_date"), F.lit(int(training_samples)).alias("training_samples"),
        F.lit(int(feature_count)).alias("feature_count"), F.lit(file_path).alias("file_path"),
        F.lit("candidate").alias("status"), F.lit(None).cast("string").alias("deployment_date"),
        F.lit(notes).alias("notes"), *[F.lit(v).alias(k) for k, v in (extra or {}).items()])
    e = e.select(*[F.col(c) if c in e.columns else F.lit(None).cast(runs.schema[c].dataType).alias(c)
                   for c in runs.columns])
    # by the literal version: the evaluation isn't computed a second time to look it up
    return runs.filter(~F.col("version").eqNullSafe(F.lit(version))).unionByName(e)
