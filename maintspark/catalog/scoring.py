"""Queries: scoring (K1-K7, P15-P17, P19). Deterministic score = props.k/99 where SQL
must follow; ``score_readings`` runs a trained forest (rows-only check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import assign as AS
from ..operators import score as SC
from ..sources import adapt as A
from . import r6, register
from .features import _FILL, _ru_cols, _ru_win

TEL = A.SQL_TELEMETRY
RUN_TIME = "2024-02-01 00:00:00"
SENS = S.SENSORS


def _readings(spark, sf):
    return A.telemetry_from_events(A.table(spark, sf, "events")).select("machineID", *SENS)


_K1 = ", ".join(r6(f"{s} * {m}", f"{s}_{w}h_{st}") for w in S.WINDOWS for s in SENS
                for st, m in SC.API_PROFILE.items())


@register("request_features", sql=f"""
WITH t AS ({TEL}) SELECT machineID, {', '.join(r6(s) for s in SENS)}, {_K1} FROM t""")
def request_features_q(spark, sf):
    """Lone-reading features in the model's 36-feature order."""
    return SC.lone_reading_features(_readings(spark, sf))


_K2 = ", ".join(r6(f"{s} * {m}", f"{s}_{w}h_{st}") for w, prof in SC.NOTEBOOK_PROFILE.items() for s in SENS
                for st, m in prof.items())


@register("request_features_baseline", sql=f"""
WITH t AS ({TEL}) SELECT machineID, {', '.join(r6(s) for s in SENS)}, {_K2} FROM t""")
def request_features_baseline_q(spark, sf):
    """K2: the notebook's lone-reading profile."""
    return SC.lone_reading_features_notebook(_readings(spark, sf))


_P = "rotate / 99.0"


@register("risk_bands", sql=f"""
WITH t AS ({TEL}) SELECT machineID, tie, round({_P}, 6) AS failure_probability,
  CAST({_P} > 0.5 AS INTEGER) AS failure_prediction,
  CASE WHEN {_P} < 0.3 THEN 'LOW' WHEN {_P} < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level FROM t""")
def risk_bands_q(spark, sf):
    """Prediction flag and LOW/MEDIUM/HIGH bands."""
    t = A.telemetry_from_events(A.table(spark, sf, "events"))
    return SC.bands(t.select("machineID", "tie", (F.col("rotate") / 99.0).alias("failure_probability")))


@register("risk_bands_strict", sql=f"""
WITH t AS ({TEL}) SELECT machineID, tie, round({_P}, 6) AS failure_probability,
  CAST({_P} > 0.5 AS INTEGER) AS failure_prediction,
  CASE WHEN {_P} > 0.5 THEN 'HIGH' WHEN {_P} > 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM t""")
def risk_bands_strict_q(spark, sf):
    """The notebook's bands (> 0.5 HIGH, > 0.2 MEDIUM)."""
    t = A.telemetry_from_events(A.table(spark, sf, "events"))
    return SC.bands(t.select("machineID", "tie", (F.col("rotate") / 99.0).alias("failure_probability")), strict=True)


def _k_scorer(df):
    return df.select("machineID", (F.col("rotate") / 99.0).alias("failure_probability"))


# Readings from events; an 'error' event whose value exceeds 300 carries no vibration
# reading (a sensor dropout) so the error path is exercised on the driver's data.
def _readings_with_gaps(spark, sf):
    t = A.telemetry_from_events(A.table(spark, sf, "events"), keep=["event_type", "value"])
    gap = (F.col("event_type") == "error") & (F.col("value") > 300)
    return t.select("machineID", "volt", "rotate", "pressure",
                    F.when(gap, F.lit(None).cast("double")).otherwise(F.col("vibration")).alias("vibration"))


_GAPS = f"""SELECT user_id AS machineID, value AS volt, CAST({A.SQL_K} AS DOUBLE) AS rotate,
  value + {A.SQL_K} AS pressure,
  CASE WHEN event_type = 'error' AND value > 300 THEN NULL ELSE abs(value - {A.SQL_K}) END AS vibration
  FROM events"""
_SWE = f"""
WITH r AS ({_GAPS})
SELECT CAST(machineID AS INTEGER) AS machineID, round(rotate / 99.0, 6) AS failure_probability,
  CAST(rotate / 99.0 > 0.5 AS INTEGER) AS failure_prediction,
  CASE WHEN rotate / 99.0 < 0.3 THEN 'LOW' WHEN rotate / 99.0 < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
  TIMESTAMP '{RUN_TIME}' AS prediction_timestamp, CAST(NULL AS VARCHAR) AS error
FROM r WHERE machineID IS NOT NULL AND volt IS NOT NULL AND rotate IS NOT NULL AND pressure IS NOT NULL
  AND vibration IS NOT NULL
UNION ALL
SELECT CAST(coalesce(machineID, -1) AS INTEGER), -1.0, -1, 'ERROR', TIMESTAMP '{RUN_TIME}',
  CASE WHEN machineID IS NULL THEN 'missing machineID' ELSE 'missing sensor values: ' || concat_ws(',',
    CASE WHEN volt IS NULL THEN 'volt' END, CASE WHEN rotate IS NULL THEN 'rotate' END,
    CASE WHEN pressure IS NULL THEN 'pressure' END, CASE WHEN vibration IS NULL THEN 'vibration' END) END
FROM r WHERE machineID IS NULL OR volt IS NULL OR rotate IS NULL OR pressure IS NULL OR vibration IS NULL"""


@register("score_with_errors", sql=_SWE)
def score_with_errors_q(spark, sf):
    """K4: bad rows become ERROR rows; the batch never fails on one row."""
    return SC.score_with_errors(_readings_with_gaps(spark, sf), _k_scorer, RUN_TIME)


@register("score_success_count", sql=f"""
SELECT count(*) FILTER (WHERE risk_level <> 'ERROR') AS successful_predictions, count(*) AS total_requests
FROM ({_SWE})""")
def score_success_count_q(spark, sf):
    """K5: successful predictions after dropping error rows."""
    return SC.success_count(SC.score_with_errors(_readings_with_gaps(spark, sf), _k_scorer, RUN_TIME))


@register("latest_features", sql=f"""
WITH t AS ({TEL}), f AS ({A.SQL_FAILURES}),
r AS (SELECT *, {_ru_cols} FROM t {_ru_win}),
ft AS (SELECT datetime, machineID, {_FILL},
  CAST(EXISTS (SELECT 1 FROM f WHERE f.machineID = r.machineID
       AND r.datetime >= f.datetime - INTERVAL 72 HOUR AND r.datetime < f.datetime) AS INTEGER)
  AS failure_within_window FROM r
  WINDOW g AS (ORDER BY machineID, datetime, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
n AS (SELECT *, row_number() OVER (PARTITION BY machineID ORDER BY datetime DESC) AS rn FROM ft)
SELECT * EXCLUDE (rn) FROM n WHERE rn = 1""")
def latest_features_q(spark, sf):
    """K6: features of the newest reading per machine, from real history."""
    from ..plans.features import latest_features
    ev = A.table(spark, sf, "events")
    return latest_features(A.telemetry_from_events(ev), A.failures_from_events(ev), tie="tie")


SHARES = AS.traffic_split(["v1", "v2"], "v3", 10)
_VALUES = ", ".join(f"('{v}', {lo}, {lo + p})" for v, p, lo in
                    [(v, p, sum(q for _, q in SHARES[:i])) for i, (v, p) in enumerate(SHARES)])


@register("version_assignment", sql=f"""
WITH m AS (SELECT DISTINCT user_id AS machineID FROM events),
b AS (SELECT machineID, CAST(('0x' || substr(md5(CAST(machineID AS VARCHAR)), 1, 8))::BIGINT % 100 AS INTEGER)
  AS bucket FROM m),
s AS (SELECT * FROM (VALUES {_VALUES}) s(version, lo, hi))
SELECT machineID, bucket, version FROM b LEFT JOIN s ON bucket >= lo AND bucket < hi""")
def version_assignment_q(spark, sf):
    """K7: machines to model versions, new version 10 %, the rest split evenly."""
    machines = A.table(spark, sf, "events").select(F.col("user_id").alias("machineID")).distinct()
    return AS.assign_versions(machines, AS.split_table(spark, SHARES), "machineID")


@register("score_readings")
def score_readings_q(spark, sf):
    """K3: a forest trained on the feature table scores every reading (lone-reading
    features); rows-only check."""
    from ..operators import train as TR
    from ..plans.features import feature_table
    from ..plans.sizing import materialize, release_shuffles
    ev = A.table(spark, sf, "events")
    ft = feature_table(A.telemetry_from_events(ev), A.failures_from_events(ev), tie="tie")
    if ev.count() > TR.BINNED_ROWS:
        ft = materialize(ft.select(*S.feature_columns(), S.LABEL))  # the fit reads it several times
        release_shuffles(spark)
    model = TR.fit(ft, S.feature_columns(), preset="production")
    feats = SC.lone_reading_features(_readings(spark, sf))
    return SC.score(model, feats, RUN_TIME)


@register("score_latest")
def score_latest_q(spark, sf):
    """K6 -> K3: each machine's newest feature row (real rolling history, not the
    lone-reading approximation) scored by a forest trained on the temporal train split;
    rows-only check."""
    from ..operators import train as TR
    from ..operators.split import temporal_split
    from ..plans.features import feature_table
    ev = A.table(spark, sf, "events")
    ft = feature_table(A.telemetry_from_events(ev), A.failures_from_events(ev), tie="tie", keep_tie=True)
    ft = ft.checkpoint(eager=True)
    train = temporal_split(ft, tie="tie").filter(F.col("split") == "train")
    model = TR.fit(train, S.feature_columns(), preset="production")
    latest = SC.latest_per_key(ft, tie="tie")
    return SC.score(model, latest, RUN_TIME)
