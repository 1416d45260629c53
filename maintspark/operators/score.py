"""Scoring readings as batch (and stream) projections.

The reference scores one request at a time (a one-row frame per reading). Here a
DataFrame of readings is scored in one projection + ``PipelineModel.transform``:
no shuffle, and the same code runs on a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import decision, risk_band, risk_band_strict
from .fill import align_features
from .rolling import BASELINE_SPEC

# Lone-reading profiles (fixed multipliers of the current value, per statistic).
API_PROFILE = {"mean": 1.0, "std": 0.05, "max": 1.1, "min": 0.9}
NOTEBOOK_PROFILE = {3: {"mean": 1.0, "std": 0.02}, 24: {"mean": 0.98}}


def baseline_feature_columns(sensors: Sequence[str] = S.SENSORS) -> list[str]:
    out = list(sensors)
    for w, stats in BASELINE_SPEC.items():
        for s in sensors:
            out.extend(f"{s}_{w}h_{st}" for st in stats)
    return out


def lone_reading_features(readings: DataFrame, feature_names: Sequence[str] | None = None,
                          sensors: Sequence[str] = S.SENSORS, windows: Sequence[int] = S.WINDOWS,
                          key: str = S.KEY) -> DataFrame:
    """K1 + N4: statistics from the current value only (mean v, std 0.05v, max 1.1v,
    min 0.9v per window), then the model's feature order with missing features 0.0."""
    feats = {}
    for s in sensors:
        for w in windows:
            for st, m in API_PROFILE.items():
                feats[f"{s}_{w}h_{st}"] = F.col(s) * F.lit(m)
    wide = readings.withColumns(feats)
    return align_features(wide, list(feature_names or S.feature_columns(sensors, windows)), keep=[key])


def lone_reading_features_notebook(readings: DataFrame, feature_names: Sequence[str] | None = None,
                                   sensors: Sequence[str] = S.SENSORS, key: str = S.KEY) -> DataFrame:
    """K2: the notebook profile (3h mean v, 3h std 0.02v, 24h mean 0.98v) + N4."""
    feats = {}
    for s in sensors:
        for w, prof in NOTEBOOK_PROFILE.items():
            for st, m in prof.items():
                feats[f"{s}_{w}h_{st}"] = F.col(s) * F.lit(m)
    wide = readings.withColumns(feats)
    return align_features(wide, list(feature_names or baseline_feature_columns(sensors)), keep=[key])


def bands(df: DataFrame, p: str = "failure_probability", strict: bool = False) -> DataFrame:
    """P16/P19 (or P17 with ``strict``): prediction flag and risk level from a probability."""
    band = risk_band_strict(p) if strict else risk_band(p)
    return df.withColumns({"failure_prediction": decision(p), "risk_level": band})


def positive_probability(model_output: DataFrame, probability: str = "probability") -> Column:
    """Probability of class 1 from MLlib's probability vector."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(probability))[1]


def score(model, features: DataFrame, at, key: str = S.KEY) -> DataFrame:
    """K3: ``model`` is a fitted ``PipelineModel`` whose first stage assembles the feature
    vector; ``at`` the run time written to ``prediction_timestamp`` (a parameter)."""
    out = model.transform(features)
    p = positive_probability(out)
    return (out.select(F.col(key).cast("int").alias(key), p.alias("failure_probability"))
               .transform(bands)
               .withColumn("prediction_timestamp", F.lit(at).cast("timestamp_ntz")))


def bad_reading(sensors: Sequence[str] = S.SENSORS, key: str = S.KEY) -> Column:
    """A reading the lone-reading path cannot score: missing id or any missing/NaN sensor."""
    cond = F.col(key).isNull()
    for s in sensors:
        cond = cond | F.col(s).isNull() | F.isnan(F.col(s))
    return cond


def score_with_errors(readings: DataFrame, scorer: Callable[[DataFrame], DataFrame], at,
                      sensors: Sequence[str] = S.SENSORS, key: str = S.KEY) -> DataFrame:
    """K4: good rows are scored by ``scorer`` (-> key, failure_probability); bad rows become
    error rows (id or -1, probability -1.0, prediction -1, risk ERROR, message). One batch
    never fails because of one row; no try/except per row."""
    bad = bad_reading(sensors, key)
    good = readings.filter(~bad)
    scored = (scorer(good).transform(bands)
              .select(F.col(key).cast("int").alias(key), "failure_probability", "failure_prediction", "risk_level",
                      F.lit(at).cast("timestamp_ntz").alias("prediction_timestamp"),
                      F.lit(None).cast("string").alias("error")))
    missing = [F.when(F.col(s).isNull() | F.isnan(F.col(s)), F.lit(s)) for s in sensors]
    msg = F.when(F.col(key).isNull(), F.lit("missing machineID")).otherwise(
        F.concat(F.lit("missing sensor values: "), F.concat_ws(",", *missing)))
    errors = readings.filter(bad).select(
        F.coalesce(F.col(key).cast("int"), F.lit(-1)).alias(key), F.lit(-1.0).alias("failure_probability"),
        F.lit(-1).alias("failure_prediction"), F.lit("ERROR").alias("risk_level"),
        F.lit(at).cast("timestamp_ntz").alias("prediction_timestamp"), msg.alias("error"))
    return scored.unionByName(errors)


def success_count(predictions: DataFrame) -> DataFrame:
    """K5: rows without error, and the total."""
    return predictions.agg(F.count_if(F.col("risk_level") != "ERROR").alias("successful_predictions"),
                           F.count(F.lit(1)).alias("total_requests"))


def latest_per_key(df: DataFrame, key: str = S.KEY, time: str = S.TIME, tie=None) -> DataFrame:
    """K6: the newest row of every machine (row_number = 1; WindowGroupLimit keeps one row
    per key before the window runs)."""
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_first() for c in [time, *ties]])  # the rolling windows' order, reversed
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
