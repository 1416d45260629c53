"""Table schemas (T1..T8) and the default parameters of the maintenance model."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values shared with the reference application: sensor names, windows,
# statistics, label horizon, split share, risk thresholds and deploy gate.
SENSORS = ["volt", "rotate", "pressure", "vibration"]
WINDOWS = [3, 24]
STATS = ["mean", "std", "max", "min"]
PREDICTION_WINDOW_DAYS = 3
TEST_SIZE = 0.2
RANDOM_STATE = 42
FAILURE_TYPES = ["comp1", "comp2", "comp3", "comp4"]
RISK_THRESHOLDS = (0.3, 0.7)          # < 0.3 LOW, < 0.7 MEDIUM, else HIGH
STRICT_RISK_THRESHOLDS = (0.2, 0.5)   # notebook: > 0.5 HIGH, > 0.2 MEDIUM, else LOW
DECISION_THRESHOLD = 0.5
GATE_MIN_AUC = 0.75
GATE_MIN_PRECISION = 0.20
GATE_MIN_RECALL = 0.50
PROMOTE_MIN_AUC = 0.75
PROMOTE_MIN_IMPROVEMENT = 0.005
DRIFT_THRESHOLD = 0.3
PREDICTION_DRIFT_THRESHOLD = 0.2
VOLUME_MIN_PER_HOUR = 10
ERROR_RATE_THRESHOLD = 0.05
SAMPLE_PERCENT = 10

KEY = "machineID"
TIME = "datetime"
LABEL = "failure_within_window"
EXCLUDE_FROM_FEATURES = [TIME, KEY, LABEL]


def feature_columns(sensors=SENSORS, windows=WINDOWS, stats=STATS) -> list[str]:
    """Model feature order: raw sensors, then per window, per sensor, each statistic."""
    out = list(sensors)
    for w in windows:
        for s in sensors:
            out.extend(f"{s}_{w}h_{st}" for st in stats)
    return out


TELEMETRY = T.StructType([
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("machineID", T.LongType()),
    T.StructField("volt", T.DoubleType()),
    T.StructField("rotate", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()),
])

FAILURES = T.StructType([
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("machineID", T.LongType()),
    T.StructField("failure", T.StringType()),
])

READING = T.StructType([
    T.StructField("machineID", T.IntegerType()),
    T.StructField("volt", T.DoubleType()),
    T.StructField("rotate", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()),
])

PREDICTION = T.StructType([
    T.StructField("machineID", T.IntegerType()),
    T.StructField("failure_probability", T.DoubleType()),
    T.StructField("failure_prediction", T.IntegerType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("prediction_timestamp", T.TimestampNTZType()),
    T.StructField("error", T.StringType()),
])

CONFUSION = T.StructType([
    T.StructField("true_negatives", T.LongType()),
    T.StructField("false_positives", T.LongType()),
    T.StructField("false_negatives", T.LongType()),
    T.StructField("true_positives", T.LongType()),
])

BUSINESS = T.StructType([
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("false_alarm_rate", T.DoubleType()),
    T.StructField("miss_rate", T.DoubleType()),
])

EVALUATION = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("auc_score", T.DoubleType()),
    T.StructField("confusion_matrix", CONFUSION),
    T.StructField("business_metrics", BUSINESS),
])

MODEL_RUN = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("algorithm", T.StringType()),
    T.StructField("auc_score", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("training_date", T.StringType()),
    T.StructField("training_samples", T.IntegerType()),
    T.StructField("feature_count", T.IntegerType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("deployment_date", T.StringType()),
    T.StructField("notes", T.StringType()),
])

PREDICTION_LOG = T.StructType([
    T.StructField("machineID", T.LongType()),
    T.StructField("failure_probability", T.DoubleType()),
    T.StructField("failure_prediction", T.IntegerType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("prediction_timestamp", T.TimestampNTZType()),
    T.StructField("method", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
])
