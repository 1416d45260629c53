"""Driver tables -> the maintenance shapes (telemetry, failures, prediction log, model runs).

The reference's CSVs are not available, so the driver's ``events``, ``lineitem``
and ``part`` tables stand in. Each mapping is a pure projection/filter, so the
parquet scan keeps its column pruning and pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def telemetry_from_events(events: DataFrame, with_tie: bool = True, keep=()) -> DataFrame:
    """T1 from ``events``: one machine per user, sensors derived from value and props.k.
    ``keep``: event columns carried along unchanged."""
    k = _k()
    cols = [
        F.col("ts").alias("datetime"),
        F.col("user_id").alias("machineID"),
        F.col("value").alias("volt"),
        k.cast("double").alias("rotate"),
        (F.col("value") + k).alias("pressure"),
        F.abs(F.col("value") - k).alias("vibration"),
    ]
    if with_tie:
        cols.append(F.col("event_id").alias("tie"))
    return events.select(*cols, *[F.col(c) for c in keep])


def failures_from_events(events: DataFrame) -> DataFrame:
    """T2 from ``events``: errors with a large value are failures of component k%4+1."""
    return (events
            .filter((F.col("event_type") == "error") & (F.col("value") > 100))
            .select(F.col("ts").alias("datetime"),
                    F.col("user_id").alias("machineID"),
                    F.concat(F.lit("comp"), (F.pmod(_k(), F.lit(4)) + 1).cast("string")).alias("failure")))


def telemetry_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Second stand-in with many equal timestamps per machine; tie = (orderkey, linenumber).

    Sensor values keep at most two decimals and small magnitudes, so 6-decimal
    comparisons with another engine have no rounding ties."""
    return lineitem.select(
        F.col("l_shipdate").alias("datetime"),
        F.col("l_suppkey").alias("machineID"),
        F.col("l_quantity").alias("volt"),
        F.pmod(F.floor("l_extendedprice"), F.lit(1000)).cast("double").alias("rotate"),
        (F.col("l_discount") * 100.0).alias("pressure"),
        (F.col("l_tax") * 100.0).alias("vibration"),
        F.col("l_orderkey").alias("tie"),
        F.col("l_linenumber").alias("tie2"),
    )


def skewed_telemetry_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The lineitem telemetry with one hot machine: the rows of every third supplier
    (about a third of all rows) belong to machine 0. All rows are kept; the original
    supplier becomes a third tie column so the hot machine's row order stays total."""
    t = telemetry_from_lineitem(lineitem).withColumn("tie3", F.col("machineID"))
    return t.withColumn("machineID", F.when(F.pmod(F.col("machineID"), F.lit(3)) == 0, F.lit(0).cast("long"))
                        .otherwise(F.col("machineID")))


def prediction_log_from_events(events: DataFrame) -> DataFrame:
    """T8 from ``events``: probability k/99, error status on error events, latency value/1000."""
    p = _k().cast("double") / 99.0
    return events.select(
        F.col("user_id").alias("machineID"),
        p.alias("failure_probability"),
        (p > S.DECISION_THRESHOLD).cast("int").alias("failure_prediction"),
        F.when(p < S.RISK_THRESHOLDS[0], "LOW").when(p < S.RISK_THRESHOLDS[1], "MEDIUM")
         .otherwise("HIGH").alias("risk_level"),
        F.col("ts").alias("prediction_timestamp"),
        F.lit("POST").alias("method"),
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        (F.col("value") / 1000.0).alias("duration_seconds"),
        F.col("event_id").alias("request_id"),
    )


STATUS_BY_MOD3 = ["active", "candidate", "retired"]


def model_runs_from_part(part: DataFrame) -> DataFrame:
    """T7 from ``part``: one synthetic model run per part, grouped by brand."""
    key = F.col("p_partkey")
    status = (F.when(F.pmod(key, F.lit(3)) == 0, STATUS_BY_MOD3[0])
               .when(F.pmod(key, F.lit(3)) == 1, STATUS_BY_MOD3[1])
               .otherwise(STATUS_BY_MOD3[2]))
    trained = F.timestamp_add("MINUTE", key, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return part.select(
        F.concat(F.lit("v"), key.cast("string")).alias("version"),
        F.col("p_brand").alias("model_group"),
        F.concat(F.lit("rf_"), F.lower(F.col("p_type"))).alias("model_name"),
        F.lit("RandomForestClassifier").alias("algorithm"),
        (F.lit(0.5) + F.pmod(key, F.lit(500)).cast("double") / 1000.0).alias("auc_score"),
        (F.pmod(F.col("p_size"), F.lit(50)).cast("double") / 100.0).alias("precision"),
        (F.pmod(key, F.lit(97)).cast("double") / 100.0).alias("recall"),
        F.date_format(trained, "yyyy-MM-dd'T'HH:mm:ss").alias("training_date"),
        F.col("p_size").alias("training_samples"),
        F.lit(len(S.feature_columns())).alias("feature_count"),
        F.concat(F.lit("models/"), key.cast("string")).alias("file_path"),
        status.alias("status"),
        F.lit(None).cast("string").alias("deployment_date"),
        F.col("p_name").alias("notes"),
    )


def load(spark: SparkSession, sf_dir: str):
    """(telemetry, failures) from the events stand-in."""
    ev = table(spark, sf_dir, "events")
    return telemetry_from_events(ev), failures_from_events(ev)


# DuckDB spellings of the same mappings, used by the oracle SQL.
SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
SQL_TELEMETRY = f"""SELECT ts AS datetime, user_id AS machineID, value AS volt,
  CAST({SQL_K} AS DOUBLE) AS rotate, value + {SQL_K} AS pressure,
  abs(value - {SQL_K}) AS vibration, event_id AS tie FROM events"""
SQL_FAILURES = f"""SELECT ts AS datetime, user_id AS machineID,
  'comp' || CAST(({SQL_K} % 4) + 1 AS VARCHAR) AS failure
  FROM events WHERE event_type = 'error' AND value > 100"""
SQL_LINEITEM_TELEMETRY = """SELECT l_shipdate AS datetime, l_suppkey AS machineID, l_quantity AS volt,
  CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS DOUBLE) AS rotate, l_discount * 100.0 AS pressure, l_tax * 100.0 AS vibration,
  l_orderkey AS tie, l_linenumber AS tie2 FROM lineitem"""
SQL_SKEWED_TELEMETRY = f"""SELECT datetime, CASE WHEN machineID % 3 = 0 THEN CAST(0 AS BIGINT) ELSE machineID END
  AS machineID, volt, rotate, pressure, vibration, tie, tie2, machineID AS tie3 FROM ({SQL_LINEITEM_TELEMETRY})"""
SQL_PRED_LOG = f"""SELECT user_id AS machineID, CAST({SQL_K} AS DOUBLE) / 99.0 AS failure_probability,
  CAST(CAST({SQL_K} AS DOUBLE) / 99.0 > 0.5 AS INTEGER) AS failure_prediction,
  CASE WHEN CAST({SQL_K} AS DOUBLE) / 99.0 < 0.3 THEN 'LOW'
       WHEN CAST({SQL_K} AS DOUBLE) / 99.0 < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
  ts AS prediction_timestamp, 'POST' AS method, event_type AS endpoint,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
  value / 1000.0 AS duration_seconds, event_id AS request_id FROM events"""
SQL_MODEL_RUNS = """SELECT 'v' || CAST(p_partkey AS VARCHAR) AS version, p_brand AS model_group,
  'rf_' || lower(p_type) AS model_name, 'RandomForestClassifier' AS algorithm,
  0.5 + CAST(p_partkey % 500 AS DOUBLE) / 1000.0 AS auc_score,
  CAST(p_size % 50 AS DOUBLE) / 100.0 AS "precision",
  CAST(p_partkey % 97 AS DOUBLE) / 100.0 AS recall,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey), '%Y-%m-%dT%H:%M:%S') AS training_date,
  p_size AS training_samples, 36 AS feature_count,
  'models/' || CAST(p_partkey AS VARCHAR) AS file_path,
  CASE p_partkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'candidate' ELSE 'retired' END AS status,
  CAST(NULL AS VARCHAR) AS deployment_date, p_name AS notes FROM part"""
