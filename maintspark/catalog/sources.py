"""Queries: sources written from the driver's tables and read back (S1-S3, S5, S6, S8, S13), and
operators over readings with gaps (N1, N2, N4, A5, A15, P3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import profile as P
from ..operators import select as SEL
from ..operators.fill import align_features
from ..operators.rolling import rolling_features
from ..plans.features import filled_features
from ..session import scratch_folder
from ..sources import adapt as A
from ..sources import io as IO
from . import r6, register
from .features import _FILL, RAW, _fail, _r_cols, _r_win, _ru_cols, _ru_win, _tel
from .profile import _DESC, _NULLS, UNPIV

TEL, FAIL = A.SQL_TELEMETRY, A.SQL_FAILURES
SENS = S.SENSORS


# ------------------------------------------------------------------ S1, S3: telemetry CSV
def _telemetry_csv(spark, sf):
    """CSV files with texts for a volt, missing rotates, and times of three spellings."""
    t = _tel(spark, sf)
    tie = lambda n: F.pmod(F.col("tie"), F.lit(n))
    volt = F.when(tie(50) == 7, "no reading").otherwise(F.col("volt").cast("string"))
    rotate = F.when(tie(20) == 3, "NA").when(tie(20) == 4, " ").otherwise(F.col("rotate").cast("string"))
    time = F.when(tie(6) == 0, F.date_format("datetime", "yyyy-MM-dd")).when(tie(6) == 1, F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    folder = f"{scratch_folder(spark, 'telemetry-csv')}/telemetry.csv"
    IO.write_csv(t.withColumns({"volt": volt, "rotate": rotate, "datetime": time}).drop("tie"), folder)
    return IO.read_telemetry_csv(spark, folder)


@register("source_telemetry_csv", sql=f"""
WITH t AS ({TEL}) SELECT CASE tie % 6 WHEN 0 THEN date_trunc('day', datetime) WHEN 1 THEN date_trunc('second', datetime) ELSE datetime END AS datetime,
  machineID, round(volt, 6) AS volt, CASE WHEN tie % 20 NOT IN (3, 4) THEN round(rotate, 6) END AS rotate, {r6('pressure')}, {r6('vibration')}
FROM t WHERE tie % 50 <> 7""")
def source_telemetry_csv_q(spark, sf):
    """Telemetry CSV with missing cells and several time formats; the rows that convert."""
    return _telemetry_csv(spark, sf)[0]


@register("source_telemetry_csv_bad", sql=f"""
WITH t AS ({TEL}) SELECT machineID, 'no reading' AS volt, count(*) AS bad_rows FROM t WHERE tie % 50 = 7 GROUP BY machineID""")
def source_telemetry_csv_bad_q(spark, sf):
    """The rows that do not convert, kept apart as they came; counted per machine."""
    bad = _telemetry_csv(spark, sf)[1]
    cell = lambda c: F.get_json_object("raw_record", f"$.{c}")
    return bad.groupBy(cell("machineID").cast("long").alias("machineID"), cell("volt").alias("volt")).agg(F.count(F.lit(1)).alias("bad_rows"))


# ------------------------------------------------------------------ S2: failures CSV
@register("source_failures_csv", sql=f"""
SELECT datetime, machineID, CASE failure WHEN 'comp1' THEN 'none' WHEN 'comp2' THEN ' - ' WHEN 'comp3' THEN NULL ELSE failure END AS failure
FROM ({FAIL})""")
def source_failures_csv_q(spark, sf):
    """Failure texts stay as they are ("none", blanks); an empty one is missing."""
    kind = F.when(F.col("failure") == "comp1", "none").when(F.col("failure") == "comp2", " - ").when(F.col("failure") != "comp3", F.col("failure"))
    folder = f"{scratch_folder(spark, 'failures-csv')}/failures.csv"
    IO.write_csv(_fail(spark, sf).withColumn("failure", kind), folder)
    return IO.read_failures_csv(spark, folder)[0]


# ------------------------------------------------------------------ S5: stage tables
@register("source_stage_rolling", sql=f"""
WITH t AS ({TEL}) SELECT datetime, machineID, {RAW}, tie, {_r_cols} FROM t {_r_win}""")
def source_stage_rolling_q(spark, sf):
    """Telemetry staged by month and machine bucket; the rolling window over it moves no rows."""
    name, path = IO.stage_name("telemetry"), scratch_folder(spark, "stage")
    IO.write_stage_table(_tel(spark, sf), name, path)
    return rolling_features(spark.table(name).drop(IO.STAGE_MONTH), tie="tie")


# ------------------------------------------------------------------ S8: run records
@register("source_runs_json", sql=f"""
SELECT * EXCLUDE (model_group) REPLACE (round(auc_score, 6) AS auc_score, round("precision", 6) AS "precision", round(recall, 6) AS recall)
FROM ({A.SQL_MODEL_RUNS})""")
def source_runs_json_q(spark, sf):
    """Run records as JSON objects {version: record}, a file a model group."""
    runs = A.model_runs_from_part(A.table(spark, sf, "part"))
    body = F.to_json(F.map_from_entries(F.collect_list(F.struct("version", F.struct(*S.MODEL_RUN.names)))), {"ignoreNullFields": "false"})
    path = scratch_folder(spark, "runs-json")
    runs.groupBy("model_group").agg(body.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return IO.read_runs_json(spark, path)


# ------------------------------------------------------------------ S13: batch requests
@register("source_batch_requests", sql=f"""
SELECT CAST(machineID AS INTEGER) AS machineID, {RAW} FROM ({TEL})""")
def source_batch_requests_q(spark, sf):
    """Batch bodies {"predictions": [...]} as JSON lines, an hour of a machine each, one row a reading."""
    t = _tel(spark, sf)
    bodies = t.groupBy("machineID", F.date_trunc("HOUR", "datetime").alias("h")) \
        .agg(F.to_json(F.struct(F.collect_list(F.struct("machineID", *SENS)).alias("predictions"))).alias("value"))
    path = scratch_folder(spark, "batch-json")
    bodies.select("value").write.text(path)
    return IO.read_batch_requests(spark, path)


# ------------------------------------------------------------------ gaps
#: Telemetry with gaps: whole machines without vibration, single volts, runs of rotates.
SQL_GAPS = f"""SELECT datetime, machineID, CASE WHEN tie % 7 <> 0 THEN volt END AS volt, CASE WHEN tie % 11 > 1 THEN rotate END AS rotate,
  pressure, CASE WHEN machineID % 5 <> 0 THEN vibration END AS vibration, tie FROM ({TEL})"""


def _gaps(spark, sf):
    t = _tel(spark, sf)
    m = lambda c, n: F.pmod(F.col(c), F.lit(n))
    return t.withColumns({"volt": F.when(m("tie", 7) != 0, F.col("volt")), "rotate": F.when(m("tie", 11) > 1, F.col("rotate")),
                          "vibration": F.when(m("machineID", 5) != 0, F.col("vibration"))})


@register("null_counts_gaps", sql=f"""
WITH t AS ({SQL_GAPS}), w AS (SELECT {_NULLS} FROM t)
SELECT 'telemetry' AS "table", "column", nulls FROM (UNPIVOT w ON COLUMNS(*) INTO NAME "column" VALUE nulls)""")
def null_counts_gaps_q(spark, sf):
    """N1 on readings with gaps."""
    return P.null_counts(_gaps(spark, sf))


@register("ffill_features_gaps", sql=f"""
WITH t AS ({SQL_GAPS}), r AS (SELECT *, {_ru_cols} FROM t {_ru_win})
SELECT datetime, machineID, tie, {_FILL} FROM r
WINDOW g AS (ORDER BY machineID, datetime, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def ffill_features_gaps_q(spark, sf):
    """N2/N3/W4 on readings with gaps: machines without a vibration take the machine's before."""
    return filled_features(_gaps(spark, sf), tie="tie")


@register("sensor_describe_gaps", sql=f"""
WITH t AS ({SQL_GAPS}) SELECT sensor, {_DESC} FROM ({UNPIV}) WHERE NOT isnan(value) GROUP BY sensor""")
def sensor_describe_gaps_q(spark, sf):
    """A5 on readings with gaps."""
    return P.sensor_describe(_gaps(spark, sf))


@register("align_missing_features", sql=f"""
SELECT machineID, round(volt, 6) AS volt, 0.0::DOUBLE AS humidity, {r6('pressure')}, 0.0::DOUBLE AS volt_3h_mean FROM ({TEL})""")
def align_missing_features_q(spark, sf):
    """Model features that the readings lack are 0, in the model's order."""
    return align_features(_tel(spark, sf), ["volt", "humidity", "pressure", "volt_3h_mean"], keep=["machineID"])


@register("machine_readings", sql=f"""
SELECT datetime, machineID, {RAW}, tie FROM ({TEL}) WHERE machineID = (SELECT min(user_id) FROM events)""")
def machine_readings_q(spark, sf):
    """The readings of one machine, the first; the filter reaches the scan."""
    first = A.table(spark, sf, "events").agg(F.min("user_id").alias("m")).first().m
    return SEL.machine(_tel(spark, sf), first)
