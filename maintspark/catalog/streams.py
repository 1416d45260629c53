"""Queries: streams (X1-X5). The driver's ``events`` arrive in slices of time; a query takes every
slice in a start of its own and goes on from its checkpoint, so each row here went through a
restart. Results equal those of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import score as SC
from ..session import scratch_folder
from ..sources import adapt as A
from ..sources import io as IO
from ..streaming import stream as X
from . import r6, register
from .features import RAW, _fail, _label_sql, _r_cols, _r_win, _tel

SLICES = 3


def slices_of(df: DataFrame, time: str, n: int = SLICES) -> list[DataFrame]:
    """``df`` cut at the n-quantiles of its time (approximate: any cut does); rows without a time come last."""
    at = df.select(F.unix_micros(F.col(time).cast("timestamp")).alias("u")).approxQuantile("u", [i / n for i in range(1, n)], 0.05)
    u = F.unix_micros(F.col(time).cast("timestamp"))
    part = F.coalesce(sum((u > F.lit(int(a))).cast("int") for a in at), F.lit(n - 1)) if at else F.lit(0)
    return [df.where(part == i) for i in range(n)]


# ------------------------------------------------------------------ X1
@register("stream_rolling", sql=f"""
WITH t AS ({A.SQL_TELEMETRY})
SELECT datetime, machineID, {RAW}, tie, {_r_cols}, 'ok' AS status FROM t {_r_win}""")
def stream_rolling_q(spark, sf):
    """Rolling statistics of a stream read in three starts; the last 23 readings of a machine are its state."""
    parts = [{"telemetry": p} for p in slices_of(_tel(spark, sf), S.TIME)]
    out, _ = X.follow(parts, scratch_folder(spark, "rolling"), lambda s: X.rolling_stream(s["telemetry"], tie="tie"), "rolling")
    return out


# ------------------------------------------------------------------ X2
_P = "rotate / 99.0"


@register("stream_scores", sql=f"""
WITH t AS ({A.SQL_TELEMETRY}) SELECT machineID, tie, round({_P}, 6) AS failure_probability,
  CAST({_P} > 0.5 AS INTEGER) AS failure_prediction,
  CASE WHEN {_P} < 0.3 THEN 'LOW' WHEN {_P} < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level FROM t""")
def stream_scores_q(spark, sf):
    """A reading stream scored as it arrives (the stand-in probability of ``risk_bands``)."""
    def scorer(readings):
        return SC.bands(readings.select("machineID", "tie", (F.col("rotate") / 99.0).alias("failure_probability")))
    parts = [{"telemetry": p} for p in slices_of(_tel(spark, sf), S.TIME, 2)]
    out, _ = X.follow(parts, scratch_folder(spark, "scores"), lambda s: X.score_stream(s["telemetry"], scorer), "scores")
    return out


# ------------------------------------------------------------------ X3
def _label_run(spark, sf, days: float = S.PREDICTION_WINDOW_DAYS):
    readings, failures = _tel(spark, sf), _fail(spark, sf)
    closing = X.closing_rows(readings, failures, days)
    parts = [{"readings": r, "failures": f} for r, f in zip(slices_of(readings, S.TIME), slices_of(failures, S.TIME))]
    parts.append({"readings": closing[0], "failures": closing[1]})
    return X.follow(parts, scratch_folder(spark, "labels"), lambda s: X.label_stream(s["readings"], s["failures"], days), "labels")


@register("stream_labels", sql=_label_sql(3))
def stream_labels_q(spark, sf):
    """Every reading once with label 1 or 0 from two streams; equal to ``failure_labels``."""
    return _label_run(spark, sf)[0]


_LATE_F = f"""
WITH t AS ({A.SQL_TELEMETRY}), f AS ({A.SQL_FAILURES}), e AS (SELECT event_id % 5 = 0 AS late, user_id, ts FROM events
  WHERE event_type = 'error' AND value > 100)
SELECT f.machineID, f.datetime, CAST(count(DISTINCT f.k) AS BIGINT) AS failures, count(*) AS pairs
FROM t JOIN (SELECT user_id AS machineID, ts AS datetime, row_number() OVER () AS k FROM e WHERE late) f
  ON f.machineID = t.machineID AND t.datetime >= f.datetime - INTERVAL 72 HOUR AND t.datetime < f.datetime
WHERE NOT EXISTS (SELECT 1 FROM e WHERE NOT late AND e.user_id = t.machineID AND t.datetime >= e.ts - INTERVAL 72 HOUR AND t.datetime < e.ts)
GROUP BY f.machineID, f.datetime"""


@register("stream_late_failures", sql=_LATE_F)
def stream_late_failures_q(spark, sf):
    """Every fifth failure arrives after the stream was closed; the failures that left zeros behind."""
    ev = A.table(spark, sf, "events")
    readings, late = A.telemetry_from_events(ev), F.pmod(F.col("event_id"), F.lit(5)) == 0
    on_time, behind = A.failures_from_events(ev.where(~late)), A.failures_from_events(ev.where(late))
    closing = X.closing_rows(readings, on_time)
    parts = [{"readings": readings, "failures": on_time}, {"readings": closing[0], "failures": closing[1]},
             {"readings": closing[0].limit(0), "failures": behind}]
    out, _ = X.follow(parts, scratch_folder(spark, "late"), lambda s: X.label_stream(s["readings"], s["failures"]), "late")
    return X.late_failures(out, A.failures_from_events(ev))


# ------------------------------------------------------------------ X4
_ROLL = """count(*) AS requests, CAST(count_if(status = 'error') AS BIGINT) AS errors,
  CAST(count_if(risk_level = 'LOW') AS BIGINT) AS low, CAST(count_if(risk_level = 'MEDIUM') AS BIGINT) AS medium,
  CAST(count_if(risk_level = 'HIGH') AS BIGINT) AS high, round(avg(duration_seconds), 6) AS mean_latency"""


@register("stream_rollups", sql=f"""
WITH l AS ({A.SQL_PRED_LOG}), b AS (SELECT *, request_id % 10 = 0 AS behind, time_bucket(INTERVAL 5 MINUTE, prediction_timestamp) AS w FROM l),
m AS (SELECT max(prediction_timestamp) - INTERVAL 10 MINUTE AS wm FROM b WHERE NOT behind),
k AS (SELECT b.*, behind AND w + INTERVAL 5 MINUTE <= wm AS dropped FROM b, m)
SELECT w AS window_start, {_ROLL}, (SELECT count(*) FROM k WHERE dropped) AS dropped_rows FROM k WHERE NOT dropped GROUP BY w""")
def stream_rollups_q(spark, sf):
    """Five-minute windows of the prediction log. Every tenth row arrives after all others and
    is dropped behind the watermark; ``dropped_rows`` counts those on every window's row."""
    log = A.prediction_log_from_events(A.table(spark, sf, "events"))
    behind = F.pmod(F.col("request_id"), F.lit(10)) == 0
    close = log.agg(F.max("prediction_timestamp").alias("m"))
    last = log.limit(1).withColumn("_one", F.lit(1)).join(close.withColumn("_one", F.lit(1)), "_one") \
        .withColumn("prediction_timestamp", F.col("m") + F.expr("INTERVAL 30 DAYS")).select(*log.columns)
    parts = [{"log": log.where(~behind)}, {"log": log.where(behind)}, {"log": last}]
    out, progress = X.follow(parts, scratch_folder(spark, "rollups"), lambda s: X.rollup_stream(s["log"]), "rollups")
    gone = X.dropped_rows(progress, out) - 1  # the closing row is read, and its window never ends
    return out.select("window_start", "requests", "errors", "low", "medium", "high", "mean_latency", F.lit(gone).cast("long").alias("dropped_rows"))


# ------------------------------------------------------------------ X5
@register("stream_csv_ingest", sql=f"""
WITH t AS ({A.SQL_TELEMETRY})
SELECT datetime, machineID, {', '.join(r6(s) for s in S.SENSORS)} FROM t WHERE tie % 50 <> 7""")
def stream_csv_ingest_q(spark, sf):
    """Telemetry CSV files that arrive in three lots, ingested in three starts; every fiftieth
    row has a volt of text and goes to the bad rows instead."""
    folder = scratch_folder(spark, "csv")
    out = None
    for part in slices_of(_tel(spark, sf), S.TIME):
        volt = F.when(F.pmod(F.col("tie"), F.lit(50)) == 7, "no reading").otherwise(F.col("volt").cast("string"))
        IO.write_csv(part.withColumn("volt", volt).drop("tie"), f"{folder}/in")
        out = X.telemetry_stream(spark, f"{folder}/in", max_files_per_trigger=4)
        X.start_to_parquet(out, f"{folder}/out", "csv", checkpoint=f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out")
