"""Queries: dataset preparation and samples."""

from __future__ import annotations

from .. import schemas as S
from ..operators import select as SEL
from ..operators import split as SP
from ..operators.labels import failure_labels
from ..sources import adapt as A
from . import register

TEL = A.SQL_TELEMETRY
FAIL = A.SQL_FAILURES
LABELED = f"""SELECT t.*, CAST(EXISTS (SELECT 1 FROM ({FAIL}) f WHERE f.machineID = t.machineID
  AND t.datetime >= f.datetime - INTERVAL 72 HOUR AND t.datetime < f.datetime) AS INTEGER) AS failure_within_window
  FROM ({TEL}) t"""


def _tel(spark, sf):
    return A.telemetry_from_events(A.table(spark, sf, "events"))


def _labeled(spark, sf):
    ev = A.table(spark, sf, "events")
    return failure_labels(A.telemetry_from_events(ev), A.failures_from_events(ev))


def _split_sql(order: str) -> str:
    return f"""
WITH t AS ({TEL}), o AS (SELECT datetime, machineID, tie,
  row_number() OVER (ORDER BY {order}) - 1 AS pos, count(*) OVER () AS n FROM t)
SELECT datetime, machineID, tie,
  CASE WHEN pos < CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM o"""


@register("temporal_split", headline=True, sql=_split_sql("datetime, machineID, tie"))
def temporal_split_q(spark, sf):
    """First int(N*0.8) rows by time are train."""
    t = _tel(spark, sf).select("datetime", "machineID", "tie")
    return SP.temporal_split(t, tie="tie")


@register("machine_order_split", sql=_split_sql("machineID, datetime, tie"))
def machine_order_split_q(spark, sf):
    """M3: the notebook's split of the machine-sorted frame."""
    t = _tel(spark, sf).select("datetime", "machineID", "tie")
    return SP.machine_order_split(t, tie="tie")


@register("split_balance", sql=f"""
WITH l AS ({LABELED}), o AS (SELECT *, row_number() OVER (ORDER BY datetime, machineID, tie) - 1 AS pos,
  count(*) OVER () AS n FROM l),
s AS (SELECT *, CASE WHEN pos < CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM o)
SELECT split, count(*) AS rows, CAST(sum(failure_within_window) AS BIGINT) AS positives,
  round(avg(failure_within_window), 6) AS positive_rate FROM s GROUP BY split""")
def split_balance_q(spark, sf):
    """M4: class balance per split."""
    return SP.split_balance(SP.temporal_split(_labeled(spark, sf), tie="tie"))


@register("class_weights", sql=f"""
WITH l AS ({LABELED}), c AS (SELECT failure_within_window, count(*) AS count FROM l GROUP BY 1)
SELECT failure_within_window, count,
  round(sum(count) OVER () / (count(*) OVER () * count), 6) AS weight,
  round(sum(count) FILTER (WHERE failure_within_window = 0) OVER () /
        sum(count) FILTER (WHERE failure_within_window = 1) OVER (), 6) AS scale_pos_weight
FROM c""")
def class_weights_q(spark, sf):
    """M5: balanced class weights and n0/n1."""
    return SP.class_weights(_labeled(spark, sf))


@register("hash_sample", sql=f"""
WITH t AS ({TEL}) SELECT datetime, machineID, tie FROM t
ORDER BY md5('42|' || CAST(tie AS VARCHAR)), tie LIMIT 500""")
def hash_sample_q(spark, sf):
    """Repeatable fixed-size sample (500 rows, seed 42) -- the sampling operator's limit."""
    t = _tel(spark, sf).select("datetime", "machineID", "tie")
    return SEL.hash_sample(t, 500, ["tie"], seed=42)


@register("prediction_sample", sql=f"""
WITH p AS ({A.SQL_PRED_LOG})
SELECT request_id, machineID, prediction_timestamp, round(failure_probability, 6) AS failure_probability FROM p
WHERE ('0x' || substr(md5(CAST(request_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 10""")
def prediction_sample_q(spark, sf):
    """10 % of predictions by md5 bucket of the request id (repeatable in batch and stream)."""
    p = A.prediction_log_from_events(A.table(spark, sf, "events"))
    return SEL.percent_sample(p.select("request_id", "machineID", "prediction_timestamp", "failure_probability"),
                              S.SAMPLE_PERCENT, ["request_id"])
