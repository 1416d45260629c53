"""Queries: monitoring over the prediction log."""

from __future__ import annotations

from .. import schemas as S
from ..operators import monitor as M
from ..sources import adapt as A
from . import register

LOG = A.SQL_PRED_LOG
EP = "epoch_us(prediction_timestamp)"


def _log(spark, sf):
    return A.prediction_log_from_events(A.table(spark, sf, "events"))


def _tel(spark, sf):
    return A.telemetry_from_events(A.table(spark, sf, "events"))


@register("risk_level_counts", sql=f"""
WITH p AS ({LOG}), c AS (SELECT risk_level, count(*) AS count FROM p GROUP BY risk_level)
SELECT risk_level, count, CAST(sum(CASE WHEN risk_level IN ('LOW', 'MEDIUM', 'HIGH') THEN count ELSE 0 END)
  OVER () AS BIGINT) AS total_predictions FROM c""")
def risk_level_counts_q(spark, sf):
    """O1: predictions by risk level and their total."""
    return M.risk_level_counts(_log(spark, sf))


def _cum_sql(value: str, bounds, by: str | None) -> str:
    labels = [repr(float(b)) for b in bounds]
    g = f"{by}, " if by else ""
    parts = [f"SELECT {g}'{lab}' AS le, count(*) FILTER (WHERE {value} <= {b}) AS cumulative_count, "
             f"count({value}) AS total_count, round(sum({value}), 6) AS total_sum FROM p"
             f"{' GROUP BY ' + by if by else ''}" for lab, b in zip(labels, bounds)]
    parts.append(f"SELECT {g}'+Inf' AS le, count({value}), count({value}), round(sum({value}), 6) FROM p"
                 f"{' GROUP BY ' + by if by else ''}")
    return f"WITH p AS ({LOG}) " + " UNION ALL ".join(parts)


@register("confidence_histogram", sql=_cum_sql("failure_probability", M.PROBABILITY_BOUNDS, None))
def confidence_histogram_q(spark, sf):
    """O2: cumulative histogram of failure probabilities, count and sum."""
    return M.confidence_histogram(_log(spark, sf))


@register("request_counts", sql=f"""
WITH p AS ({LOG}) SELECT method, endpoint, status, count(*) AS requests FROM p GROUP BY ALL""")
def request_counts_q(spark, sf):
    """O3: requests by method, endpoint and status."""
    return M.request_counts(_log(spark, sf))


@register("duration_histogram", sql=_cum_sql("duration_seconds", M.LATENCY_BOUNDS, "endpoint"))
def duration_histogram_q(spark, sf):
    """O3: request latency histogram per endpoint."""
    return M.duration_histogram(_log(spark, sf))


def _js_sql(values_sql: str, bins: int, threshold: float) -> str:
    """values_sql yields (feature, value, side)."""
    return f"""
v AS ({values_sql}),
b AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM v GROUP BY feature),
c AS (SELECT v.feature, CAST(least(floor((value - lo) * {float(bins)} /
        CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END), {bins - 1}) AS INTEGER) AS bin,
      count(*) FILTER (WHERE side = 0) AS b, count(*) FILTER (WHERE side = 1) AS c
      FROM v JOIN b USING (feature) GROUP BY ALL),
pq AS (SELECT feature, b / sum(b) OVER (PARTITION BY feature) AS p, c / sum(c) OVER (PARTITION BY feature) AS q FROM c),
j AS (SELECT feature, 0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) AS js FROM pq GROUP BY feature)
SELECT feature, round(js, 6) AS js_divergence, CAST({float(threshold)} AS DOUBLE) AS threshold, js > {threshold} AS drift_detected
FROM j"""


_SENSOR_VALUES = f"""SELECT sensor AS feature, value,
  CASE WHEN epoch_us(datetime) < (SELECT (min(epoch_us(datetime)) + max(epoch_us(datetime))) // 2 FROM t)
       THEN 0 ELSE 1 END AS side
  FROM (UNPIVOT t ON {', '.join(S.SENSORS)} INTO NAME sensor VALUE value) WHERE NOT isnan(value)"""


@register("sensor_drift", sql=f"WITH t AS ({A.SQL_TELEMETRY}), " + _js_sql(_SENSOR_VALUES, 50, S.DRIFT_THRESHOLD))
def sensor_drift_q(spark, sf):
    """JS divergence per sensor, first half of the time span vs second half."""
    base, cur = M.split_at_midpoint(_tel(spark, sf), "datetime")
    return M.histogram_drift(base, cur, S.SENSORS, bins=50, threshold=S.DRIFT_THRESHOLD)


_PRED_VALUES = f"""SELECT 'failure_probability' AS feature, failure_probability AS value,
  CASE WHEN {EP} < (SELECT (min({EP}) + max({EP})) // 2 FROM p) THEN 0 ELSE 1 END AS side FROM p"""


@register("prediction_drift", sql=f"WITH p AS ({LOG}), " + _js_sql(_PRED_VALUES, 10, S.PREDICTION_DRIFT_THRESHOLD))
def prediction_drift_q(spark, sf):
    """Prediction drift, threshold 0.2."""
    base, cur = M.split_at_midpoint(_log(spark, sf), "prediction_timestamp")
    return M.histogram_drift(base, cur, ["failure_probability"], bins=10, threshold=S.PREDICTION_DRIFT_THRESHOLD)


def _windowed_js_sql(window_us: int) -> str:
    return f"""
mid AS (SELECT (min({EP}) + max({EP})) // 2 AS m FROM p),
base AS (SELECT CAST(least(floor(failure_probability * 10.0), 9) AS INTEGER) AS bin, count(*) AS b
         FROM p WHERE {EP} < (SELECT m FROM mid) GROUP BY 1),
per AS (SELECT {EP} // {window_us} AS w, CAST(least(floor(failure_probability * 10.0), 9) AS INTEGER) AS bin,
        count(*) AS c FROM p GROUP BY ALL),
grid AS (SELECT w, bin, b FROM (SELECT DISTINCT w FROM per), base),
full_ AS (SELECT coalesce(grid.w, per.w) AS w, coalesce(grid.bin, per.bin) AS bin, coalesce(b, 0) AS b,
          coalesce(c, 0) AS c FROM grid FULL OUTER JOIN per ON grid.w = per.w AND grid.bin = per.bin),
pq AS (SELECT w, b / sum(b) OVER (PARTITION BY w) AS p_, c / sum(c) OVER (PARTITION BY w) AS q_ FROM full_),
js AS (SELECT w, 0.5 * sum(CASE WHEN p_ > 0 THEN p_ * log2(p_ / ((p_ + q_) / 2)) ELSE 0 END
        + CASE WHEN q_ > 0 THEN q_ * log2(q_ / ((p_ + q_) / 2)) ELSE 0 END) AS js FROM pq GROUP BY w)"""


@register("drift_alerts", sql=f"""
WITH p AS ({LOG}), {_windowed_js_sql(M.MIN5_US)}
SELECT make_timestamp(w * {M.MIN5_US}) AS window_start, round(js, 6) AS js_divergence, CAST(0.3 AS DOUBLE) AS threshold
FROM js WHERE js > 0.3""")
def drift_alerts_q(spark, sf):
    """300 s windows whose prediction drift vs the first half exceeds 0.3."""
    log = _log(spark, sf)
    base, _ = M.split_at_midpoint(log, "prediction_timestamp")
    return M.drift_alerts(log, base)


@register("volume_alerts", sql=f"""
WITH p AS ({LOG}), c AS (SELECT {EP} // {M.HOUR_US} AS w, count(*) AS n FROM p GROUP BY 1),
s AS (SELECT range AS w FROM range((SELECT min(w) FROM c), (SELECT max(w) FROM c) + 1))
SELECT make_timestamp(s.w * {M.HOUR_US}) AS hour_start, CAST(coalesce(n, 0) AS BIGINT) AS predictions,
  coalesce(n, 0) < 10 AS alert FROM s LEFT JOIN c USING (w)""")
def volume_alerts_q(spark, sf):
    """Hourly volume on an hour spine; fewer than 10 alerts."""
    return M.volume_alerts(_log(spark, sf))


@register("error_alerts", sql=f"""
WITH p AS ({LOG}), r AS (SELECT {EP} // {M.MIN5_US} AS w, count(*) AS requests,
  count(*) FILTER (WHERE status = 'error') AS errors FROM p GROUP BY 1),
a AS (SELECT *, errors / requests AS rate FROM r WHERE errors / requests > 0.05)
SELECT make_timestamp(a.w * {M.MIN5_US}) AS window_start, a.requests, a.errors, round(a.rate, 6) AS error_rate,
  round(b.rate, 6) AS previous_error_rate FROM a JOIN a b ON b.w = a.w - 1""")
def error_alerts_q(spark, sf):
    """Error share above 5 % in two consecutive 300 s windows."""
    return M.error_alerts(_log(spark, sf))


@register("monitoring_series", sql=f"""
WITH p AS ({LOG}), {_windowed_js_sql(M.HOUR_US)},
f AS (SELECT {EP} // {M.MIN5_US} AS w, CAST(count(*) AS DOUBLE) AS volume, avg(duration_seconds) AS latency
      FROM p GROUP BY 1)
SELECT 'volume_5m' AS series, make_timestamp(w * {M.MIN5_US}) AS window_start, round(volume, 6) AS value FROM f
UNION ALL SELECT 'latency_5m', make_timestamp(w * {M.MIN5_US}), round(latency, 6) FROM f
UNION ALL SELECT 'drift_1h', make_timestamp(w * {M.HOUR_US}), round(js, 6) FROM js""")
def monitoring_series_q(spark, sf):
    """Volume and mean latency per 300 s, drift per hour."""
    log = _log(spark, sf)
    base, _ = M.split_at_midpoint(log, "prediction_timestamp")
    return M.monitoring_series(log, base)
