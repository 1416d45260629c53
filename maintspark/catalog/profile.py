"""Queries: profiling."""

from __future__ import annotations

from .. import schemas as S
from ..operators import profile as P
from ..sources import adapt as A
from . import r6, register

SENS = S.SENSORS
TEL = A.SQL_TELEMETRY
FAIL = A.SQL_FAILURES
UNPIV = f"UNPIVOT t ON {', '.join(SENS)} INTO NAME sensor VALUE value"


def _tel(spark, sf):
    return A.telemetry_from_events(A.table(spark, sf, "events"))


def _fail(spark, sf):
    return A.failures_from_events(A.table(spark, sf, "events"))


@register("ingest_stats", sql=f"""
WITH t AS ({TEL}), f AS ({FAIL})
SELECT (SELECT count(*) FROM t) AS telemetry_records, (SELECT count(*) FROM f) AS failure_records,
  (SELECT count(DISTINCT machineID) FROM t) AS unique_machines,
  (SELECT CAST(floor(date_diff('microsecond', min(datetime), max(datetime)) / 86400000000.0) AS BIGINT) FROM t)
  AS date_range_days""")
def ingest_stats_q(spark, sf):
    """Ingestion statistics."""
    return P.ingest_stats(_tel(spark, sf), _fail(spark, sf))


_NULLS = ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in SENS else ''}) AS {c}"
    for c in ["datetime", "machineID"] + SENS + ["tie"])


@register("null_counts", sql=f"""
WITH t AS ({TEL}), w AS (SELECT {_NULLS} FROM t)
SELECT 'telemetry' AS "table", "column", nulls FROM (UNPIVOT w ON COLUMNS(*) INTO NAME "column" VALUE nulls)""")
def null_counts_q(spark, sf):
    """Missing values per column, one pass."""
    return P.null_counts(_tel(spark, sf))


@register("validation_summary", sql=f"""
WITH t AS ({TEL}), f AS ({FAIL})
SELECT count(*) AS telemetry_rows, 7 AS telemetry_columns, 3 AS failures_columns,
  min(datetime) AS first_reading, max(datetime) AS last_reading,
  count(DISTINCT machineID) AS unique_machines, (SELECT count(*) FROM f) AS total_failures,
  CAST(sum((datetime IS NULL)::INT + (machineID IS NULL)::INT + (volt IS NULL OR isnan(volt))::INT
    + (rotate IS NULL OR isnan(rotate))::INT + (pressure IS NULL OR isnan(pressure))::INT
    + (vibration IS NULL OR isnan(vibration))::INT + (tie IS NULL)::INT) AS BIGINT) AS missing_values
FROM t""")
def validation_summary_q(spark, sf):
    """A1/A2: dataset validation record."""
    return P.validation_summary(_tel(spark, sf), _fail(spark, sf))


@register("failure_type_counts", sql=f"""
WITH f AS ({FAIL}) SELECT failure, count(*) AS count FROM f WHERE failure IS NOT NULL GROUP BY failure""")
def failure_type_counts_q(spark, sf):
    """Failures per component, most frequent first."""
    return P.value_counts(_fail(spark, sf), "failure")


@register("records_per_machine", sql=f"""
WITH t AS ({TEL}) SELECT machineID, count(*) AS records FROM t GROUP BY machineID""")
def records_per_machine_q(spark, sf):
    """A3: readings per machine."""
    return P.value_counts(_tel(spark, sf), "machineID", "records")


@register("failures_per_machine", sql=f"""
WITH f AS ({FAIL}) SELECT machineID, count(*) AS failures FROM f GROUP BY machineID""")
def failures_per_machine_q(spark, sf):
    """A3: failures per machine."""
    return P.value_counts(_fail(spark, sf), "machineID", "failures")


@register("failure_type_share", sql=f"""
WITH f AS ({FAIL}), c AS (SELECT failure, count(*) AS count FROM f GROUP BY failure)
SELECT failure, count, round(count * 100.0 / sum(count) OVER (), 6) AS percent FROM c""")
def failure_type_share_q(spark, sf):
    """A4: percent share of each failure type."""
    return P.value_share(_fail(spark, sf), "failure")


_DESC = (f"count(value) AS count, {r6('avg(value)', 'mean')}, {r6('stddev_samp(value)', 'std')}, "
         f"{r6('min(value)', 'min')}, {r6('quantile_cont(value, 0.25)', 'p25')}, "
         f"{r6('quantile_cont(value, 0.5)', 'p50')}, {r6('quantile_cont(value, 0.75)', 'p75')}, "
         f"{r6('max(value)', 'max')}")


@register("sensor_describe", headline=True, sql=f"""
WITH t AS ({TEL}) SELECT sensor, {_DESC} FROM ({UNPIV}) WHERE NOT isnan(value) GROUP BY sensor""")
def sensor_describe_q(spark, sf):
    """A5: describe() of the sensors with exact, interpolated quartiles."""
    return P.sensor_describe(_tel(spark, sf))


@register("machine_records_describe", sql=f"""
WITH t AS ({TEL}), c AS (SELECT CAST(count(*) AS DOUBLE) AS value FROM t GROUP BY machineID)
SELECT 'records' AS "column", {_DESC} FROM c""")
def machine_records_describe_q(spark, sf):
    """A5: describe() of the per-machine record counts."""
    return P.records_describe(_tel(spark, sf))


_PAIRS = [(a, b) for i, a in enumerate(SENS) for b in SENS[i + 1:]]
_CORR = " UNION ALL ".join(
    [f"SELECT '{a}' AS sensor_a, '{b}' AS sensor_b, round(corr({a}, {b}), 6) AS corr FROM t" for a, b in _PAIRS]
    + [f"SELECT '{b}' AS sensor_a, '{a}' AS sensor_b, round(corr({a}, {b}), 6) AS corr FROM t" for a, b in _PAIRS]
    + [f"SELECT '{s}' AS sensor_a, '{s}' AS sensor_b, 1.0::DOUBLE AS corr" for s in SENS])


@register("sensor_correlation", sql=f"WITH t AS ({TEL}) {_CORR}")
def sensor_correlation_q(spark, sf):
    """Pearson correlation matrix (long form)."""
    return P.correlation(_tel(spark, sf))


@register("sensor_histogram", sql=f"""
WITH t AS ({TEL}), v AS (SELECT sensor, value FROM ({UNPIV}) WHERE NOT isnan(value)),
b0 AS (SELECT sensor, min(value) AS lo, max(value) AS hi FROM v GROUP BY sensor),
b AS (SELECT sensor, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
             CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM b0),
c AS (SELECT v.sensor, CAST(least(floor((value - lo) * 50.0 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS n
      FROM v JOIN b USING (sensor) GROUP BY ALL),
s AS (SELECT sensor, lo, hi, CAST(bin AS INTEGER) AS bin FROM b, range(0, 50) r(bin))
SELECT s.sensor, s.bin, round(lo + s.bin * ((hi - lo) / 50.0), 6) AS bin_start,
  round(lo + (s.bin + 1) * ((hi - lo) / 50.0), 6) AS bin_end, CAST(coalesce(n, 0) AS BIGINT) AS count
FROM s LEFT JOIN c ON s.sensor = c.sensor AND s.bin = c.bin""")
def sensor_histogram_q(spark, sf):
    """50 equal-width bins per sensor, empty bins included."""
    return P.histogram(_tel(spark, sf))


@register("daily_sensor_mean", sql=f"""
WITH t AS ({TEL}), m AS (SELECT CAST(datetime AS DATE) AS day, {', '.join(f'avg({s}) AS {s}' for s in SENS)}
  FROM t GROUP BY 1),
d AS (SELECT CAST(generate_series AS DATE) AS day FROM generate_series(
  (SELECT CAST(min(datetime) AS DATE) FROM t)::TIMESTAMP, (SELECT CAST(max(datetime) AS DATE) FROM t)::TIMESTAMP,
  INTERVAL 1 DAY))
SELECT d.day, {', '.join(r6('m.' + s, s) for s in SENS)} FROM d LEFT JOIN m USING (day)""")
def daily_sensor_mean_q(spark, sf):
    """Daily mean over all machines with a calendar spine."""
    return P.daily_mean(_tel(spark, sf))


@register("monthly_failures", sql=f"""
WITH f AS ({FAIL}), c AS (SELECT last_day(CAST(datetime AS DATE)) AS month_end, count(*) AS n FROM f GROUP BY 1),
m AS (SELECT last_day(CAST(generate_series AS DATE)) AS month_end FROM generate_series(
  date_trunc('month', (SELECT min(datetime) FROM f)), date_trunc('month', (SELECT max(datetime) FROM f)),
  INTERVAL 1 MONTH))
SELECT m.month_end, CAST(coalesce(n, 0) AS BIGINT) AS failures FROM m LEFT JOIN c USING (month_end)""")
def monthly_failures_q(spark, sf):
    """A10: failures per month, empty months 0, labelled by month end."""
    return P.monthly_counts(_fail(spark, sf))


@register("hourly_pattern", sql=f"""
WITH t AS ({TEL}) SELECT CAST(hour(datetime) AS INTEGER) AS hour, {', '.join(r6(f'avg({s})', s) for s in SENS)}
FROM t GROUP BY 1""")
def hourly_pattern_q(spark, sf):
    """Mean per hour of day."""
    return P.hourly_pattern(_tel(spark, sf))


@register("machine_mean", sql=f"""
WITH t AS ({TEL}) SELECT machineID, {', '.join(r6(f'avg({s})', s) for s in SENS)} FROM t GROUP BY machineID""")
def machine_mean_q(spark, sf):
    """Mean per machine."""
    return P.group_mean(_tel(spark, sf))


@register("iqr_outliers", sql=f"""
WITH t AS ({TEL}), v AS (SELECT sensor, value FROM ({UNPIV})),
q AS (SELECT sensor, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM v
      WHERE NOT isnan(value) GROUP BY sensor),
b AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT b.sensor, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lo, 6) AS lower_bound,
  round(hi, 6) AS upper_bound, count(*) FILTER (WHERE value < lo OR value > hi) AS count,
  round(count(*) FILTER (WHERE value < lo OR value > hi) * 100.0 / count(*), 6) AS percentage
FROM v JOIN b USING (sensor) GROUP BY b.sensor, q1, q3, iqr, lo, hi""")
def iqr_outliers_q(spark, sf):
    """IQR outlier bounds and counts per sensor."""
    return P.iqr_outliers(_tel(spark, sf))


@register("business_facts", sql=f"""
WITH t AS ({TEL}), f AS ({FAIL}),
c AS (SELECT failure, count(*) AS n FROM f WHERE failure IS NOT NULL GROUP BY failure)
SELECT count(DISTINCT machineID) AS machines,
  CAST(floor(date_diff('microsecond', min(datetime), max(datetime)) / 86400000000.0) AS BIGINT) AS collection_days,
  CAST(sum((volt IS NULL OR isnan(volt))::INT + (rotate IS NULL OR isnan(rotate))::INT
    + (pressure IS NULL OR isnan(pressure))::INT + (vibration IS NULL OR isnan(vibration))::INT
    + (datetime IS NULL)::INT + (machineID IS NULL)::INT + (tie IS NULL)::INT) AS BIGINT) AS missing_cells,
  (SELECT count(*) FROM f) AS total_failures,
  round((SELECT count(*) FROM f) / count(DISTINCT machineID), 6) AS failures_per_machine,
  (SELECT failure FROM c ORDER BY n DESC, failure LIMIT 1) AS most_common_failure
FROM t""")
def business_facts_q(spark, sf):
    """Business facts with the most common failure (ties: smallest name)."""
    return P.business_facts(_tel(spark, sf), _fail(spark, sf))
