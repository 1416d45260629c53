"""Queries: rolling statistics, fill, labels, feature table, pre-failure windows (W1-W4, N2-N3,
J1-J4, M1, P2-P4, P6, P9-P10, A13-A14, A17)."""

from __future__ import annotations


from .. import schemas as S
from ..operators import prefailure as PF
from ..operators.labels import failure_labels, label_balance, label_counts
from ..operators.rolling import BASELINE_SPEC, default_spec, rolling_baseline, rolling_features, rolling_preview
from ..operators import select as SEL
from ..plans.features import feature_table, filled_features
from ..sources import adapt as A
from . import r6, register

_AGG_SQL = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}
RAW = ", ".join(r6(s) for s in S.SENSORS)


def _tel(spark, sf):
    return A.telemetry_from_events(A.table(spark, sf, "events"))


def _fail(spark, sf):
    return A.failures_from_events(A.table(spark, sf, "events"))


def roll_sql(spec, order="datetime, tie", part="machineID", full=False, rounded=True) -> tuple[str, str]:
    """(select list, WINDOW clause) of the rolling statistics in DuckDB."""
    cols, wins = [], []
    for w, stats in spec.items():
        wins.append(f"w{w} AS (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)")
        for s in S.SENSORS:
            for st in stats:
                e = f"{_AGG_SQL[st]}({s}) OVER w{w}"
                if full:
                    e = f"CASE WHEN count({s}) OVER w{w} >= {w} THEN {e} END"
                name = f"{s}_{w}h_{st}"
                cols.append(r6(e, name) if rounded else f"{e} AS {name}")
    return ", ".join(cols), "WINDOW " + ", ".join(wins)


STAT_NAMES = [f"{s}_{w}h_{st}" for w in S.WINDOWS for s in S.SENSORS for st in S.STATS]
_r_cols, _r_win = roll_sql(default_spec())
_ru_cols, _ru_win = roll_sql(default_spec(), rounded=False)


# ------------------------------------------------------------------ W1 rolling
@register("rolling_features", headline=True, sql=f"""
WITH t AS ({A.SQL_TELEMETRY})
SELECT datetime, machineID, {RAW}, tie, {_r_cols} FROM t {_r_win}""")
def rolling_features_q(spark, sf):
    """32 rolling statistics per machine over 3 and 24 rows."""
    return rolling_features(_tel(spark, sf), tie="tie")


_l_cols, _l_win = roll_sql(default_spec(), order="datetime, tie, tie2")


@register("rolling_lineitem", headline=True, sql=f"""
WITH t AS ({A.SQL_LINEITEM_TELEMETRY})
SELECT datetime, machineID, {RAW}, tie, tie2, {_l_cols} FROM t {_l_win}""")
def rolling_lineitem_q(spark, sf):
    """W1 on lineitem: many readings share one timestamp; ties broken by (orderkey, linenumber)."""
    return rolling_features(A.telemetry_from_lineitem(A.table(spark, sf, "lineitem")), tie=["tie", "tie2"])


@register("rolling_lineitem_chunked", sql=f"""
WITH t AS ({A.SQL_LINEITEM_TELEMETRY})
SELECT datetime, machineID, {RAW}, tie, tie2, {_l_cols} FROM t {_l_win}""")
def rolling_lineitem_chunked_q(spark, sf):
    """W1 skew-safe plan: busy machines cut into time chunks with a 23-row halo (same result)."""
    return rolling_features(A.telemetry_from_lineitem(A.table(spark, sf, "lineitem")), tie=["tie", "tie2"],
                            chunk_rows=64)


_s_cols, _s_win = roll_sql(default_spec(), order="datetime, tie, tie2, tie3")


@register("rolling_skewed", sql=f"""
WITH t AS ({A.SQL_SKEWED_TELEMETRY})
SELECT datetime, machineID, {RAW}, tie, tie2, tie3, {_s_cols} FROM t {_s_win}""")
def rolling_skewed_q(spark, sf):
    """W1 with one machine holding a third of all rows: the hot machine is cut into time
    chunks of ~2,000 rows (many tasks), the others stay whole; same result as one window."""
    return rolling_features(A.skewed_telemetry_from_lineitem(A.table(spark, sf, "lineitem")),
                            tie=["tie", "tie2", "tie3"], chunk_rows=2000)


_b_cols, _b_win = roll_sql(BASELINE_SPEC)


@register("rolling_baseline", sql=f"""
WITH t AS ({A.SQL_TELEMETRY})
SELECT datetime, machineID, {RAW}, tie, {_b_cols} FROM t {_b_win}""")
def rolling_baseline_q(spark, sf):
    """Notebook variant, 3-row mean/std and 24-row mean."""
    return rolling_baseline(_tel(spark, sf), tie="tie")


_p_cols, _p_win = roll_sql({3: ["mean", "std"], 24: ["mean", "std"]}, full=True)


@register("rolling_preview", sql=f"""
WITH t AS ({A.SQL_TELEMETRY})
SELECT datetime, machineID, {RAW}, tie, {_p_cols} FROM t {_p_win}""")
def rolling_preview_q(spark, sf):
    """Every machine, NULL until the window is full, no fill (P3 filter is optional)."""
    return rolling_preview(_tel(spark, sf), tie="tie")


# ------------------------------------------------------------------ N2 fill
_FILL = ", ".join(
    f"round(coalesce(last_value({c} IGNORE NULLS) OVER g, 0), 6) AS {c}" for c in S.SENSORS + STAT_NAMES)


@register("ffill_features", headline=True, sql=f"""
WITH t AS ({A.SQL_TELEMETRY}),
r AS (SELECT *, {_ru_cols} FROM t {_ru_win})
SELECT datetime, machineID, tie, {_FILL} FROM r
WINDOW g AS (ORDER BY machineID, datetime, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def ffill_features_q(spark, sf):
    """Frame-wide forward fill of the statistics, then 0."""
    return filled_features(_tel(spark, sf), tie="tie")


# ------------------------------------------------------------------ J1 labels
def _label_sql(days: int) -> str:
    return f"""
WITH t AS ({A.SQL_TELEMETRY}), f AS ({A.SQL_FAILURES})
SELECT datetime, machineID, {RAW}, tie,
  CAST(EXISTS (SELECT 1 FROM f WHERE f.machineID = t.machineID
       AND t.datetime >= f.datetime - INTERVAL {days * 24} HOUR AND t.datetime < f.datetime) AS INTEGER)
  AS failure_within_window
FROM t"""


@register("failure_labels", headline=True, sql=_label_sql(3))
def failure_labels_q(spark, sf):
    """1 when the machine fails within the next 3 days."""
    return failure_labels(_tel(spark, sf), _fail(spark, sf), days=3)


@register("failure_labels_7d", sql=_label_sql(7))
def failure_labels_7d_q(spark, sf):
    """J1 with a 7-day horizon."""
    return failure_labels(_tel(spark, sf), _fail(spark, sf), days=7)


@register("label_counts", sql=f"""
WITH t AS ({A.SQL_TELEMETRY}), f AS ({A.SQL_FAILURES}),
p AS (SELECT count(*) AS marked_total FROM t JOIN f ON f.machineID = t.machineID
      AND t.datetime >= f.datetime - INTERVAL 72 HOUR AND t.datetime < f.datetime),
l AS ({_label_sql(3)})
SELECT p.marked_total, CAST(count(*) AS BIGINT) AS total_rows,
  CAST(sum(failure_within_window) AS BIGINT) AS positive_rows,
  round(avg(failure_within_window) * 100.0, 6) AS positive_rate_pct
FROM l, p GROUP BY p.marked_total""")
def label_counts_q(spark, sf):
    """Pairs marked including overlaps vs distinct positives."""
    return label_counts(_tel(spark, sf), _fail(spark, sf))


@register("label_balance", sql=f"""
WITH l AS ({_label_sql(3)})
SELECT machineID, count(*) AS rows, CAST(sum(failure_within_window) AS BIGINT) AS positives,
  round(avg(failure_within_window), 6) AS positive_rate FROM l GROUP BY machineID""")
def label_balance_q(spark, sf):
    """Positive rate per machine."""
    return label_balance(failure_labels(_tel(spark, sf), _fail(spark, sf)), key="machineID")


@register("label_class_counts", sql=f"""
WITH l AS ({_label_sql(3)})
SELECT failure_within_window, count(*) AS count FROM l GROUP BY failure_within_window""")
def label_class_counts_q(spark, sf):
    """A3: value counts of the label classes."""
    from ..operators.profile import value_counts
    return value_counts(failure_labels(_tel(spark, sf), _fail(spark, sf)), "failure_within_window")


@register("positive_rate", sql=f"""
WITH l AS ({_label_sql(3)})
SELECT count(*) AS rows, CAST(sum(failure_within_window) AS BIGINT) AS positives,
  round(avg(failure_within_window), 6) AS positive_rate FROM l""")
def positive_rate_q(spark, sf):
    """Overall positive rate of the 3-day label."""
    return label_balance(failure_labels(_tel(spark, sf), _fail(spark, sf)))


# ------------------------------------------------------------------ M1 feature table
@register("feature_table", headline=True, sql=f"""
WITH t AS ({A.SQL_TELEMETRY}), f AS ({A.SQL_FAILURES}),
r AS (SELECT *, {_ru_cols} FROM t {_ru_win})
SELECT datetime, machineID, {_FILL},
  CAST(EXISTS (SELECT 1 FROM f WHERE f.machineID = r.machineID
       AND r.datetime >= f.datetime - INTERVAL 72 HOUR AND r.datetime < f.datetime) AS INTEGER)
  AS failure_within_window
FROM r
WINDOW g AS (ORDER BY machineID, datetime, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def feature_table_q(spark, sf):
    """M1: rolling -> frame fill -> labels, the training table (36 features + label)."""
    return feature_table(_tel(spark, sf), _fail(spark, sf), tie="tie")


@register("feature_table_chunked", sql=f"""
WITH t AS ({A.SQL_TELEMETRY}), f AS ({A.SQL_FAILURES}),
r AS (SELECT *, {_ru_cols} FROM t {_ru_win})
SELECT datetime, machineID, {_FILL},
  CAST(EXISTS (SELECT 1 FROM f WHERE f.machineID = r.machineID
       AND r.datetime >= f.datetime - INTERVAL 72 HOUR AND r.datetime < f.datetime) AS INTEGER)
  AS failure_within_window
FROM r
WINDOW g AS (ORDER BY machineID, datetime, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def feature_table_chunked_q(spark, sf):
    """M1 skew-safe plan: every machine above 16 rows is cut into time chunks for the
    window and the fill (23-row halo, chunk carries); same result as ``feature_table``."""
    return feature_table(_tel(spark, sf), _fail(spark, sf), tie="tie", chunk_rows=16)


# ------------------------------------------------------------------ P9/P10 head and tail
@register("first_readings", sql=f"""
WITH t AS ({A.SQL_TELEMETRY})
SELECT datetime, machineID, {RAW}, tie FROM t ORDER BY datetime, machineID, tie LIMIT 10""")
def first_readings_q(spark, sf):
    """The first 10 readings in time order (a top-k report)."""
    return SEL.head(_tel(spark, sf), 10, ["datetime", "machineID", "tie"])


@register("last_readings", sql=f"""
WITH t AS ({A.SQL_TELEMETRY}),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY machineID ORDER BY datetime DESC, tie DESC) AS INTEGER)
  AS pos FROM t)
SELECT datetime, machineID, {RAW}, tie, pos FROM n WHERE pos <= 20""")
def last_readings_q(spark, sf):
    """P10: the last 20 readings of every machine."""
    return SEL.tail_per_key(_tel(spark, sf), 20, key="machineID", order=["datetime", "tie"])


# ------------------------------------------------------------------ J2/A13/J4/A14 pre-failure
def _pf_sql(rounded: bool) -> str:
    def rd(e, a):
        return r6(e, a) if rounded else f"{e} AS {a}"
    stats = ", ".join(
        f"{rd(f'avg(t.{s})', f'{s}_mean')}, {rd(f'stddev_samp(t.{s})', f'{s}_std')}, "
        f"{rd(f'arg_max(t.{s}, t.datetime) - arg_min(t.{s}, t.datetime)', f'{s}_trend')}" for s in S.SENSORS)
    return f"""
WITH t AS ({A.SQL_TELEMETRY}),
f AS (SELECT *, row_number() OVER () AS fid FROM ({A.SQL_FAILURES}))
SELECT f.machineID, f.datetime AS failure_datetime, f.failure AS failure_type, 3 AS days_before,
  count(*) AS readings, {stats}
FROM f JOIN t ON t.machineID = f.machineID AND t.datetime >= f.datetime - INTERVAL 72 HOUR
  AND t.datetime < f.datetime
GROUP BY f.fid, f.machineID, f.datetime, f.failure"""


_PF_SQL = _pf_sql(True)


@register("pre_failure_stats", sql=_PF_SQL)
def pre_failure_stats_q(spark, sf):
    """Per failure, mean / std / trend of each sensor in the 3 days before."""
    return PF.pre_failure_stats(_tel(spark, sf), _fail(spark, sf), days=3, tie="tie")


@register("normal_vs_prefailure", sql=f"""
WITH t AS ({A.SQL_TELEMETRY}), p AS ({_pf_sql(False)}),
n AS (UNPIVOT (SELECT {', '.join(f'avg({s}) AS {s}' for s in S.SENSORS)} FROM t)
      ON {', '.join(S.SENSORS)} INTO NAME sensor VALUE normal_mean),
s AS (UNPIVOT (SELECT {', '.join(f'stddev_samp({s}) AS {s}' for s in S.SENSORS)} FROM t)
      ON {', '.join(S.SENSORS)} INTO NAME sensor VALUE normal_std),
q AS (UNPIVOT (SELECT {', '.join(f'avg({s}_mean) AS {s}' for s in S.SENSORS)} FROM p)
      ON {', '.join(S.SENSORS)} INTO NAME sensor VALUE pre_failure_mean)
SELECT n.sensor, round(n.normal_mean, 6) AS normal_mean, round(s.normal_std, 6) AS normal_std,
  round(q.pre_failure_mean, 6) AS pre_failure_mean,
  round(q.pre_failure_mean - n.normal_mean, 6) AS difference
FROM n JOIN s USING (sensor) JOIN q USING (sensor)""")
def normal_vs_prefailure_q(spark, sf):
    """All-telemetry mean/std vs mean of per-failure means, aligned by sensor."""
    tel = _tel(spark, sf)
    return PF.normal_vs_prefailure(tel, PF.pre_failure_stats(tel, _fail(spark, sf), days=3, tie="tie"))
