import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import make_failures, make_telemetry, to_spark
from maintspark import schemas as S
from maintspark.operators import profile as P
from maintspark.operators import runs as R
from maintspark.plans.quantiles import quantiles


def test_describe_matches_pandas(spark):
    pdf = make_telemetry(999, 7, nulls=0.1)
    out = {r.sensor: r for r in P.sensor_describe(to_spark(spark, pdf)).collect()}
    exp = pdf[S.SENSORS].describe()
    for s in S.SENSORS:
        assert out[s]["count"] == exp.loc["count", s]
        for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                             ("p75", "75%"), ("max", "max")]:
            assert out[s][ours] == pytest.approx(exp.loc[theirs, s], abs=1e-9), (s, ours)


def test_quantiles_approx_close(spark):
    pdf = make_telemetry(2000, 5)
    q = {(r.column, r.q): r.value for r in quantiles(to_spark(spark, pdf), ["volt"], [0.5], approx=True).collect()}
    assert q[("volt", 0.5)] == pytest.approx(pdf.volt.median(), abs=1.0)


def test_histogram_matches_numpy(spark):
    pdf = make_telemetry(1000, 5)
    out = P.histogram(to_spark(spark, pdf), ["volt"], bins=50).orderBy("bin").toPandas()
    counts, edges = np.histogram(pdf.volt, bins=50)
    assert out["count"].tolist() == counts.tolist()
    assert np.allclose(out.bin_start, edges[:-1])


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    out = P.histogram(df, ["v"], bins=50).filter("count > 0").collect()
    assert len(out) == 1 and out[0]["bin"] == 25


def test_outliers_match_pandas(spark):
    pdf = make_telemetry(1000, 5)
    pdf.loc[::97, "volt"] = 400.0
    out = {r.sensor: r for r in P.iqr_outliers(to_spark(spark, pdf)).collect()}
    q1, q3 = pdf.volt.quantile(0.25), pdf.volt.quantile(0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    n = int(((pdf.volt < lo) | (pdf.volt > hi)).sum())
    assert out["volt"]["count"] == n
    assert out["volt"].percentage == pytest.approx(n / len(pdf) * 100)


def test_daily_spine_and_monthly(spark):
    pdf = make_telemetry(48, 2)
    pdf = pdf[pdf.datetime.dt.day != 1]              # drop day 1 -> the spine still starts at day 2
    pdf = pd.concat([pdf, pdf.assign(datetime=pdf.datetime + pd.Timedelta(days=5))])
    out = P.daily_mean(to_spark(spark, pdf)).orderBy("day").toPandas()
    exp = pdf.set_index("datetime")[S.SENSORS].resample("D").mean()
    assert len(out) == len(exp)
    assert out.volt.isna().sum() == exp.volt.isna().sum()
    fail = make_failures(10)
    m = P.monthly_counts(to_spark(spark, fail)).orderBy("month_end").toPandas()
    em = fail.set_index("datetime").resample("ME").size()
    assert m.failures.tolist() == em.tolist()


def test_correlation_symmetry(spark):
    pdf = make_telemetry(500, 5)
    out = {(r.sensor_a, r.sensor_b): r.corr for r in P.correlation(to_spark(spark, pdf)).collect()}
    exp = pdf[S.SENSORS].corr()
    for a in S.SENSORS:
        for b in S.SENSORS:
            assert out[(a, b)] == pytest.approx(exp.loc[a, b], abs=1e-9)


def test_null_counts(spark):
    pdf = make_telemetry(200, 5, nulls=0.25)
    out = {r.column: r.nulls for r in P.null_counts(to_spark(spark, pdf)).collect()}
    assert out == {c: int(pdf[c].isna().sum()) for c in pdf.columns}


def _registry(spark, statuses=("active", "candidate", "candidate"), aucs=(0.7844690520950787,) * 3,
              dates=("2024-01-01T10:00:00", "2024-01-02T10:00:00", "2024-01-03T10:00:00")):
    rows = [(f"v{i}", "Random Forest", "RandomForestClassifier", a, 0.245, 0.634, d, 0, 36, f"m/{i}", s, None, "")
            for i, (s, a, d) in enumerate(zip(statuses, aucs, dates))]
    return spark.createDataFrame(rows, S.MODEL_RUN)


def test_auto_promotion_equal_metrics_returns_nothing(spark):
    runs = _registry(spark)
    d = R.auto_decisions(runs).first()
    assert d.promote is False and d.reason == "improvement below threshold"
    snap = R.auto_promote(runs, "2024-06-01").toPandas()
    assert snap.status.tolist() == ["active", "candidate", "candidate"]


def test_promote_and_unknown_version(spark):
    runs = _registry(spark, aucs=(0.78, 0.80, 0.79))
    snap = R.promote(runs, spark.createDataFrame([("v1",)], "version string"), "2024-06-01").toPandas()
    assert dict(zip(snap.version, snap.status)) == {"v0": "retired", "v1": "active", "v2": "candidate"}
    assert snap.set_index("version").deployment_date["v1"] == "2024-06-01"
    same = R.promote(runs, spark.createDataFrame([("v9",)], "version string"), "2024-06-01").toPandas()
    assert same.status.tolist() == ["active", "candidate", "candidate"]


def test_recommendations(spark):
    base = _registry(spark, statuses=("active",), aucs=(0.80,), dates=("2024-01-01",))
    for auc, prec, text in [(0.82, 0.245, "DEPLOY - Significant"), (0.807, 0.27, "DEPLOY - Good"),
                            (0.78, 0.245, "REJECT - AUC"), (0.80, 0.15, "REJECT - Precision"), (0.801, 0.245, "HOLD")]:
        other = spark.createDataFrame([("w", "x", "y", auc, prec, 0.6, "2024-02-01", 0, 36, "", "candidate", None, "")],
                                      S.MODEL_RUN)
        rec = R.compare(base, other, []).first().recommendation
        assert rec.startswith(text), (auc, prec, rec)


def test_summary_and_listing(spark):
    runs = _registry(spark, aucs=(0.78, 0.80, 0.80))
    s = R.summary(runs).first()
    assert (s.total_models, s.active_models, s.candidate_models, s.best_model_version) == (3, 1, 2, "v1")
    assert [r.version for r in R.listing(runs).collect()] == ["v2", "v1", "v0"]
    assert R.listing(runs).first().training_date == "2024-01-03"


def test_approx_distinct_option(spark):
    tel = to_spark(spark, make_telemetry(3000, 400))
    fail = to_spark(spark, make_failures(10))
    exact = P.validation_summary(tel, fail).first().unique_machines
    approx = P.validation_summary(tel, fail, approx=True).first().unique_machines
    assert abs(approx - exact) <= 0.06 * exact
    assert P.ingest_stats(tel, fail, approx=True).first().unique_machines == approx


def test_register_run_replaces_same_version(spark):
    from maintspark.operators import evaluate as E
    runs = _registry(spark)
    scored = spark.createDataFrame([(0, 0.1, 0), (1, 0.9, 1), (1, 0.3, 0), (0, 0.7, 1)],
                                   "failure_within_window int, score double, prediction int")
    ev = E.evaluation_record(scored)
    once = R.register_run(runs, ev, "v9", "2024-02-01T00:00:00")
    twice = R.register_run(once, ev, "v9", "2024-02-02T00:00:00")
    rows = {r.version: r for r in twice.collect()}
    assert len(rows) == 4 and rows["v9"].status == "candidate" and rows["v9"].training_date == "2024-02-02T00:00:00"
    assert rows["v9"].auc_score == 0.75 and rows["v9"].precision == 0.5
    missing = R.register_run(runs, ev.select("model_name", "auc_score", "confusion_matrix",
                                            "business_metrics").limit(1), "v8", "2024-02-03T00:00:00")
    assert missing.count() == 4


def test_null_group_and_double_choice(spark):
    import pytest
    from maintspark.operators import runs as R
    rows = [("v1", 0.8, "2024-01-01", "active", None), ("v2", 0.9, "2024-01-02", "candidate", None),
            ("w1", 0.8, "2024-01-01", "active", "g"), ("w2", 0.9, "2024-01-02", "candidate", "g")]
    runs = spark.createDataFrame([(v, "m", a, 0.5, 0.5, d, s, None, g) for v, a, d, s, g in rows],
                                 "version string, model_name string, auc_score double, precision double, recall double, "
                                 f"training_date string, status string, deployment_date string, {R.GROUP} string")
    chosen = spark.createDataFrame([("v2", None)], f"version string, {R.GROUP} string")
    out = {r.version: r.status for r in R.promote(runs, chosen, "2024-02-01").collect()}
    assert out == {"v1": "retired", "v2": "active", "w1": "active", "w2": "candidate"}
    auto = R.auto_promote(runs, "2024-02-01")
    assert auto.count() == 4 and auto.filter("status = 'active'").count() == 2
    two = spark.createDataFrame([("w1", "g"), ("w2", "g")], f"version string, {R.GROUP} string")
    with pytest.raises(ValueError):
        R.promote(runs, two, "2024-02-01")


def test_missing_values_and_constant_sensors(spark):
    from maintspark.operators import profile as P
    nan = float("nan")
    df = spark.createDataFrame([(1, float(i), 5.0, float(i) if i % 3 else nan, -float(i)) for i in range(1, 31)],
                               "machineID long, volt double, rotate double, pressure double, vibration double")
    c = {(r.sensor_a, r.sensor_b): r["corr"] for r in P.correlation(df).collect()}
    assert abs(c["volt", "pressure"] - 1) < 1e-9 and abs(c["volt", "vibration"] + 1) < 1e-9 and c["volt", "volt"] == 1.0
    assert c["rotate", "rotate"] is None and c["volt", "rotate"] is None
    assert {r.sensor: r["count"] for r in P.iqr_outliers(df).collect()}["pressure"] == 0


def test_drift_without_rows_and_error_rows(spark):
    from pyspark.sql import functions as F
    from maintspark.operators import monitor as M
    log = spark.createDataFrame([("2024-01-01 00:00:00", 0.05), ("2024-01-01 00:01:00", 0.95), ("2024-01-01 00:02:00", -1.0),
                                 ("2024-01-01 01:00:00", -1.0)], "t string, failure_probability double") \
        .select(F.to_timestamp_ntz("t").alias("prediction_timestamp"), "failure_probability")
    hist = {r.le: r for r in M.confidence_histogram(log).collect()}
    assert hist["+Inf"].total_count == 2 and abs(hist["+Inf"].total_sum - 1.0) < 1e-9
    drift = M.windowed_drift(log, log).collect()
    assert len(drift) == 1 and abs(drift[0].js_divergence) < 1e-9
    assert M.drift_alerts(log, log.limit(0)).count() == 0
    none = M.histogram_drift(log.limit(0), log, ["failure_probability"]).collect()
    assert none[0].js_divergence is None
