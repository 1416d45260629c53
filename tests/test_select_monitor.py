import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import make_failures, make_telemetry, to_spark
from maintspark import schemas as S
from maintspark.operators import assign as AS
from maintspark.operators import monitor as M
from maintspark.operators import profile as P
from maintspark.operators import select as SEL
from maintspark.operators.labels import failure_labels
from maintspark.operators.rolling import rolling_features

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_head_tail_and_samples(spark):
    pdf = make_telemetry(300, 4).assign(tie=np.arange(300))
    df = spark.createDataFrame(pdf)
    assert [r.tie for r in SEL.head(df, 5, ["datetime", "tie"]).collect()] == [0, 1, 2, 3, 4]
    tail = SEL.tail_per_key(df, 3, "machineID", ["datetime", "tie"]).toPandas()
    exp = pdf.sort_values("datetime").groupby("machineID").tail(3)
    assert set(tail.tie) == set(exp.tie)
    a = SEL.hash_sample(df, 50, ["tie"]).toPandas()
    b = SEL.hash_sample(df, 50, ["tie"]).toPandas()
    assert len(a) == 50 and set(a.tie) == set(b.tie)                       # repeatable
    assert SEL.hash_sample(df, 5000, ["tie"]).count() == 300
    s = SEL.percent_sample(df, 10, ["tie"]).count()
    assert 10 <= s <= 60                                                    # ~10 % of 300


def test_traffic_split_arithmetic(spark):
    shares = AS.traffic_split(["a", "b", "c"], "new", 10)
    assert shares[0] == ("new", 10) and sum(p for _, p in shares) == 100
    assert [p for _, p in shares[1:]] == [30, 30, 30]
    shares = AS.traffic_split(["a", "b", "c"], "new", 11)                   # 89 // 3 = 29, leftover 2
    assert [p for _, p in shares] == [11, 31, 29, 29]
    keys = spark.range(2000).withColumnRenamed("id", "k")
    out = AS.assign_versions(keys, AS.split_table(spark, shares), "k")
    got = {r.version: r["count"] for r in out.groupBy("version").count().collect()}
    assert sum(got.values()) == 2000 and None not in got
    assert abs(got["new"] / 2000 - 0.11) < 0.04


def test_volume_alert_on_empty_hour_and_error_alert(spark):
    base = pd.Timestamp("2024-01-01")
    ts = [base + pd.Timedelta(minutes=m) for m in range(0, 60, 5)] + \
         [base + pd.Timedelta(hours=2, minutes=m) for m in range(0, 60, 5)]
    status = ["success"] * 12 + ["error"] * 2 + ["success"] * 10
    log = spark.createDataFrame(pd.DataFrame({"prediction_timestamp": ts, "status": status}))
    log = log.withColumn("prediction_timestamp", F.col("prediction_timestamp").cast("timestamp_ntz"))
    v = M.volume_alerts(log).orderBy("hour_start").toPandas()
    assert v.predictions.tolist() == [12, 0, 12] and v.alert.tolist() == [False, True, False]
    e = M.error_alerts(log).toPandas()
    # errors at 02:00 and 02:05: two consecutive 300 s windows above 5 %
    assert len(e) == 1 and e.window_start.iloc[0] == base + pd.Timedelta(hours=2, minutes=5)


def test_cumulative_histogram(spark):
    df = spark.createDataFrame([(0.05,), (0.15,), (0.5,), (0.95,)], "failure_probability double")
    h = {r.le: r.cumulative_count for r in M.confidence_histogram(df).collect()}
    assert h["0.1"] == 1 and h["0.5"] == 3 and h["1.0"] == 4 and h["+Inf"] == 4


@SETTINGS
@given(st.integers(min_value=0, max_value=10_000))
def test_js_divergence_of_equal_inputs_is_zero(spark, seed):
    pdf = make_telemetry(200, 3, seed=seed)
    df = to_spark(spark, pdf)
    out = M.histogram_drift(df, df, ["volt"], bins=20).first()
    assert out.js_divergence == pytest.approx(0.0, abs=1e-12) and out.drift_detected is False


@SETTINGS
@given(st.integers(min_value=0, max_value=10_000))
def test_labels_monotone_in_days_and_rolling_identity(spark, seed):
    tel, fail = make_telemetry(300, 3, seed=seed), make_failures(6, 3, seed=seed)
    st_, sf = to_spark(spark, tel), to_spark(spark, fail)
    n1 = failure_labels(st_, sf, days=1).agg(F.sum("failure_within_window")).first()[0]
    n3 = failure_labels(st_, sf, days=3).agg(F.sum("failure_within_window")).first()[0]
    n7 = failure_labels(st_, sf, days=7).agg(F.sum("failure_within_window")).first()[0]
    assert n1 <= n3 <= n7
    r = rolling_features(st_, windows=[1]).toPandas()
    assert np.allclose(r.volt_1h_mean, r.volt) and np.allclose(r.volt_1h_max, r.volt_1h_min)


@SETTINGS
@given(st.integers(min_value=0, max_value=10_000))
def test_shares_sum_to_100(spark, seed):
    fail = make_failures(40, 5, seed=seed)
    out = P.value_share(to_spark(spark, fail), "failure").agg(F.sum("percent")).first()[0]
    assert out == pytest.approx(100.0)
