import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import feature_oracle, label_oracle, make_failures, make_telemetry, to_spark
from maintspark import schemas as S
from maintspark.operators.fill import align_features, frame_fill
from maintspark.operators.labels import failure_labels, label_counts, label_pairs
from maintspark.operators.rolling import rolling_features
from maintspark.plans.features import feature_table


def test_feature_table_equals_oracle(spark):
    tel, fail = make_telemetry(1000, 10, nulls=0.2), make_failures(10, 10)
    out = feature_table(to_spark(spark, tel), to_spark(spark, fail)).toPandas()
    exp = feature_oracle(tel, fail)
    out = out.sort_values(["machineID", "datetime"]).reset_index(drop=True)
    exp = exp.sort_values(["machineID", "datetime"]).reset_index(drop=True)
    assert list(out.columns) == list(exp.columns)
    for c in S.feature_columns():
        assert np.allclose(out[c].to_numpy(float), exp[c].to_numpy(float), atol=1e-9), c
    assert (out["failure_within_window"].to_numpy() == exp["failure_within_window"].to_numpy()).all()


def test_frame_fill_carries_across_machines(spark):
    pdf = pd.DataFrame({"datetime": pd.to_datetime(["2024-01-01"] * 2 + ["2024-01-02"] * 2),
                        "machineID": [1, 2, 1, 2], "v": [5.0, np.nan, np.nan, 7.0]})
    df = to_spark(spark, pdf, "datetime timestamp_ntz, machineID long, v double")
    frame = {r.machineID * 10 + r.datetime.day: r.v for r in frame_fill(df, ["v"]).collect()}
    # sorted frame: (1,d1)=5, (1,d2)=NULL->5, (2,d1)=NULL->5 (carried from machine 1), (2,d2)=7
    assert frame == {11: 5.0, 12: 5.0, 21: 5.0, 22: 7.0}
    mach = {r.machineID * 10 + r.datetime.day: r.v for r in frame_fill(df, ["v"], mode="machine").collect()}
    assert mach[21] == 0.0


def test_first_row_null_becomes_zero(spark):
    pdf = pd.DataFrame({"datetime": pd.to_datetime(["2024-01-01", "2024-01-02"]), "machineID": [1, 1],
                        "v": [np.nan, 3.0]})
    df = to_spark(spark, pdf, "datetime timestamp_ntz, machineID long, v double")
    assert [r.v for r in frame_fill(df, ["v"]).orderBy("datetime").collect()] == [0.0, 3.0]


def test_label_boundaries(spark):
    f = pd.Timestamp("2024-01-10 12:00:00")
    h = pd.Timedelta(hours=72)
    us = pd.Timedelta(microseconds=1)
    times = [f, f - us, f - h, f - h - us, f + us]
    tel = pd.DataFrame({"datetime": times, "machineID": [1] * 5, "volt": 1.0, "rotate": 1.0, "pressure": 1.0,
                        "vibration": 1.0})
    fail = pd.DataFrame({"datetime": [f], "machineID": [1], "failure": ["comp1"]})
    out = failure_labels(to_spark(spark, tel), to_spark(spark, fail)).toPandas()
    got = dict(zip(out.datetime, out.failure_within_window))
    assert got == {f: 0, f - us: 1, f - h: 1, f - h - us: 0, f + us: 0}


def test_labels_equal_brute_force_for_any_bucket(spark):
    rng = np.random.default_rng(3)
    n = 3000
    tel = pd.DataFrame({"datetime": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 60 * 86400, n), "s"),
                        "machineID": rng.integers(1, 6, n).astype("int64"), "volt": 1.0, "rotate": 1.0,
                        "pressure": 1.0, "vibration": 1.0})
    fail = pd.DataFrame({"datetime": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 60 * 86400, 40), "s"),
                         "machineID": rng.integers(1, 6, 40).astype("int64"), "failure": "comp1"})
    fail = pd.concat([fail, fail.iloc[:3]])          # duplicate failures
    exp3, exp7 = label_oracle(tel, fail, 3), label_oracle(tel, fail, 7)
    st, sf = to_spark(spark, tel), to_spark(spark, fail)
    for bucket in (None, 3_600_000_000, 7 * 3_600_000_000):
        out = failure_labels(st, sf, days=3, bucket_us=bucket).toPandas()
        got = out.set_index(["machineID", "datetime"])["failure_within_window"]
        exp = pd.Series(exp3, index=pd.MultiIndex.from_frame(tel[["machineID", "datetime"]]))
        assert (got.loc[exp.index].to_numpy() == exp.to_numpy()).all()
    out7 = failure_labels(st, sf, days=7).toPandas()
    assert out7.failure_within_window.sum() == exp7.sum() >= exp3.sum()   # monotone in days
    # the shuffle path (no broadcast) gives the same labels
    out_sh = failure_labels(st, sf, days=3, broadcast_rows=0).toPandas()
    assert out_sh.failure_within_window.sum() == exp3.sum()


def test_pairs_and_counts(spark):
    tel = pd.DataFrame({"datetime": pd.to_datetime(["2024-01-01 00:00", "2024-01-02 00:00", "2024-01-05 00:00"]),
                        "machineID": [1, 1, 1], "volt": 1.0, "rotate": 1.0, "pressure": 1.0, "vibration": 1.0})
    fail = pd.DataFrame({"datetime": pd.to_datetime(["2024-01-03 00:00", "2024-01-03 12:00", "2024-03-01 00:00"]),
                         "machineID": [1, 1, 2], "failure": ["comp1", "comp2", "comp3"]})
    st, sf = to_spark(spark, tel), to_spark(spark, fail)
    assert label_pairs(st, sf).count() == 4          # two overlapping failures x two readings
    c = label_counts(st, sf).first()
    assert (c.marked_total, c.positive_rows, c.total_rows) == (4, 2, 3)


def test_empty_failures_and_empty_telemetry(spark):
    tel, fail = make_telemetry(50, 2), make_failures(3, 2)
    st, sf = to_spark(spark, tel), to_spark(spark, fail)
    assert failure_labels(st, sf.limit(0)).agg(F.sum("failure_within_window")).first()[0] == 0
    assert failure_labels(st.limit(0), sf).count() == 0


def test_align_features_adds_missing_as_zero(spark):
    df = spark.createDataFrame([(1, 2.0)], "machineID long, volt double")
    out = align_features(df, ["rotate", "volt"], keep=["machineID"]).first()
    assert out.asDict() == {"machineID": 1, "rotate": 0.0, "volt": 2.0}


def test_two_failures_same_time_are_two_rows(spark):
    from maintspark.operators.prefailure import pre_failure_stats
    tel = make_telemetry(500, 2)
    t = pd.Timestamp("2024-01-10")
    fail = pd.DataFrame({"datetime": [t, t], "machineID": [1, 1], "failure": ["comp1", "comp2"]})
    out = pre_failure_stats(to_spark(spark, tel), to_spark(spark, fail)).toPandas()
    assert len(out) == 2 and set(out.failure_type) == {"comp1", "comp2"}
    win = tel[(tel.machineID == 1) & (tel.datetime >= t - pd.Timedelta(days=3)) & (tel.datetime < t)]
    assert out.readings.iloc[0] == len(win)
    assert np.isclose(out.volt_mean.iloc[0], win.volt.mean())
    assert np.isclose(out.volt_trend.iloc[0], win.volt.iloc[-1] - win.volt.iloc[0])


def test_feature_table_chunked_and_tail_paths_equal_reference(spark):
    # long trailing sensor outage on one machine forces the whole-history fallback
    tel, fail = make_telemetry(1500, 4, nulls=0.1), make_failures(10, 4)
    last_m1 = tel.index[tel.machineID == 1][-60:]
    tel.loc[last_m1, "volt"] = np.nan
    exp = feature_oracle(tel, fail).sort_values(["machineID", "datetime"]).reset_index(drop=True)
    st, sf = to_spark(spark, tel), to_spark(spark, fail)
    for kw in ({"carry": "tail"}, {"carry": "aggregate"}, {"chunk_rows": 100}):
        out = feature_table(st, sf, **kw).toPandas().sort_values(["machineID", "datetime"]).reset_index(drop=True)
        assert list(out.columns) == list(exp.columns), kw
        for c in S.feature_columns():
            assert np.allclose(out[c].to_numpy(float), exp[c].to_numpy(float), atol=1e-9), (kw, c)


def test_feature_table_all_null_sensors_match_reference(spark):
    tel, fail = make_telemetry(800, 5, nulls=0.05), make_failures(8, 5)
    tel.loc[tel.machineID == 3, "volt"] = np.nan          # a machine whose sensor is always null
    tel.loc[tel.machineID == 1, "rotate"] = np.nan        # the first machine: rotate always null
    first = tel.sort_values(["machineID", "datetime"]).index[0]
    tel.loc[first, "pressure"] = np.nan                   # null first reading
    exp = feature_oracle(tel, fail).sort_values(["machineID", "datetime"]).reset_index(drop=True)
    st, sf = to_spark(spark, tel), to_spark(spark, fail)
    for kw in ({"carry": "tail"}, {"carry": "aggregate"}, {"chunk_rows": 60}):
        out = feature_table(st, sf, **kw).toPandas().sort_values(["machineID", "datetime"]).reset_index(drop=True)
        for c in S.feature_columns():
            assert np.allclose(out[c].to_numpy(float), exp[c].to_numpy(float), atol=1e-9), (kw, c)


def test_feature_table_missing_times_sort_last_like_pandas(spark):
    tel, fail = make_telemetry(900, 4, nulls=0.05), make_failures(8, 4)
    rng = np.random.default_rng(4)
    tel.loc[rng.random(len(tel)) < 0.05, "datetime"] = pd.NaT
    exp = feature_oracle(tel, fail).sort_values(["machineID", "datetime"], na_position="last")
    # pandas keeps file order among equal keys: the file position is the tie
    st = to_spark(spark, tel).withColumn("tie", F.monotonically_increasing_id())
    sf = to_spark(spark, fail)
    for kw in ({"carry": "tail"}, {"carry": "aggregate"}, {"chunk_rows": 60}):
        out = feature_table(st, sf, tie="tie", **kw).toPandas()
        # compare as multisets of rows (rows with a missing time have no other order key)
        cols = S.feature_columns() + ["failure_within_window"]
        a = np.round(out.sort_values(["machineID", "datetime"], na_position="last")[cols].to_numpy(float), 6)
        b = np.round(exp[cols].to_numpy(float), 6)
        a = a[np.lexsort(a.T[::-1])]
        b = b[np.lexsort(b.T[::-1])]
        assert np.allclose(a, b, atol=1e-6), kw
