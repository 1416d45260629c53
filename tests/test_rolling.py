import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import make_telemetry, rolling_oracle, to_spark
from maintspark import schemas as S
from maintspark.operators.rolling import feature_names, rolling_features, rolling_preview


def assert_frames_close(a: pd.DataFrame, b: pd.DataFrame, cols, tol=1e-9):
    a = a.sort_values(["machineID", "datetime"]).reset_index(drop=True)
    b = b.sort_values(["machineID", "datetime"]).reset_index(drop=True)
    for c in cols:
        x, y = a[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(x), np.isnan(y)), c
        m = ~np.isnan(x)
        assert np.allclose(x[m], y[m], rtol=0, atol=tol), c


def test_matches_pandas_with_nulls(spark):
    pdf = make_telemetry(1000, 10, nulls=0.3)
    out = rolling_features(to_spark(spark, pdf)).toPandas()
    exp = rolling_oracle(pdf)
    assert_frames_close(out, exp, S.feature_columns()[4:])


def test_null_counts_as_row_not_observation(spark):
    pdf = pd.DataFrame({"datetime": pd.date_range("2024-01-01", periods=4, freq="h"), "machineID": [1] * 4,
                        "volt": [1.0, np.nan, 3.0, np.nan], "rotate": 1.0, "pressure": 1.0, "vibration": 1.0})
    out = rolling_features(to_spark(spark, pdf), windows=[3]).orderBy("datetime").toPandas()
    std = out["volt_3h_std"].tolist()
    assert std[0] is None or math.isnan(std[0])
    assert std[1] is None or math.isnan(std[1])
    assert std[2] == pytest.approx(math.sqrt(2))
    assert std[3] is None or math.isnan(std[3])
    assert out["volt_3h_mean"].tolist()[3] == pytest.approx(3.0)


def test_window_one_is_identity_and_min_mean_max(spark):
    pdf = make_telemetry(300, 5)
    out = rolling_features(to_spark(spark, pdf), windows=[1, 24]).toPandas()
    for s in S.SENSORS:
        assert np.allclose(out[f"{s}_1h_mean"], out[s])
        assert (out[f"{s}_24h_min"] <= out[f"{s}_24h_mean"] + 1e-9).all()
        assert (out[f"{s}_24h_mean"] <= out[f"{s}_24h_max"] + 1e-9).all()


def test_one_row_machine(spark):
    pdf = pd.DataFrame({"datetime": [pd.Timestamp("2024-01-01")], "machineID": [7], "volt": [2.0], "rotate": [3.0],
                        "pressure": [4.0], "vibration": [5.0]})
    out = rolling_features(to_spark(spark, pdf)).first()
    assert out["volt_24h_mean"] == 2.0 and out["volt_24h_std"] is None and out["volt_3h_max"] == 2.0


def test_null_machine_id_gets_null_statistics(spark):
    pdf = make_telemetry(20, 2)
    df = to_spark(spark, pdf).withColumn("machineID", F.when(F.col("volt") > 150, None).otherwise(F.col("machineID")))
    out = rolling_features(df).filter(F.col("machineID").isNull()).select("volt_3h_mean").collect()
    assert out and all(r[0] is None for r in out)


def test_feature_order_and_names(spark):
    pdf = make_telemetry(50, 2)
    out = rolling_features(to_spark(spark, pdf))
    assert feature_names(out) == S.feature_columns()
    assert len(feature_names(out)) == 36


def test_preview_full_window(spark):
    pdf = make_telemetry(400, 3)
    out = rolling_preview(to_spark(spark, pdf), machine_id=1).orderBy("datetime").toPandas()
    exp = rolling_oracle(pdf[pdf.machineID == 1], full=True)
    exp = exp[[c for c in exp.columns if not c.endswith(("_max", "_min"))]]
    assert_frames_close(out, exp, [c for c in exp.columns if "h_" in c])
    assert out["volt_24h_mean"].isna().sum() == 23


def test_chunked_plan_equals_plain(spark):
    pdf = make_telemetry(2000, 3)
    df = to_spark(spark, pdf).withColumn("tie", F.monotonically_increasing_id())
    plain = rolling_features(df, tie="tie").toPandas()
    chunked = rolling_features(df, tie="tie", chunk_rows=50).toPandas()
    assert len(plain) == len(chunked) == 2000
    assert_frames_close(plain, chunked, S.feature_columns()[4:], tol=1e-9)


def test_ties_ordered_by_tie_column(spark):
    pdf = pd.DataFrame({"datetime": [pd.Timestamp("2024-01-01")] * 3, "machineID": [1, 1, 1],
                        "volt": [1.0, 2.0, 4.0], "rotate": 0.0, "pressure": 0.0, "vibration": 0.0, "tie": [3, 1, 2]})
    out = rolling_features(spark.createDataFrame(pdf), windows=[2], tie="tie").orderBy("tie").toPandas()
    # order by tie: 2.0 (tie 1), 4.0 (tie 2), 1.0 (tie 3)
    assert out["volt_2h_mean"].tolist() == [2.0, 3.0, 2.5]


@pytest.mark.parametrize("tie", [None, "tie"])
def test_chunked_plan_loses_no_row(spark, tie):
    """Four readings a time stamp, readings without time or machine, one busy burst."""
    rows = [(f"2024-01-01 {i // 40:02d}:{i // 4 % 10:02d}:00" if i % 17 else None, 1 + i % 2 if i % 23 else None, float(i), i) for i in range(800)]
    rows += [("2024-01-02 00:00:00", 3, float(i), 1000 + i) for i in range(600)]
    df = spark.createDataFrame(rows, "t string, machineID long, volt double, tie long") \
        .select(F.to_timestamp_ntz("t").alias("datetime"), "machineID", "volt", *[F.col("volt").alias(c) for c in ("rotate", "pressure", "vibration")], "tie")
    plain = rolling_features(df, tie=tie).toPandas()
    out = rolling_features(df, tie=tie, chunk_rows=100, keep_chunk=True).toPandas()
    assert len(out) == len(plain) == 1400 and sorted(out.tie) == sorted(plain.tie)
    sizes = out[out.machineID.notna()].groupby(["machineID", "_chunk"]).size()
    assert sizes.max() <= 200 and len(sizes) >= 13
    assert out[out.machineID.isna()].volt_3h_mean.isna().all()
    if tie:
        a, b = plain.sort_values("tie"), out.sort_values("tie")
        for c in S.feature_columns()[4:]:
            assert np.allclose(a[c], b[c], equal_nan=True, atol=1e-9), c


def test_feature_table_chunked_loses_no_row(spark):
    from maintspark.plans.features import filled_features
    pdf = make_telemetry(600, 2, nulls=0.3)
    pdf["datetime"] = pdf["datetime"].dt.floor("4h")
    df = to_spark(spark, pdf).withColumn("tie", F.monotonically_increasing_id())
    for tie in (None, "tie"):
        assert filled_features(df, tie=tie, chunk_rows=60).count() == 600
    a = filled_features(df, tie="tie", chunk_rows=None).toPandas().sort_values("tie")
    b = filled_features(df, tie="tie", chunk_rows=60).toPandas().sort_values("tie")
    for c in S.feature_columns():
        assert np.allclose(a[c], b[c], atol=1e-9), c
