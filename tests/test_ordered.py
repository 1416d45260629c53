import numpy as np
import pandas as pd
import pytest

from conftest import make_telemetry, to_spark
from maintspark import schemas as S
from maintspark.operators import evaluate as E
from maintspark.operators import split as SP
from maintspark.operators.profile import sensor_describe
from maintspark.plans import ordered


@pytest.fixture()
def many_partitions(monkeypatch):
    """Force the range-partitioned path of the distributed scan on small inputs."""
    monkeypatch.setattr(ordered, "SINGLE_TASK_ROWS", 0)
    monkeypatch.setattr(ordered, "ROWS_PER_PARTITION", 700)


def test_row_index_and_running_sum(spark, many_partitions):
    rng = np.random.default_rng(11)
    n = 5000
    pdf = pd.DataFrame({"k": rng.permutation(n), "v": rng.integers(0, 10, n).astype(float)})
    pdf.loc[rng.random(n) < 0.3, "v"] = np.nan
    df = to_spark(spark, pdf, "k long, v double")
    idx = ordered.global_row_index(df, ["k"]).toPandas().sort_values("k")
    assert (idx.row_index.to_numpy() == np.arange(n)).all()
    out = ordered.global_scan(df.fillna(0.0), ["k"], sums=["v"]).toPandas().sort_values("k")
    assert np.allclose(out.v_cum.to_numpy(), pdf.sort_values("k").v.fillna(0).cumsum().to_numpy())
    car = ordered.global_scan(df, ["k"], carries=["v"]).toPandas().sort_values("k")
    exp = pdf.sort_values("k").v.shift(1).ffill()
    got = car.v_prev.to_numpy(dtype=float)
    assert np.array_equal(np.isnan(got), np.isnan(exp.to_numpy())) and np.allclose(got[~np.isnan(got)],
                                                                                    exp.dropna().to_numpy())


def test_split_auc_describe_through_distributed_scan(spark, many_partitions):
    rng = np.random.default_rng(2)
    n = 4001
    pdf = pd.DataFrame({"datetime": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 3, n), "D"),
                        "machineID": rng.integers(1, 4, n).astype("int64"), "tie": np.arange(n)})
    out = SP.temporal_split(spark.createDataFrame(pdf), tie="tie").toPandas()
    exp = pdf.sort_values(["datetime", "machineID", "tie"]).tie.iloc[:int(n * 0.8)]
    assert set(out[out.split == "train"].tie) == set(exp)
    y = rng.integers(0, 2, 3000)
    s = rng.random(3000).round(3)
    df = spark.createDataFrame(pd.DataFrame({"failure_within_window": y, "score": s}))
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert E.roc_auc(df).first().auc_score == pytest.approx(brute, abs=1e-12)
    tel = make_telemetry(3000, 5, nulls=0.1)
    d = {r.sensor: r for r in sensor_describe(to_spark(spark, tel)).collect()}
    assert d["volt"].p25 == pytest.approx(tel.volt.quantile(0.25), abs=1e-9)
    assert d["pressure"].p75 == pytest.approx(tel.pressure.quantile(0.75), abs=1e-9)
