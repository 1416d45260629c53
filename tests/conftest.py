import os
import sys
import tempfile
import warnings

import numpy as np
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
warnings.filterwarnings("ignore", category=FutureWarning)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from maintspark.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="maintspark-test-", dir="/tmp")


def make_telemetry(n=1000, machines=10, seed=42, nulls=0.0):
    """Reference-style fixture: hourly rows over all machines, random machine per row."""
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({
        "datetime": pd.date_range("2024-01-01", periods=n, freq="h"),
        "machineID": rng.integers(1, machines + 1, n).astype("int64"),
        "volt": rng.normal(150, 10, n).round(2),
        "rotate": rng.normal(480, 20, n).round(2),
        "pressure": rng.normal(95, 5, n).round(2),
        "vibration": rng.normal(40, 8, n).round(2),
    })
    if nulls:
        for c in ["volt", "rotate", "pressure", "vibration"]:
            df.loc[rng.random(n) < nulls, c] = np.nan
    return df


def make_failures(n=10, machines=10, seed=7):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({
        "datetime": pd.date_range("2024-01-01", periods=n, freq="7D"),
        "machineID": rng.integers(1, machines + 1, n).astype("int64"),
        "failure": rng.choice(["comp1", "comp2", "comp3", "comp4"], n),
    })


def to_spark(spark, pdf, schema=None):
    from maintspark import schemas as S
    if schema is None:
        cols = list(pdf.columns)
        if cols == S.TELEMETRY.names:
            schema = S.TELEMETRY
        elif cols == S.FAILURES.names:
            schema = S.FAILURES
    df = spark.createDataFrame(pdf, schema=schema) if schema is not None else spark.createDataFrame(pdf)
    from maintspark.functions.expr import nan_to_null
    return nan_to_null(df)


def rolling_oracle(pdf, windows=(3, 24), full=False):
    """The survey's definition in plain loops: per machine the rows in time order; a statistic
    over the last ``w`` rows looks at their present values only (``full``: needs ``w`` of them)."""
    out = []
    for _, machine in sorted(pdf.groupby("machineID")):
        rows = machine.sort_values("datetime", kind="stable").to_dict("records")
        for at, row in enumerate(rows):
            row = dict(row)
            for w in windows:
                for sensor in ("volt", "rotate", "pressure", "vibration"):
                    seen = [r[sensor] for r in rows[max(0, at - w + 1):at + 1] if not np.isnan(r[sensor])]
                    enough = len(seen) >= (w if full else 1)
                    row[f"{sensor}_{w}h_mean"] = sum(seen) / len(seen) if enough else np.nan
                    row[f"{sensor}_{w}h_std"] = float(np.std(seen, ddof=1)) if enough and len(seen) > 1 else np.nan
                    row[f"{sensor}_{w}h_max"] = max(seen) if enough else np.nan
                    row[f"{sensor}_{w}h_min"] = min(seen) if enough else np.nan
            out.append(row)
    return pd.DataFrame(out)


def label_oracle(readings, failures, days):
    """1 for a reading with a failure of its machine after it, at most ``days`` later."""
    due = {}
    for machine, when in zip(failures["machineID"], failures["datetime"]):
        due.setdefault(machine, []).append(when)
    span = pd.Timedelta(days=days)
    return np.array([int(any(t < f <= t + span for f in due.get(m, ())))
                     for m, t in zip(readings["machineID"], readings["datetime"])])


def feature_oracle(tel, fail, days=3):
    """Rolling statistics, each column's last present value carried over machine borders, 0 before any; labels."""
    table = rolling_oracle(tel)
    for c in table.columns:
        if c in ("datetime", "machineID"):
            continue
        last, filled = 0.0, []
        for v in table[c]:
            last = last if np.isnan(v) else v
            filled.append(last)
        table[c] = filled
    table["failure_within_window"] = label_oracle(table, fail, days)
    return table
