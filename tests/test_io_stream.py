import datetime
import glob
import json
import os
import shutil

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, make_telemetry, to_spark
from maintspark import schemas as S
from maintspark.functions.expr import round_doubles
from maintspark.operators.labels import failure_labels
from maintspark.operators.rolling import rolling_features
from maintspark.sources import adapt as A
from maintspark.sources import io as IO
from maintspark.catalog.streams import slices_of
from maintspark.streaming import stream as X


def write_csv_pair(folder):
    tel = make_telemetry(100, 5)
    tel.to_csv(os.path.join(folder, "telemetry.csv"), index=False)
    fail = pd.DataFrame({"datetime": ["2024-01-05", "2024-01-12", "2024-01-18"], "machineID": [1, 3, 2],
                         "failure": ["comp1", "comp2", "comp1"]})
    fail.to_csv(os.path.join(folder, "failures.csv"), index=False)
    return tel, fail


def test_csv_pair_with_date_only_strings(spark, scratch):
    tel, _ = write_csv_pair(scratch)
    t, f = IO.load_datasets(spark, scratch)
    assert t.count() == 100 and f.count() == 3
    assert f.orderBy("datetime").first().datetime == pd.Timestamp("2024-01-05").to_pydatetime()
    assert dict(zip(t.schema.names, [x.dataType.simpleString() for x in t.schema.fields]))["datetime"] == "timestamp_ntz"


def test_missing_file_raises(spark, scratch):
    with pytest.raises(FileNotFoundError):
        IO.load_datasets(spark, os.path.join(scratch, "nothing"))


def test_bad_rows_kept_apart(spark, scratch):
    p = os.path.join(scratch, "f.csv")
    with open(p, "w") as fh:
        fh.write("datetime,machineID,failure\n2024-01-05,1,comp1\nnot a date,2,comp2\n2024-01-07 10:00:00,x,comp3\n")
    good, bad = IO.read_failures_csv(spark, p)
    assert good.count() == 1 and bad.count() == 2


def test_runs_json_map_and_batch_requests(spark, scratch):
    reg = {f"v{i}": {"version": f"v{i}", "model_name": "Random Forest", "algorithm": "RandomForestClassifier",
                     "auc_score": 0.7844690520950787, "precision": 0.245, "recall": 0.634,
                     "training_date": f"2024-01-0{i + 1}T00:00:00", "training_samples": 0, "feature_count": 36,
                     "file_path": "m", "status": "candidate", "deployment_date": None, "notes": ""} for i in range(3)}
    p = os.path.join(scratch, "registry.json")
    with open(p, "w") as fh:
        json.dump(reg, fh, indent=2)
    runs = IO.read_runs_json(spark, p)
    assert runs.count() == 3 and runs.schema.names == S.MODEL_RUN.names
    b = os.path.join(scratch, "batch.json")
    with open(b, "w") as fh:
        fh.write(json.dumps({"predictions": [{"machineID": 1, "volt": 150.5, "rotate": 480.2, "pressure": 95.1,
                                              "vibration": 38.7},
                                             {"machineID": 2, "volt": 148.3, "rotate": 475.8, "pressure": 97.2,
                                              "vibration": 42.1}]}) + "\n")
    rows = IO.read_batch_requests(spark, b).collect()
    assert [r.machineID for r in rows] == [1, 2]


def test_stage_roundtrip_partitioned(spark, scratch):
    df = to_spark(spark, make_telemetry(100, 3))
    IO.write_stage(df, os.path.join(scratch, "stage"))
    back = IO.read_stage(spark, os.path.join(scratch, "stage"))
    assert back.count() == 100 and back.columns == df.columns


def _file_stream_dir(spark, df, folder, parts=4, order=("datetime", "tie")):
    tagged = df.withColumn("_part", F.ntile(parts).over(Window.orderBy(*order)))
    for i in range(1, parts + 1):
        tagged.filter(F.col("_part") == i).drop("_part").coalesce(1).write.parquet(f"{folder}/src/p{i}")
    os.makedirs(f"{folder}/flat")
    for i, f in enumerate(sorted(glob.glob(f"{folder}/src/p*/*.parquet"))):
        dst = f"{folder}/flat/{i:03d}.parquet"
        shutil.copy(f, dst)
        os.utime(dst, (1e9 + 100 * i, 1e9 + 100 * i))
    return f"{folder}/flat"


def test_rolling_stream_equals_batch_and_flags_late(spark, scratch):
    tel = A.telemetry_from_events(A.table(spark, SF_SMALL, "events"))
    src = _file_stream_dir(spark, tel, scratch)
    schema = spark.read.parquet(src).schema
    exp = rolling_features(spark.read.parquet(src), tie="tie")
    # a fifth file holds a late row: older than what machine 1 already emitted
    late = spark.read.parquet(src).filter("machineID = 1").orderBy("datetime").limit(1)
    late.coalesce(1).write.parquet(f"{scratch}/late")
    f = glob.glob(f"{scratch}/late/*.parquet")[0]
    shutil.copy(f, f"{src}/999.parquet")
    os.utime(f"{src}/999.parquet", (2e9, 2e9))
    st = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    h = X.run_to_table(X.rolling_stream(st, tie="tie"), "roll_t", f"{scratch}/ck")
    assert len(h.recentProgress) >= 5
    got = spark.table("roll_t")
    cols = exp.columns
    ok = got.filter("status = 'ok'").select(*cols)
    # a machine's kept readings are the state: 23 rows at most
    state = h.recentProgress[-1]["stateOperators"][0]["customMetrics"]
    assert state["numValuesTotal"] <= 23 * exp.select("machineID").distinct().count() if "numValuesTotal" in state else True
    assert ok.count() == exp.count()
    assert round_doubles(ok).exceptAll(round_doubles(exp.select(*cols))).count() == 0
    assert got.filter("status = 'late'").count() == 1


def test_label_stream_equals_batch(spark, scratch):
    """Every reading once: rows that repeat, and rows without a machine or time, too."""
    ev = A.table(spark, SF_SMALL, "events")
    fail = A.failures_from_events(ev)
    tel = A.telemetry_from_events(ev)
    odd = tel.limit(3)
    tel = tel.unionByName(odd).unionByName(odd.withColumn("machineID", F.lit(None).cast("long"))) \
        .unionByName(odd.withColumn("datetime", F.lit(None).cast("timestamp_ntz")))
    fail = fail.unionByName(fail.limit(2)).unionByName(fail.limit(1).withColumn("machineID", F.lit(None).cast("long")))
    closing = X.closing_rows(tel, fail)
    parts = [{"r": r, "f": f} for r, f in zip(slices_of(tel, "datetime", 2), slices_of(fail, "datetime", 2))]
    out, progress = X.follow([*parts, {"r": closing[0], "f": closing[1]}], f"{scratch}/labels",
                             lambda s: X.label_stream(s["r"], s["f"]), "labels")
    exp = failure_labels(tel, fail)
    assert out.columns == exp.columns and out.count() == exp.count() == tel.count()
    assert out.exceptAll(exp).count() == 0
    assert X.late_failures(out, fail).count() == 0
    # the state is empty but for the closing rows
    last = [o for o in progress[-1]["stateOperators"] if o["operatorName"] == "symmetricHashJoin"]
    assert sum(o["numRowsTotal"] for o in last) <= 2


def test_label_stream_gives_nothing_before_it_is_known(spark, scratch):
    at = lambda d, h: datetime.datetime(2024, 1, d, h)
    tel = spark.createDataFrame([(at(1, 0), 1, 1.0), (at(1, 1), 2, 2.0), (at(9, 0), 1, 3.0)], "datetime timestamp_ntz, machineID long, volt double")
    fail = spark.createDataFrame([(at(2, 0), 1), (at(9, 0), 3)], "datetime timestamp_ntz, machineID long")
    out, _ = X.follow([{"r": tel, "f": fail}], f"{scratch}/open", lambda s: X.label_stream(s["r"], s["f"]), "open")
    # machine 1's last reading may still fail by the twelfth
    assert sorted((r.machineID, r.volt, r.failure_within_window) for r in out.collect()) == [(1, 1.0, 1), (2, 2.0, 0)]
    missed = X.late_failures(out, spark.createDataFrame([(at(2, 0), 1), (at(3, 0), 2), (at(3, 0), 2)], fail.schema)).collect()
    assert [tuple(r) for r in missed] == [(2, at(3, 0), 2, 2)]


def test_rollup_stream_drops_late_rows(spark, scratch):
    base = pd.Timestamp("2024-01-01 00:00:00")
    rows = [(base + pd.Timedelta(seconds=60 * i), "LOW", "success", 0.01) for i in range(30)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["prediction_timestamp", "risk_level", "status",
                                                           "duration_seconds"]))
    df = df.withColumn("prediction_timestamp", F.col("prediction_timestamp").cast("timestamp_ntz"))
    df.coalesce(1).write.parquet(f"{scratch}/log/a")
    late = spark.createDataFrame([((base + pd.Timedelta(seconds=30)).to_pydatetime(), "HIGH", "error", 0.5)],
                                 "prediction_timestamp timestamp, risk_level string, status string, duration_seconds double")
    late = late.withColumn("prediction_timestamp", F.col("prediction_timestamp").cast("timestamp_ntz"))
    late.coalesce(1).write.parquet(f"{scratch}/log/c")
    more = df.limit(1).withColumn("prediction_timestamp",
                                  F.lit((base + pd.Timedelta(minutes=40)).to_pydatetime()).cast("timestamp_ntz"))
    more.coalesce(1).write.parquet(f"{scratch}/log/b")
    os.makedirs(f"{scratch}/logflat")
    # batch 1: 30 rows; batch 2: one row 40 min later (windows before it are emitted);
    # batch 3: a row for the first, already emitted window -> dropped
    for i, part in enumerate("abc"):
        f = glob.glob(f"{scratch}/log/{part}/*.parquet")[0]
        shutil.copy(f, f"{scratch}/logflat/{i}.parquet")
        os.utime(f"{scratch}/logflat/{i}.parquet", (1e9 + i * 100, 1e9 + i * 100))
    st = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/logflat")
    h = X.run_to_table(X.rollup_stream(st, watermark="1 minute"), "roll_log", f"{scratch}/ck3")
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in h.recentProgress for s in p["stateOperators"])
    assert dropped == 1
    out = spark.table("roll_log")
    assert out.agg(F.sum("errors")).first()[0] == 0
    first = out.filter(F.col("window_start") == F.lit(base.to_pydatetime())).first()
    assert first.requests == 5


@pytest.mark.parametrize("kept", [0, 1, 5, 23])
def test_window_statistics_equal_pandas(kept):
    rng = np.random.default_rng(kept)
    v = rng.normal(0, 5, (60, 3))
    v[rng.random(v.shape) < 0.3] = np.nan
    v[30:56, 1] = np.nan
    stats, windows = ["mean", "std", "max", "min"], [3, 24]
    want = pd.concat([getattr(pd.Series(v[:, j]).rolling(w, min_periods=1), st)() for w in windows for j in range(3) for st in stats], axis=1)
    got = X.window_statistics(v, kept, windows, stats)
    np.testing.assert_allclose(got, want.to_numpy()[kept:], rtol=1e-9, atol=1e-12)


def test_rolling_stream_resumes_and_keeps_little(spark, scratch):
    tel = A.telemetry_from_events(A.table(spark, SF_SMALL, "events")).where("machineID <= 6")
    tel = tel.unionByName(tel.where("machineID = 2").withColumn("machineID", F.lit(None).cast("long")))
    parts = [{"t": p} for p in slices_of(tel, "datetime", 3)]
    out, progress = X.follow(parts, f"{scratch}/roll", lambda s: X.rolling_stream(s["t"], tie="tie"), "roll")
    exp = rolling_features(tel, tie="tie")
    assert out.where("status = 'ok'").count() == out.count() == exp.count()
    diff = round_doubles(out.select(*exp.columns)).exceptAll(round_doubles(exp)).groupBy("machineID").count().collect()
    assert diff == []
    assert progress[-1]["stateOperators"][0]["customMetrics"]["rocksdbBytesCopied"] >= 0


def test_text_cells_stay_as_they_are(spark, scratch):
    with open(f"{scratch}/f.csv", "w") as f:
        f.write("datetime,machineID,failure\n2024-01-05,1,none\n2024-01-05,2,-\n2024-01-05,3, comp1 \n2024-01-05,4,NA\n2024-01-05, 5 ,\n2024-01-05,nan,x\n")
    good, bad = IO.read_failures_csv(spark, f"{scratch}/f.csv")
    assert [(r.machineID, r.failure) for r in good.collect()] == [(1, "none"), (2, "-"), (3, " comp1 "), (4, None), (5, None), (None, "x")]
    assert bad.count() == 0


def test_csv_file_stream(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for i in range(3):
        make_telemetry(50, 3, seed=i).to_csv(f"{scratch}/in/t{i}.csv", index=False)
    st = X.telemetry_stream(spark, f"{scratch}/in")
    X.run_to_table(st, "csv_t", f"{scratch}/ck4")
    assert spark.table("csv_t").count() == 150
    assert spark.table("csv_t").filter(F.col("datetime").isNull()).count() == 0


def test_parquet_sink_with_shared_checkpoint(spark, scratch):
    os.makedirs(f"{scratch}/csv")
    make_telemetry(40, 2).to_csv(f"{scratch}/csv/a.csv", index=False)
    q = X.start_to_parquet(X.telemetry_stream(spark, f"{scratch}/csv"), f"{scratch}/out", "tel_ingest_test",
                           checkpoint=f"{scratch}/ck_sink")
    q.awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == 40
    # a second file and a restart from the same checkpoint: only the new rows are added
    make_telemetry(10, 2, seed=5).to_csv(f"{scratch}/csv/b.csv", index=False)
    q = X.start_to_parquet(X.telemetry_stream(spark, f"{scratch}/csv"), f"{scratch}/out", "tel_ingest_test",
                           checkpoint=f"{scratch}/ck_sink")
    q.awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == 50


def test_stream_rollups_give_batch_drift_and_error_alerts(spark, scratch):
    from maintspark.operators import monitor as M
    log = A.prediction_log_from_events(A.table(spark, SF_SMALL, "events"))
    src = _file_stream_dir(spark, log.withColumnRenamed("request_id", "tie")
                           .withColumnRenamed("prediction_timestamp", "datetime"), scratch)
    back = spark.read.parquet(src).withColumnRenamed("datetime", "prediction_timestamp")
    st = (spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
          .withColumnRenamed("datetime", "prediction_timestamp"))
    X.run_to_table(X.rollup_stream(st, watermark="1 hour"), "rollup_x4", f"{scratch}/ck5")
    roll = spark.table("rollup_x4")
    assert roll.count() > 0
    base, _ = M.split_at_midpoint(back, "prediction_timestamp")
    got = M.drift_from_bins(roll, M.baseline_bins(base)).select("window_start", "js_divergence")
    exp = M.windowed_drift(back, base).join(roll.select("window_start"), "window_start", "left_semi")
    g = {r.window_start: r.js_divergence for r in got.collect()}
    e = {r.window_start: r.js_divergence for r in exp.collect()}
    assert g.keys() == e.keys() and all(abs(g[k] - e[k]) < 1e-12 for k in g)
    ga = M.error_alerts_from_rollups(roll).select("window_start").collect()
    last = roll.agg(F.max("window_start")).first()[0]
    ea = M.error_alerts(back).filter(F.col("window_start") <= F.lit(last)).select("window_start").collect()
    assert sorted(r[0] for r in ga) == sorted(r[0] for r in ea)


def test_rolling_stream_with_machine_fill_equals_batch(spark, scratch):
    from maintspark.operators.fill import frame_fill
    pdf = make_telemetry(400, 4, nulls=0.2)
    pdf["tie"] = np.arange(len(pdf))
    tel = to_spark(spark, pdf, T.StructType([*S.TELEMETRY.fields, T.StructField("tie", T.LongType())]))
    src = _file_stream_dir(spark, tel, scratch)
    st = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    X.run_to_table(X.rolling_stream(st, tie="tie", fill=True), "roll_fill", f"{scratch}/ck6")
    got = spark.table("roll_fill")
    rolled = rolling_features(spark.read.parquet(src), tie="tie")
    cols = [c for c in rolled.columns if c not in ("datetime", "machineID", "tie")]
    exp = frame_fill(rolled, cols, tie="tie", mode="machine")
    keep = exp.columns
    assert got.count() == exp.count() == 400
    assert round_doubles(got.select(*keep)).exceptAll(round_doubles(exp.select(*keep))).count() == 0


def test_small_helpers(spark, scratch):
    from maintspark.operators import select as SEL
    from maintspark.operators.rolling import feature_names_like
    from maintspark.plans.features import process_features
    body = json.dumps({"predictions": [{"machineID": 1, "volt": 160.0, "rotate": 440.0, "pressure": 95.0,
                                        "vibration": 35.0},
                                       {"machineID": 2, "volt": 180.0, "rotate": 480.0, "pressure": 110.0,
                                        "vibration": 50.0}]})
    rows = IO.explode_batch(spark.createDataFrame([(body,)], "predictions string")).collect()
    assert [(r.machineID, r.volt) for r in rows] == [(1, 160.0), (2, 180.0)]
    runs = spark.createDataFrame([("v1", "rf", "RandomForestClassifier", 0.8, 0.3, 0.6, "2024-01-01T00:00:00", 10, 36,
                                   "m", "active", None, "")], S.MODEL_RUN)
    IO.write_runs_jsonl(runs, f"{scratch}/runs")
    assert IO.read_runs_jsonl(spark, f"{scratch}/runs").collect() == runs.collect()
    tel = to_spark(spark, make_telemetry(100, 3))
    assert SEL.sensors_only(tel).columns == S.SENSORS
    assert SEL.machine(tel, 2).filter("machineID != 2").count() == 0
    ft, names = process_features(tel, to_spark(spark, pd.DataFrame(
        {"datetime": [pd.Timestamp("2024-01-03")], "machineID": [1], "failure": ["comp1"]})))
    assert names == S.feature_columns() and len(feature_names_like(ft, "_3h_")) == 16


def test_load_loses_no_row(spark, scratch):
    with open(os.path.join(scratch, "telemetry.csv"), "w") as f:
        f.write("datetime,machineID,volt,rotate,pressure,vibration\n2024-01-01 00:00:00,1,1.5,NA,3,4\n2024-01-01 02:00,1.0,,2,nan,4\n2024/01/02,2,1,2,3,4\n")
    with open(os.path.join(scratch, "failures.csv"), "w") as f:
        f.write("datetime,machineID,failure\n2024-01-05,1.0,comp1\n")
    t, f = IO.load_datasets(spark, scratch)
    rows = t.orderBy("datetime").collect()
    assert len(rows) == 3 and f.count() == 1
    assert rows[0].rotate is None and rows[1].volt is None and rows[1].pressure is None and rows[1].machineID == 1
    assert [r.datetime.hour for r in rows] == [0, 2, 0]
    with open(os.path.join(scratch, "telemetry.csv"), "a") as f:
        f.write("2024-01-03 00:00:00,1.5,1,2,3,4\n")
    with pytest.raises(ValueError, match="1.5"):
        IO.load_datasets(spark, scratch)


def test_stage_round_trip_keeps_columns(spark, scratch):
    path = os.path.join(scratch, "stage")
    df = to_spark(spark, make_telemetry(1000, 3))
    IO.write_stage(df, path)
    assert IO.read_stage(spark, path).columns == df.columns
    part = IO.read_stage(spark, path, "2024-02-01", "2024-02-10 12:00:00")
    assert part.count() == 9 * 24 + 12
    assert "PartitionFilters: [isnotnull(_stage_month" in part._jdf.queryExecution().toString()


def test_stage_keeps_its_own_month(spark, scratch):
    df = to_spark(spark, make_telemetry(100, 3)).withColumn("month", F.lit("mine"))
    IO.write_stage(df, f"{scratch}/stage")
    back = IO.read_stage(spark, f"{scratch}/stage")
    assert back.columns == df.columns and back.select("month").distinct().collect() == [("mine",)]


def test_stage_table_needs_no_exchange(spark, scratch):
    pdf = make_telemetry(2000, 7)
    pdf["month"] = "mine"
    df = spark.createDataFrame(pdf)
    df = df.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    name = IO.stage_name("t")
    IO.write_stage_table(df, name, f"{scratch}/t")
    table = spark.table(name)
    assert table.drop(IO.STAGE_MONTH).exceptAll(df).count() == 0 and table.count() == 2000
    rolled = rolling_features(table.drop(IO.STAGE_MONTH, "month"))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    assert round_doubles(rolled).exceptAll(round_doubles(rolling_features(df.drop("month")))).count() == 0
    some = table.where(F.col(IO.STAGE_MONTH) == "2024-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_stage_month" in some
    spark.sql(f"DROP TABLE {name}")
