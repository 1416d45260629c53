import importlib
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from maintspark import schemas as S
from maintspark.operators import train as TR
from maintspark.operators.rolling import rolling_features
from maintspark.operators.split import temporal_split
from maintspark.plans.features import feature_table
from maintspark.sources import adapt as A


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rolling_plan_one_exchange_on_machine(spark):
    tel = A.telemetry_from_events(A.table(spark, SF_SMALL, "events"))
    plan = plan_text(rolling_features(tel, tie="tie"))
    exchanges = re.findall(r"Exchange (\w+)", plan)
    assert exchanges == ["hashpartitioning"], plan
    assert "hashpartitioning(user_id" in plan or "hashpartitioning(machineID" in plan
    assert "SinglePartition" not in plan
    assert plan.count("Window [") <= 2     # one Window operator per frame spec


def test_feature_table_plan_no_single_partition_on_fact_table(spark):
    ev = A.table(spark, SF_SMALL, "events")
    ft = feature_table(A.telemetry_from_events(ev), A.failures_from_events(ev), tie="tie")
    plan = plan_text(ft)
    # the fact table is exchanged once, by machine; a SinglePartition exchange may only
    # feed the per-partition summary of the distributed scan (at most n rows)
    assert "Exchange hashpartitioning(machineID" in plan
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1]
            # only aggregates (one row per group/task), the scan's partition summaries, or every machine's last row
            assert "Aggregate" in child or "_scan_pid" in child or "_last_of_group" in "\n".join(lines[i + 1:i + 5]), child
    assert "BroadcastHashJoin" in plan
    # the scan reads only the columns the mapping needs, and the failure scan pushes its filter
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,error)" in plan


def test_scan_prunes_columns(spark):
    tel = A.telemetry_from_events(A.table(spark, SF_SMALL, "events")).select("machineID", "volt")
    plan = plan_text(tel)
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_small_forest_trains_and_scores(spark, scratch):
    ev = A.table(spark, SF_SMALL, "events")
    ft = feature_table(A.telemetry_from_events(ev), A.failures_from_events(ev), tie="tie", keep_tie=True)
    res = TR.train_job(ft, S.feature_columns(), out_dir=os.path.join(scratch, "model"), preset="small", tie="tie")
    ev_ = res["evaluation"]
    assert ev_["training_samples"] + ev_["test_samples"] == ft.count()
    assert ev_["auc_score"] is None or 0.0 <= ev_["auc_score"] <= 1.0
    imp = TR.importances(spark, res["model"], S.feature_columns()).collect()
    assert len(imp) == 36 and abs(sum(r.importance for r in imp) - 1.0) < 1e-6
    model, meta = TR.load_model(os.path.join(scratch, "model"))
    assert model is not None and meta["feature_names"] == S.feature_columns()
    info = TR.model_info(spark, meta).first()
    assert info.feature_count == 36 and len(info.top_features) == 10
    missing, _ = TR.load_model(os.path.join(scratch, "nope"))
    assert missing is None


def test_entry_and_registry_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(S.feature_columns()) <= set(df.columns)
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 70


def test_no_forbidden_calls_in_library():
    bad = []
    for dirpath, _, files in os.walk(os.path.join(ROOT, "maintspark")):
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(dirpath, f)).read()
                for pat in ("localCheckpoint", "crossJoin(", ".rdd.", "toPandas("):
                    if pat in text:
                        bad.append((f, pat))
    assert not bad, bad


def test_stream_scoring_equals_batch(spark, scratch):
    from maintspark.operators import score as SC
    from maintspark.streaming import stream as X
    ev = A.table(spark, SF_SMALL, "events")
    ft = feature_table(A.telemetry_from_events(ev), A.failures_from_events(ev), tie="tie")
    model = TR.fit(ft, S.feature_columns(), preset="small")
    readings = A.telemetry_from_events(ev).select("machineID", *S.SENSORS)
    readings.repartition(3).write.parquet(os.path.join(scratch, "readings"))
    src = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(
        os.path.join(scratch, "readings"))

    def scorer(df):
        return SC.score(model, SC.lone_reading_features(df), "2024-02-01 00:00:00")

    X.run_to_table(X.score_stream(src, scorer), "scored_t", os.path.join(scratch, "ck"))
    got = spark.table("scored_t")
    exp = scorer(spark.read.parquet(os.path.join(scratch, "readings")))
    assert got.count() == exp.count() == 1000
    assert got.exceptAll(exp).count() == 0


def test_presets_and_sinks(spark, scratch):
    from maintspark.operators import evaluate as E
    from maintspark.operators.report import summary_report, write_report
    from maintspark.sources import io as IO
    cloud = TR.learner("cloud")
    assert (cloud.getMaxDepth(), cloud.getMinInstancesPerNode(), cloud.isSet("weightCol")) == (10, 2, False)
    prod = TR.learner("production")
    assert (prod.getNumTrees(), prod.getMaxDepth(), prod.getOrDefault("weightCol"), prod.getSeed()) == \
        (100, 12, "weight", 42)
    gbt = TR.learner("boosting")
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize()) == (100, 8, 0.1)
    scored = spark.createDataFrame([(0, 0.1, 0), (1, 0.8, 1), (1, 0.4, 0), (0, 0.6, 1)],
                                   "failure_within_window int, score double, prediction int")
    ev = E.evaluation_record(scored)
    IO.write_evaluation_json(ev, os.path.join(scratch, "eval"))
    back = spark.read.json(os.path.join(scratch, "eval")).first()
    assert back.auc_score == 0.75 and back.confusion_matrix.true_positives == 1
    imp = spark.createDataFrame([("volt", 0.6), ("rotate", 0.4)], "feature string, importance double")
    rep = summary_report(ev, imp, "v1")
    lines = [r.line for r in rep.collect()]
    assert "ROC AUC: 0.7500" in lines and lines[-2:] == ["volt: 0.6000", "rotate: 0.4000"]
    write_report(rep, os.path.join(scratch, "report"))
    assert spark.read.text(os.path.join(scratch, "report")).count() == len(lines)


def test_auto_chunking_threshold(spark, monkeypatch):
    from maintspark.operators import rolling as RO
    tel = A.telemetry_from_events(A.table(spark, SF_SMALL, "events"))
    assert RO.auto_chunk_rows(tel, "machineID") is None
    assert RO.auto_chunk_rows(tel, "machineID", limit=10) == 10
    a = RO.rolling_features(tel, tie="tie").toPandas().sort_values("tie").reset_index(drop=True)
    monkeypatch.setattr(RO, "CHUNK_ROWS", 10)
    b = RO.rolling_features(tel, tie="tie", chunk_rows=RO.auto_chunk_rows(tel, "machineID", 10)).toPandas()
    b = b.sort_values("tie").reset_index(drop=True)
    assert ((a.volt_24h_std - b.volt_24h_std).abs().fillna(0) < 1e-9).all()


def test_hot_machine_is_split_into_chunks(spark):
    from maintspark.operators.rolling import rolling_features
    t = A.skewed_telemetry_from_lineitem(A.table(spark, "/root/testdata/sf0.01", "lineitem"))
    hot_rows = t.filter("machineID = 0").count()
    assert hot_rows > t.count() / 4                       # about a third of all rows
    r = rolling_features(t, tie=["tie", "tie2", "tie3"], chunk_rows=2000, keep_chunk=True)
    sizes = [row["count"] for row in r.filter("machineID = 0").groupBy("_chunk").count().collect()]
    assert len(sizes) >= hot_rows // 2000 and max(sizes) <= 2 * 2000
    assert r.filter("machineID != 0").agg(F.max("_chunk")).first()[0] == 0   # the rest stay whole


def test_chunked_plan_computes_heavy_window_once(spark):
    from maintspark.operators.rolling import rolling_features
    t = A.skewed_telemetry_from_lineitem(A.table(spark, "/root/testdata/sf0.01", "lineitem"))
    plan = plan_text(rolling_features(t, tie=["tie", "tie2", "tie3"], chunk_rows=2000))
    # two frames (3 and 24 rows), one pass: context rows travel with the chunk, nothing is redone
    assert plan.count("stddev_samp(volt") == 2


def test_session_helpers(spark):
    from maintspark.session import cluster_conf, ensure_checkpoint_dir, stream_checkpoint
    conf = cluster_conf(100 * (1 << 40))                      # 100 TB
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (64 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # at least two waves of tasks
    base = ensure_checkpoint_dir(spark)
    # the configured folder (Spark puts each context's checkpoints in a subfolder of it)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") in base
    # a restarted application finds the same folder, so it doesn't lie in Spark's own subfolder
    assert stream_checkpoint(spark, "x") == spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/streams/x"
