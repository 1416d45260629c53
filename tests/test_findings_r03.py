"""The round's findings: plans that must not grow past the driver, the same rows by cheaper plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_failures, make_telemetry, to_spark
from maintspark import schemas as S


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pre_failure_windows_are_never_broadcast(spark):
    """A window is 71 rows a failure, which the size estimate of an exploded sequence leaves out."""
    from maintspark.operators.prefailure import pre_failure_stats
    tel = to_spark(spark, make_telemetry(500, 5)).withColumn("tie", F.monotonically_increasing_id())
    pre = pre_failure_stats(tel, to_spark(spark, make_failures(8, 5)), days=3, tie="tie")
    assert "Broadcast" not in plan_text(pre)
    assert pre.count() > 0


@pytest.mark.parametrize("min_periods", ["one", "full"])
def test_rolling_in_batches_is_a_window_without_windows(spark, min_periods):
    """Nulls, NaN, infinities, rows without machine or time, and batches shorter than a frame."""
    from maintspark.operators import rolling as RO
    df = to_spark(spark, make_telemetry(900, 4, nulls=0.2)).withColumn("tie", F.monotonically_increasing_id())
    odd = F.when(F.col("tie") % 97 == 1, float("nan")).when(F.col("tie") % 89 == 2, float("inf")).otherwise(F.col("volt"))
    df = (df.withColumn("volt", odd).withColumn("machineID", F.expr("nullif(machineID, 3)"))
            .withColumn("datetime", F.when(F.col("tie") % 31 != 4, F.col("datetime"))))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        out = RO.rolling_features(df, tie="tie", min_periods=min_periods)
        plan = plan_text(out)
        want = df.select("*", *RO.rolling_exprs(RO.default_spec(), S.SENSORS, ["machineID"], RO._order("datetime", "tie"), "machineID", min_periods))
        assert "MapInArrow" in plan and "stddev_samp" not in plan
        assert out.columns == want.columns and out.count() == want.count() == 900
        assert out.exceptAll(want).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_busy_rows_are_written_twice_not_four_times(spark, monkeypatch):
    from maintspark.operators import rolling as RO
    from maintspark.plans import ordered as OR
    written = []
    for m in (RO, OR):
        monkeypatch.setattr(m, "materialize", lambda df, name="table", keep=m.materialize: written.append(df.columns) or keep(df, name))
    df = to_spark(spark, make_telemetry(500, 3)).withColumn("tie", F.monotonically_increasing_id())
    monkeypatch.setattr(OR, "SINGLE_TASK_ROWS", 100)
    out = RO.rolling_features(df, tie="tie", chunk_rows=50)
    assert sum("volt" in c for c in written) == 2
    a, b = out.toPandas().sort_values("tie"), RO.rolling_features(df, tie="tie").toPandas().sort_values("tie")
    assert np.allclose(a[S.feature_columns()], b[S.feature_columns()], equal_nan=True, atol=1e-9)


def test_forest_keeps_the_nodes_of_rows(spark):
    """The rows' nodes are kept between levels, and the trees are those without it."""
    from pyspark.ml import Pipeline
    from maintspark.operators import train as TR
    assert TR.learner("production").getCacheNodeIds()
    x = spark.range(400, numPartitions=1).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 23).cast("double").alias("b"),
                                                 ((F.col("id") * 7) % 11 > 5).cast("double").alias(S.LABEL), F.lit(1.0).alias("weight"))
    kept, found = TR.learner("small"), TR.learner("small").setCacheNodeIds(False)
    trees = [Pipeline(stages=[TR.assembler(["a", "b"]), c]).fit(x).stages[-1].toDebugString.split("\n", 1)[1] for c in (kept, found)]
    assert trees[0] == trees[1]


@pytest.mark.parametrize("fill", [False, True])
def test_a_machine_of_a_stream_costs_no_frame_per_step(spark, scratch, monkeypatch, fill):
    """One machine's trigger: no sort of a frame, and one state row read and one written."""
    import pandas as pd
    from maintspark.streaming import stream as X

    class Cell:
        row, steps = None, 0

        def get(self):
            self.steps += 1
            return self.row

        def exists(self):
            return self.row is not None

        def update(self, row):
            self.steps += 1
            self.row = row

    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    cols = ["machineID", "datetime", "tie", *S.SENSORS]
    worker = X.RollingProcessor(list(S.SENSORS), list(S.WINDOWS), list(S.STATS), cols, "datetime", "tie", fill, None)
    worker.kept, worker.last = Cell(), Cell()
    rows = pd.DataFrame({"machineID": 1, "datetime": pd.date_range("2024-01-01", periods=40, freq="h"), "tie": range(40),
                         **{s: np.arange(40.0) for s in S.SENSORS}})
    first, = worker.handleInputRows((1,), iter([rows.iloc[[3, 1, 0, 2, *range(4, 30)]].reset_index(drop=True)]), None)
    assert worker.kept.steps == 2
    second, = worker.handleInputRows((1,), iter([rows.iloc[[29, 31, 30]].reset_index(drop=True)]), None)
    assert first["tie"].tolist() == list(range(30)) and second["tie"].tolist() == [30, 31, 29]
    assert second["status"].tolist() == ["ok", "ok", "late"]
    mean = np.stack(second["_told"])[:, worker.names.index("volt_3h_mean")]
    assert mean.tolist()[:2] == [29.0, 30.0] and np.isnan(mean[2])


def test_line_dedup_leaves_no_table_but_its_result(spark):
    """The tables of the steps go as soon as no step reads them, and all before the result is read."""
    import glob
    from maintspark.llm import line_dedup
    from maintspark.session import ensure_checkpoint_dir
    line = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, line), (2, line + "\n" + line.replace("six", "6")), (3, "x " + line)], "doc_id long, text string")
    ensure_checkpoint_dir(spark)
    seen = []
    real = line_dedup.write_table

    def watched(df, name):
        out = real(df, name)
        seen.append((name, {k for k, t in tables.items() if glob.glob(t)}))
        tables[name] = out.inputFiles()[0].replace("file:", "", 1).replace("//", "/") if out.inputFiles() else "-"
        return out

    tables = {}
    line_dedup.write_table = watched
    try:
        assert line_dedup.dropped_lines(docs).count() == 2
    finally:
        line_dedup.write_table = real
    left = dict(seen)
    assert "anchors" not in left["ranked"] and "candidates" not in left["per-document"]
    assert not left["bad-lines"] & {"ranked", "per-document", "neighbourhood", "least"}


def test_halves_of_lines_are_written_once():
    """Halves of equal length are one value, so that the tables of lines stay small."""
    import pyarrow as pa
    from maintspark.llm import line_dedup
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (9, 10, 11)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([1, 2, 3]), pa.array(texts)], names=["doc_id", "h", "text"])
    out = pa.Table.from_batches(list(line_dedup._occurrences(iter([batch]))))
    assert [[out[a][i].is_valid for a in line_dedup.HALVES] for i in range(3)] == [
        [False] * 4, [True] * 4, [True, False, True, False]]
