"""Bracketed quantiles, counting joins, bucketed pre-failure moments and newest features, each
against a plain computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, make_failures, make_telemetry, to_spark
from maintspark import schemas as S
from maintspark.functions.expr import round_doubles
from maintspark.operators.labels import label_counts, label_pairs, marked_total
from maintspark.operators.prefailure import pre_failure_stats
from maintspark.operators.score import latest_per_key
from maintspark.plans import quantiles as Q
from maintspark.plans.features import feature_table, latest_features
from maintspark.sources import adapt as A


@pytest.mark.parametrize("pick_rows", [10, 300, 10**6])
def test_quantiles_equal_numpy(spark, pick_rows):
    rng = np.random.default_rng(3)
    n = 20_000
    cols = {"smooth": rng.normal(0, 1, n), "hot": np.where(rng.random(n) < 0.6, 7.0, rng.integers(0, 40, n)),
            "tail": rng.pareto(0.5, n), "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.random(n)), "one": np.full(n, 2.5),
            "steps": np.repeat([1.0, 2.0], n // 2)}
    df = spark.createDataFrame(pd.DataFrame(cols)).withColumn("nothing", F.lit(None).cast("double"))
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0]
    got = {(r.column, r.q): r.value for r in Q.quantiles(df, [*cols, "nothing"], probs, pick_rows=pick_rows).collect()}
    assert len(got) == len(cols) * len(probs)
    for c, v in cols.items():
        for q in probs:
            assert got[c, q] == pytest.approx(np.nanquantile(v, q), rel=1e-12, abs=1e-12), (c, q)


def test_a_wrong_bracket_is_widened(spark):
    wide = Q._numbers(spark.range(5000).select(F.col("id").cast("double").alias("v")), ["v"])
    t = Q._Target(0, 0.5, 5000, 10.0, 20.0)
    Q._narrow(wide, [t], {"_0": (0.0, 4999.0)}, 500)
    assert t.holds() and t.count <= 500
    assert Q._picked(wide, [t]).first()[1:] == (2499.0, 2500.0)


def test_describe_of_few_and_none(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (4.0, None)], "a double, b double")
    r = Q.describe(df, ["a", "b"]).collect()
    assert len(r) == 1 and tuple(r[0])[:1] + tuple(r[0])[1:3] + tuple(r[0])[4:] == ("a", 2, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert Q.describe(df.limit(0), ["a"]).count() == 0
    plan = Q.quantiles(spark.range(10**6).select(F.col("id").cast("double").alias("v")), ["v"], [0.5])._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan


def frames(spark, nulls=0.0):
    tel = make_telemetry(900, 4, nulls=nulls)
    tel["datetime"] = tel["datetime"].dt.floor("2h")  # equal times
    tel["tie"] = np.arange(len(tel))
    fail = make_failures(25, 4)
    fail = pd.concat([fail, fail.iloc[:3], fail.iloc[:4].assign(datetime=tel["datetime"].iloc[[300, 305, 310, 400]].to_numpy())])
    t, f = to_spark(spark, tel, T.StructType([*S.TELEMETRY.fields, T.StructField("tie", T.LongType())])), to_spark(spark, fail)
    none = t.limit(2).withColumn("machineID", F.lit(None).cast("long"))
    return t.unionByName(none).unionByName(t.limit(2).withColumn("datetime", F.lit(None).cast("timestamp_ntz"))), f


@pytest.mark.parametrize("hours", [1, 7, 24])
def test_counting_equals_pairs(spark, hours):
    t, f = frames(spark)
    pairs = label_pairs(t, f, 3, failure_cols=()).count()
    assert pairs > 200
    assert marked_total(t, f, 3, bucket_us=hours * 3_600_000_000).first()[0] == pairs
    assert marked_total(t, f.limit(0)).first()[0] == 0 and marked_total(t.limit(0), f).first()[0] == 0
    plan = label_counts(t, f)._jdf.queryExecution().optimizedPlan().toString()
    assert "failure_id" not in plan


@pytest.mark.parametrize("hours,nulls", [(1, 0.0), (5, 0.2), (24, 0.2)])
def test_pre_failure_stats_equal_pairs(spark, hours, nulls):
    t, f = frames(spark, nulls)
    t = t.withColumn("volt", F.lit(5.1))  # a constant has no deviation, whatever the merging
    order = F.struct("datetime", "tie")
    aggs = [F.count(F.lit(1)).alias("readings")]
    for s in S.SENSORS:
        aggs += [F.avg(s).alias(f"{s}_mean"), F.stddev_samp(s).alias(f"{s}_std"), (F.max_by(s, order) - F.min_by(s, order)).alias(f"{s}_trend")]
    exp = label_pairs(t, f, 3).groupBy("failure_id", "machineID", "failure_datetime", "failure").agg(*aggs).drop("failure_id") \
        .withColumnRenamed("failure", "failure_type")
    got = pre_failure_stats(t, f, 3, tie="tie", bucket_us=hours * 3_600_000_000)
    columns = [c for c in got.columns if c != "days_before"]
    assert got.count() == exp.count() > 8
    assert round_doubles(got.select(*columns)).exceptAll(round_doubles(exp.select(*columns))).count() == 0
    assert got.where("readings > 1").select(F.round("volt_std", 12)).distinct().collect() == [(0.0,)]
    assert pre_failure_stats(t, f.limit(0)).count() == 0 and pre_failure_stats(t.limit(0), f).count() == 0


@pytest.mark.parametrize("nulls", [0.0, 0.5])
def test_latest_features_equal_the_table(spark, nulls):
    pdf = make_telemetry(500, 9, nulls=nulls)
    pdf["tie"] = np.arange(len(pdf))
    pdf.loc[pdf.machineID == 3, "volt"] = np.nan  # told by the machine before
    t, f = to_spark(spark, pdf, T.StructType([*S.TELEMETRY.fields, T.StructField("tie", T.LongType())])), to_spark(spark, make_failures(20, 9))
    want = latest_per_key(feature_table(t, f, tie="tie", keep_tie=True), tie="tie").drop("tie")
    got = latest_features(t, f, tie="tie")
    assert got.columns == want.columns and got.count() == want.count() == 9
    assert round_doubles(got).exceptAll(round_doubles(want)).count() == 0


def test_latest_features_limit_before_the_shuffle(spark):
    ev = A.table(spark, SF_SMALL, "events")
    t = A.telemetry_from_events(ev)
    newest = latest_features(t, A.failures_from_events(ev), tie="tie")
    assert "WindowGroupLimit" in newest._jdf.queryExecution().toString()
