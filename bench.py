"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row computed, nothing
collected). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import warnings

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
warnings.filterwarnings("ignore")


def baseline_comparisons(spark) -> dict:
    """
    label semi join 10,000 readings x 265 failures; MLlib forests on 10,000 rows x 36 features."""
    from pyspark.sql import functions as F
    from maintspark import schemas as S
    from maintspark.operators import train as TR
    from maintspark.operators.labels import failure_labels
    from maintspark.plans.features import feature_table
    from maintspark.sources import adapt as A
    ev = A.table(spark, "/root/testdata/sf0.01", "events")
    tel, fail = A.telemetry_from_events(ev), A.failures_from_events(ev)
    res = {}
    failure_labels(tel, fail).write.format("noop").mode("overwrite").save()
    t0 = time.time()
    failure_labels(tel, fail).write.format("noop").mode("overwrite").save()
    res["label_join_10k_x_265"] = {"sec": round(time.time() - t0, 3), "baseline_sec": 0.7}
    ft = feature_table(tel, fail, tie="tie").checkpoint(eager=True)
    for preset, key, base in (("small", "forest_20_trees_depth5_10k_rows", 3.2),
                              ("production", "forest_100_trees_depth12_10k_rows", 17.1)):
        t0 = time.time()
        TR.fit(ft, S.feature_columns(), preset=preset)
        res[key] = {"sec": round(time.time() - t0, 3), "baseline_sec": base}
    return res


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="maintspark-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    from maintspark.catalog import HEADLINE, queries
    from maintspark.session import local_session
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2),
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch})
    qs = queries()
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else list(HEADLINE)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    first, times = {}, {}
    # pass 1 warms the JVM (JIT, parquet footers, code generation); it is reported
    # apart as cold times. Then the best of `runs` warm runs per query.
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        first[name] = round(time.time() - t0, 3)
    for name in names:
        best = float("inf")
        for _ in range(runs):
            t0 = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - t0)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": int(cpus), "cold_queries": first, "timing": f"best of {runs} warm runs, noop sink"}
    if os.environ.get("BENCH_BASELINE", "1") == "1":
        out["baseline_comparisons"] = baseline_comparisons(spark)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
