"""Monitoring over a prediction log (T8), re-aimed from metric counters and
cloud alert rules to aggregations. The same expressions run on a stream
(``streaming.rollups``).

Drift (not defined in the reference, which delegates it): Jensen-Shannon
divergence, base 2 (0..1), of two histograms on shared equal-width bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import bucket_number, bucket_start
from ..plans.quantiles import long_values

# Fixed bucket bounds (parameters; the metrics library's defaults are not in the reference).
PROBABILITY_BOUNDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
LEVELS = ["LOW", "MEDIUM", "HIGH"]
MIN5_US = 300 * 1_000_000
HOUR_US = 3600 * 1_000_000


def scored(log: DataFrame, p: str = "failure_probability") -> DataFrame:
    """The rows that carry a probability: error rows (-1), NULL and NaN don't."""
    return log.filter((F.col(p) >= 0) & ~F.isnan(F.col(p).cast("double")))


def risk_level_counts(log: DataFrame) -> DataFrame:
    """O1: predictions per risk level; the total counts LOW+MEDIUM+HIGH only."""
    c = log.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))
    # over the grouped result: one row per risk level (LOW, MEDIUM, HIGH, ERROR)
    total = F.sum(F.when(F.col("risk_level").isin(*LEVELS), F.col("count")).otherwise(0)).over(Window.partitionBy())
    return c.select("risk_level", "count", total.cast("long").alias("total_predictions"))


def cumulative_histogram(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """O2/O3: cumulative ``le`` buckets (+Inf last) with count and sum, in one aggregation."""
    aggs = [F.count_if(F.col(value) <= F.lit(b)).alias(f"le_{i}") for i, b in enumerate(bounds)]
    aggs += [F.count(F.col(value)).alias("count"), F.sum(value).alias("sum")]
    wide = df.groupBy(*by).agg(*aggs)
    labels = [repr(float(b)) for b in bounds] + ["+Inf"]
    cells = [F.struct(F.lit(labels[i]).alias("le"), F.col(f"le_{i}").alias("cumulative_count"))
             for i in range(len(bounds))]
    cells.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("cumulative_count")))
    return wide.select(*by, F.explode(F.array(*cells)).alias("b"), "count", "sum").select(
        *by, "b.le", "b.cumulative_count", F.col("count").alias("total_count"), F.col("sum").alias("total_sum"))


def confidence_histogram(log: DataFrame, bounds: Sequence[float] = PROBABILITY_BOUNDS) -> DataFrame:
    """O2: histogram of failure probabilities; error rows (probability -1) have none."""
    return cumulative_histogram(scored(log), "failure_probability", bounds)


def request_counts(log: DataFrame) -> DataFrame:
    """O3: requests by method, endpoint and status."""
    return log.groupBy("method", "endpoint", "status").agg(F.count(F.lit(1)).alias("requests"))


def duration_histogram(log: DataFrame, bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """O3: request duration histogram per endpoint."""
    return cumulative_histogram(log, "duration_seconds", bounds, by=["endpoint"])


def _js(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """JS divergence per ``by`` group from rows (by..., bin, b, c) of bin counts."""
    w = Window.partitionBy(*by)     # one group = at most `bins` rows
    # a side without rows has no distribution: its shares, and the divergence, are NULL
    p = F.try_divide(F.col("b"), F.sum("b").over(w))
    q = F.try_divide(F.col("c"), F.sum("c").over(w))
    t = counts.select(*by, p.alias("p"), q.alias("q"))
    m = (F.col("p") + F.col("q")) / 2.0
    term = (F.when(F.col("p") > 0, F.col("p") * F.log2(F.col("p") / m)).otherwise(0.0)
            + F.when(F.col("q") > 0, F.col("q") * F.log2(F.col("q") / m)).otherwise(0.0))
    term = F.when(F.col("p").isNotNull() & F.col("q").isNotNull(), term)
    return t.groupBy(*by).agg((F.sum(term) * 0.5).alias("js_divergence"))


def histogram_drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 50,
                    threshold: float = S.DRIFT_THRESHOLD, name: str = "feature") -> DataFrame:
    """Per column, JS divergence of baseline vs current on shared bins between the
    overall min and max; ``drift_detected`` when above ``threshold``."""
    vals = (long_values(baseline, columns, name).withColumn("_side", F.lit(0))
            .unionByName(long_values(current, columns, name).withColumn("_side", F.lit(1))))
    bounds = vals.groupBy(name).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(1.0))
    idx = F.least(F.floor((F.col("value") - F.col("lo")) * F.lit(float(bins)) / width), F.lit(bins - 1)).cast("int")
    counts = (vals.join(F.broadcast(bounds), name)       # one row per column
                  .groupBy(name, idx.alias("bin"))
                  .agg(F.count_if(F.col("_side") == 0).alias("b"), F.count_if(F.col("_side") == 1).alias("c")))
    js = _js(counts, [name])
    return js.select(name, "js_divergence", F.lit(float(threshold)).alias("threshold"),
                     (F.col("js_divergence") > F.lit(threshold)).alias("drift_detected"))


def split_at_midpoint(df: DataFrame, time: str) -> tuple[DataFrame, DataFrame]:
    """(rows before, rows from) the midpoint of the time span: baseline vs current."""
    from ..functions.expr import epoch_micros
    e = epoch_micros(time)
    mid = df.agg(F.min(e).alias("_lo"), F.max(e).alias("_hi")).select(F.expr("(_lo + _hi) div 2").alias("_mid"))
    tagged = df.withColumn("_one", F.lit(1)).join(F.broadcast(mid.withColumn("_one", F.lit(1))), "_one")
    before = tagged.filter(epoch_micros(time) < F.col("_mid")).drop("_one", "_mid")
    after = tagged.filter(epoch_micros(time) >= F.col("_mid")).drop("_one", "_mid")
    return before, after


def windowed_drift(log: DataFrame, baseline: DataFrame, value: str = "failure_probability",
                   time: str = "prediction_timestamp", window_us: int = MIN5_US, bins: int = 10) -> DataFrame:
    """JS divergence of every time window's distribution of ``value`` (fixed bins on
    [0, 1]) against the baseline distribution; windows without rows have no value."""
    idx = probability_bin(value, bins)
    log, baseline = scored(log, value), scored(baseline, value)
    base = baseline.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("b"))
    per = log.groupBy(bucket_number(time, window_us).alias("_w"), idx.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    # Every window needs all baseline bins (also those it lacks): spine of windows x bins.
    windows = per.select("_w").distinct()
    # base has at most `bins` rows: broadcast on a constant key (windows x bins)
    grid = (windows.withColumn("_one", F.lit(1))
                   .join(F.broadcast(base.withColumn("_one", F.lit(1))), "_one").drop("_one"))
    full = (grid.join(per, ["_w", "bin"], "full_outer")
                .select("_w", "bin", F.coalesce("b", F.lit(0)).alias("b"), F.coalesce("c", F.lit(0)).alias("c")))
    js = _js(full, ["_w"])
    return js.select(bucket_start("_w", window_us).alias("window_start"), "js_divergence")


def drift_alerts(log: DataFrame, baseline: DataFrame, threshold: float = S.DRIFT_THRESHOLD,
                 window_us: int = MIN5_US) -> DataFrame:
    """300 s windows whose drift is above the threshold."""
    d = windowed_drift(log, baseline, window_us=window_us)
    return d.filter(F.col("js_divergence") > F.lit(threshold)).withColumn("threshold", F.lit(float(threshold)))


def volume_alerts(log: DataFrame, time: str = "prediction_timestamp", minimum: int = S.VOLUME_MIN_PER_HOUR,
                  window_us: int = HOUR_US) -> DataFrame:
    """Hourly prediction counts on an hour spine (empty hours count 0 and alert)."""
    n = bucket_number(time, window_us)
    counts = log.groupBy(n.alias("_w")).agg(F.count(F.lit(1)).alias("predictions"))
    span = log.agg(F.min(n).alias("lo"), F.max(n).alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi")).alias("_w"))
    out = spine.join(counts, "_w", "left").select(
        bucket_start("_w", window_us).alias("hour_start"),
        F.coalesce(F.col("predictions"), F.lit(0)).cast("long").alias("predictions"))
    return out.withColumn("alert", F.col("predictions") < F.lit(minimum))


def error_alerts(log: DataFrame, time: str = "prediction_timestamp", threshold: float = S.ERROR_RATE_THRESHOLD,
                 window_us: int = MIN5_US) -> DataFrame:
    """Error share above ``threshold`` in two consecutive windows (600 s). The
    previous window is found by an equi-join on window number - 1, not a global lag."""
    n = bucket_number(time, window_us)
    rate = log.groupBy(n.alias("_w")).agg(F.count(F.lit(1)).alias("requests"),
                                          F.count_if(F.col("status") == "error").alias("errors"))
    rate = rate.withColumn("error_rate", F.col("errors") / F.col("requests")).filter(F.col("error_rate") > threshold)
    prev = rate.select((F.col("_w") + 1).alias("_w"), F.col("error_rate").alias("previous_error_rate"))
    return (rate.join(prev, "_w")
                .select(bucket_start("_w", window_us).alias("window_start"), "requests", "errors", "error_rate",
                        "previous_error_rate"))


def monitoring_series(log: DataFrame, baseline: DataFrame, time: str = "prediction_timestamp") -> DataFrame:
    """Dashboard series in long form (series, window_start, value): volume and mean
    latency per 300 s, drift per 3600 s."""
    n = bucket_number(time, MIN5_US)
    five = log.groupBy(n.alias("_w")).agg(F.count(F.lit(1)).cast("double").alias("volume"),
                                          F.avg("duration_seconds").alias("latency"))
    five_long = five.select(bucket_start("_w", MIN5_US).alias("window_start"),
                            F.explode(F.array(F.struct(F.lit("volume_5m").alias("series"), F.col("volume").alias("value")),
                                              F.struct(F.lit("latency_5m").alias("series"),
                                                       F.col("latency").alias("value")))).alias("s"))
    five_long = five_long.select("s.series", "window_start", "s.value")
    drift = windowed_drift(log, baseline, window_us=HOUR_US).select(
        F.lit("drift_1h").alias("series"), "window_start", F.col("js_divergence").alias("value"))
    return five_long.unionByName(drift)


# ---------------------------------------------------------------- rollup-based forms
# The stream rollup (``streaming.rollup_stream``) keeps per-window bin counts of the
# probability, so drift per window is a projection of the rollup row and error alerts a
# join of the rollup table with itself -- the same numbers as the batch operators above.
PROB_BINS = 10


def probability_bin(p, bins: int = PROB_BINS):
    """Bin number, both ends clamped; NULL for rows without a probability (errors)."""
    return F.when((F.col(p) >= 0) & ~F.isnan(F.col(p).cast("double")),
                  F.greatest(F.least(F.floor(F.col(p) * F.lit(float(bins))), F.lit(bins - 1)), F.lit(0))).cast("int")


def bin_count_columns(p: str = "failure_probability", bins: int = PROB_BINS) -> list:
    b = probability_bin(p, bins)
    return [F.count_if(b == F.lit(i)).alias(f"p_bin_{i}") for i in range(bins)]


def baseline_bins(baseline: DataFrame, p: str = "failure_probability", bins: int = PROB_BINS) -> DataFrame:
    """One row: the baseline's count per probability bin (``base_bin_i``)."""
    return baseline.agg(*[c.alias(f"base_bin_{i}") for i, c in enumerate(bin_count_columns(p, bins))])


def drift_from_bins(rollups: DataFrame, base: DataFrame, bins: int = PROB_BINS,
                    threshold: float = S.DRIFT_THRESHOLD) -> DataFrame:
    """O6 on rollup rows: JS divergence of each window's bin counts vs the baseline's
    (one-row broadcast join; also valid on a stream: a stream-static join)."""
    j = rollups.withColumn("_one", F.lit(1)).join(F.broadcast(base.withColumn("_one", F.lit(1))), "_one")
    btot = sum(F.col(f"base_bin_{i}") for i in range(bins))
    ctot = sum(F.col(f"p_bin_{i}") for i in range(bins))
    terms = []
    for i in range(bins):
        p = F.try_divide(F.col(f"base_bin_{i}"), btot)
        q = F.try_divide(F.col(f"p_bin_{i}"), ctot)
        m = (p + q) / 2.0
        terms.append(F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0))
    js = F.when((btot > 0) & (ctot > 0), sum(terms) * 0.5)
    return j.select(*[c for c in rollups.columns], js.alias("js_divergence"),
                    (js > F.lit(threshold)).alias("drift_alert"))


def error_alerts_from_rollups(rollups: DataFrame, threshold: float = S.ERROR_RATE_THRESHOLD,
                              window_us: int = MIN5_US) -> DataFrame:
    """O8 on rollup rows (window_start, requests, errors): two consecutive windows above."""
    n = bucket_number("window_start", window_us)
    above = (rollups.withColumn("_w", n).withColumn("error_rate", F.col("errors") / F.col("requests"))
                    .filter(F.col("error_rate") > threshold))
    prev = above.select((F.col("_w") + 1).alias("_w"), F.col("error_rate").alias("previous_error_rate"))
    return above.join(prev, "_w").select("window_start", "requests", "errors", "error_rate", "previous_error_rate")
