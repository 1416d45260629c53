"""Sensor behaviour in the days before each failure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import add_micros, epoch_micros
from ..plans.sizing import materialize
from .labels import DAY_US, HOUR_US


def _ties(tie) -> list[str]:
    return [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))


def _shuffled(df: DataFrame) -> DataFrame:
    """A side that grows with the failures: its joins move rows between tasks, none goes through the driver."""
    return df.hint("merge")


def _moments(sensors: Sequence[str], over=None) -> list:
    """Count of readings, and per sensor count, mean and summed squared deviations."""
    on = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    return [on(F.count("_r")).alias("n"),
            F.array(*[F.struct(on(F.count(s)).alias("n"), on(F.avg(s)).alias("mean"),
                               (on(F.var_pop(s)) * on(F.count(s))).alias("m2")) for s in sensors]).alias("m")]


def _merge(parts: Sequence[str], i: int):
    """(n, mean, m2) of one sensor over the parts of a window: exact where all values are equal."""
    own = F.transform(parts, lambda x: x["m"][i])
    n = F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + F.coalesce(x["mean"] * x["n"], F.lit(0.0)))
    # all parts of one mean: that mean, without the rounding of the weighted sum
    means = F.array_distinct(F.transform(F.filter(own, lambda x: x["n"] > 0), lambda x: x["mean"]))
    mean = F.when(F.size(means) == 1, means[0]).when(n > 0, total / n)
    m2 = F.aggregate(own, F.lit(0.0), lambda a, x: a + F.when(x["n"] > 0, x["m2"] + x["n"] * (x["mean"] - mean) * (x["mean"] - mean)).otherwise(0.0))
    return n, mean, m2


def pre_failure_stats(telemetry: DataFrame, failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS,
                      sensors: Sequence[str] = S.SENSORS, key: str = S.KEY, time: str = S.TIME,
                      tie=None, bucket_us: int = HOUR_US) -> DataFrame:
    """One row per failure that has readings in ``[f - days, f)``: count, mean,
    sample std and trend (last minus first reading, in time order) per sensor.

    Instants, windows and buckets grow with the failures (a window is ``days/bucket`` rows, which
    Spark's size estimate does not see), so they are joined by shuffles and never broadcast.

    No (reading, failure) pairs: moments per machine and bucket are merged over the whole
    buckets of a failure's window; what the window takes of the buckets at its two ends comes
    from running moments over these buckets, forward up to ``f`` and backward down to
    ``f - days``. Readings are aggregated once, and a failure meets ``days/bucket`` rows.
    Equal failure rows stay rows of their own."""
    H = int(round(days * DAY_US))
    B = min(bucket_us, H // 2)
    ties, sensors = _ties(tie), list(sensors)
    bucket = lambda c: F.floor(epoch_micros(c) / F.lit(B)).cast("long")
    r = (telemetry.where(F.col(key).isNotNull() & F.col(time).isNotNull())
         .select(F.col(key).alias("_k"), F.col(time).alias("_t"), *[F.col(t).alias(f"_tie{i}") for i, t in enumerate(ties)],
                 *sensors, F.lit(1).alias("_r")).withColumn("_b", bucket("_t")))
    at = ["_t", *[f"_tie{i}" for i in range(len(ties))]]
    row = F.struct(*at, F.struct(*sensors).alias("v"))
    f = materialize(failures.where(F.col(key).isNotNull() & F.col(time).isNotNull())
                    .select(F.col(key).alias("_k"), F.col(time).alias("_f"), add_micros(time, -H).alias("_from"), "failure",
                            F.monotonically_increasing_id().alias("failure_id")), "failures")
    whole = r.groupBy("_k", "_b").agg(*_moments(sensors), F.min(F.struct(*at)).alias("lo"), F.max(F.struct(*at)).alias("hi"),
                                      F.min_by(F.struct(*sensors), F.struct(*at)).alias("lo_v"), F.max_by(F.struct(*sensors), F.struct(*at)).alias("hi_v"))

    def end(instant: str, forward: bool) -> DataFrame:
        """Per (machine, instant): the readings of its bucket before it (forward), or from it on."""
        points = f.select("_k", F.col(instant).alias("_t")).distinct().withColumn("_b", bucket("_t"))
        some = r.join(_shuffled(points.select("_k", "_b").distinct()), ["_k", "_b"], "left_semi")
        both = some.unionByName(points, allowMissingColumns=True)
        # an instant stands before the readings of its own time, which are not before it
        keys = [F.col("_t"), F.col("_r").asc_nulls_first(), *[F.col(c) for c in at[1:]]]
        if not forward:
            keys = [F.col("_t").desc(), F.col("_r").desc_nulls_last(), *[F.col(c).desc() for c in at[1:]]]
        so_far = Window.partitionBy("_k", "_b").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
        reading = F.when(F.col("_r") == 1, row)
        told = both.select("_k", "_t", "_r", *_moments(sensors, so_far), F.first(reading, True).over(so_far).alias("x"),
                           F.last(reading, True).over(so_far).alias("y")).where("_r is null and n > 0")
        lo, hi = (F.col("x"), F.col("y")) if forward else (F.col("y"), F.col("x"))
        cut = lambda c: F.struct(*[c[a].alias(a) for a in at])
        return told.select("_k", F.col("_t").alias(instant), "n", "m", cut(lo).alias("lo"), cut(hi).alias("hi"),
                           lo["v"].alias("lo_v"), hi["v"].alias("hi_v"))

    inner = f.select("failure_id", "_k", F.explode(F.sequence(bucket("_from") + 1, bucket("_f") - 1)).alias("_b"))
    columns = ["failure_id", "n", "m", "lo", "hi", "lo_v", "hi_v"]
    parts = _shuffled(inner).join(whole, ["_k", "_b"]).select(*columns) \
        .unionByName(_shuffled(f).join(end("_f", True), ["_k", "_f"]).select(*columns)) \
        .unionByName(_shuffled(f).join(end("_from", False), ["_k", "_from"]).select(*columns))
    told = parts.groupBy("failure_id").agg(F.sum("n").alias("readings"), F.collect_list(F.struct("n", "m")).alias("p"),
                                           F.min_by("lo_v", "lo").alias("first"), F.max_by("hi_v", "hi").alias("last"))
    out = [F.col("_k").alias(key), F.col("_f").alias("failure_datetime"), F.col("failure").alias("failure_type"),
           F.lit(int(days)).alias("days_before"), "readings"]
    for i, s in enumerate(sensors):
        n, mean, m2 = _merge("p", i)
        out += [mean.alias(f"{s}_mean"), F.when(n > 1, F.sqrt(m2 / (n - 1))).alias(f"{s}_std"),
                (F.col(f"last.{s}") - F.col(f"first.{s}")).alias(f"{s}_trend")]
    return _shuffled(f).join(told, "failure_id").select(*out)


def normal_vs_prefailure(telemetry: DataFrame, pre: DataFrame, sensors: Sequence[str] = S.SENSORS) -> DataFrame:
    """Per sensor -- mean and sample std of *all* telemetry vs the unweighted
    mean over failures of the per-failure means; both unpivoted to (sensor, value) and
    joined on the sensor name."""
    normal = telemetry.agg(*[F.avg(s).alias(f"m_{s}") for s in sensors],
                           *[F.stddev_samp(s).alias(f"s_{s}") for s in sensors])
    normal_long = normal.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("sensor"), F.col(f"m_{s}").alias("normal_mean"), F.col(f"s_{s}").alias("normal_std"))
        for s in sensors])).alias("r")).select("r.*")
    pre_agg = pre.agg(*[F.avg(f"{s}_mean").alias(s) for s in sensors])
    pre_long = pre_agg.unpivot([], list(sensors), "sensor", "pre_failure_mean")
    return (normal_long.join(pre_long, "sensor")
            .select("sensor", "normal_mean", "normal_std", "pre_failure_mean",
                    (F.col("pre_failure_mean") - F.col("normal_mean")).alias("difference")))
