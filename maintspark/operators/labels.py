"""J1, J3, A17: "fails within N days" labels and their counters.

A reading at ``t`` of machine ``m`` is positive when ``m`` has a failure at ``f``
with ``f - H <= t < f`` (H = days*24h), i.e. ``t < f <= t + H``.

Bucketed plan (exact, no per-group lists, no pair explosion): time is cut into
buckets of width ``B <= H``. For readings in bucket ``[b0, b1)``:

* a failure in ``[b1, b0 + H]`` makes every reading of the bucket positive;
* a failure ``f`` in ``[b0, b1)`` makes readings with ``t < f`` positive, so only
  the latest such ``f`` matters;
* a failure ``f`` in ``(b0 + H, b1 + H)`` makes readings with ``t >= f - H``
  positive, so only the earliest such ``f`` matters.

Every failure is spread over the ``floor(H/B) + 2`` buckets it can touch and
reduced to one row per (machine, bucket) with three scalars; the readings join
that table on (machine, bucket) -- broadcast after a size check, else a shuffle
join that AQE can split when one (machine, bucket) is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import add_micros, epoch_micros
from ..plans.sizing import BROADCAST_ROWS, has_at_most, materialize

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def _bucket_us(horizon_us: int, bucket_us: int | None) -> int:
    return min(horizon_us, bucket_us or DAY_US)


def failure_bucket_table(failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS, key: str = S.KEY,
                         time: str = S.TIME, bucket_us: int | None = None) -> DataFrame:
    """One row per (machine, bucket): ``_all`` / ``_last_in`` / ``_first_after``."""
    H = int(round(days * DAY_US))
    B = _bucket_us(H, bucket_us)
    f = (failures.select(F.col(key).alias(key), F.col(time).alias("_f"))
                 .where(F.col(key).isNotNull() & F.col("_f").isNotNull())
                 .withColumn("_fu", epoch_micros("_f")))
    # buckets b with b0 <= f < b1 + H  ->  b in [floor((f-H)/B), floor(f/B)]
    spread = f.select(key, "_f", "_fu", F.explode(F.sequence(
        F.floor((F.col("_fu") - F.lit(H)) / F.lit(B)).cast("long"),
        F.floor(F.col("_fu") / F.lit(B)).cast("long"))).alias("_b"))
    b0 = F.col("_b") * F.lit(B)
    b1 = b0 + F.lit(B)
    fu = F.col("_fu")
    return (spread.groupBy(key, "_b").agg(
        F.bool_or((fu >= b1) & (fu <= b0 + F.lit(H))).alias("_all"),
        F.max(F.when((fu >= b0) & (fu < b1), F.col("_f"))).alias("_last_in"),
        F.min(F.when((fu > b0 + F.lit(H)) & (fu < b1 + F.lit(H)), F.col("_f"))).alias("_first_after")))


def failure_labels(telemetry: DataFrame, failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS,
                   key: str = S.KEY, time: str = S.TIME, label: str = S.LABEL,
                   bucket_us: int | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``telemetry`` + ``label`` (INT 0/1)."""
    H = int(round(days * DAY_US))
    B = _bucket_us(H, bucket_us)
    table = failure_bucket_table(failures, days, key, time, B)
    if has_at_most(failures, broadcast_rows // (H // B + 2)):
        table = F.broadcast(table)
    t = F.col(time)
    tagged = telemetry.withColumn("_b", F.floor(epoch_micros(time) / F.lit(B)).cast("long"))
    joined = tagged.join(table, [key, "_b"], "left")
    hit = (F.coalesce(F.col("_all"), F.lit(False))
           | F.coalesce(F.col("_last_in") > t, F.lit(False))
           | F.coalesce(F.col("_first_after") <= add_micros(t, H), F.lit(False)))
    return joined.select(*telemetry.columns, hit.cast("int").alias(label))


def label_pairs(telemetry: DataFrame, failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS,
                key: str = S.KEY, time: str = S.TIME, failure_cols=("failure",),
                bucket_us: int | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every (reading, failure) pair with ``f - H <= t < f`` (inner interval join).

    Failures are spread over the buckets their window ``[f-H, f)`` covers; each
    reading lives in one bucket, so every pair is produced exactly once.
    Failure columns come out as ``failure_datetime`` plus ``failure_cols``; a
    ``failure_id`` tells apart equal failure rows.
    """
    H = int(round(days * DAY_US))
    B = _bucket_us(H, bucket_us)
    f = (failures.select(F.col(key).alias("_fkey"), F.col(time).alias("failure_datetime"),
                         *[F.col(c) for c in failure_cols],
                         F.monotonically_increasing_id().alias("failure_id"))
                 .where(F.col("_fkey").isNotNull() & F.col("failure_datetime").isNotNull()))
    fu = epoch_micros("failure_datetime")
    f = f.withColumn("_b", F.explode(F.sequence(F.floor((fu - F.lit(H)) / F.lit(B)).cast("long"),
                                                F.floor((fu - F.lit(1)) / F.lit(B)).cast("long"))))
    if has_at_most(failures, broadcast_rows // (H // B + 2)):
        f = F.broadcast(f)
    r = telemetry.withColumn("_b", F.floor(epoch_micros(time) / F.lit(B)).cast("long"))
    cond = ((r[key] == f["_fkey"]) & (r["_b"] == f["_b"])
            & (r[time] >= add_micros(f["failure_datetime"], -H)) & (r[time] < f["failure_datetime"]))
    return r.join(f, cond, "inner").drop("_b", "_fkey")


def marked_total(telemetry: DataFrame, failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS, key: str = S.KEY,
                 time: str = S.TIME, bucket_us: int = HOUR_US) -> DataFrame:
    """Number of (reading, failure) pairs with ``f - H <= t < f``, without making them.

    A failure counts its machine's readings before ``f`` less those before ``f - H``. The number
    before an instant is that of the earlier buckets (a running sum over one row a machine and
    bucket) and that of its own bucket's earlier readings (a running count over the bucket's
    readings and instants). Only buckets with an instant are ordered."""
    H = int(round(days * DAY_US))
    at = F.floor(epoch_micros("_t") / F.lit(bucket_us)).cast("long")
    r = (telemetry.select(F.col(key).alias("_k"), F.col(time).alias("_t")).where("_k is not null and _t is not null")
         .withColumn("_b", at))
    f = failures.select(F.col(key).alias("_k"), F.col(time).alias("_f")).where("_k is not null and _f is not null")
    ends = f.select("_k", F.explode(F.array(F.struct(F.col("_f").alias("t"), F.lit(1).alias("s")),
                                            F.struct(add_micros("_f", -H).alias("t"), F.lit(-1).alias("s")))).alias("e"))
    # equal instants of a machine count together; those that cancel out tell nothing
    ends = (ends.groupBy("_k", F.col("e.t").alias("_t")).agg(F.sum("e.s").alias("_s")).where("_s <> 0").withColumn("_b", at))
    ends = materialize(ends, "instants")
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    per_bucket = r.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n"), F.lit(0).cast("long").alias("_w")) \
        .unionByName(ends.groupBy("_k", "_b").agg(none.alias("_n"), F.sum("_s").alias("_w")))
    per_bucket = per_bucket.groupBy("_k", "_b").agg(F.sum("_n").alias("_n"), F.sum("_w").alias("_w"))
    earlier = F.sum("_n").over(Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    whole = per_bucket.select((F.coalesce(earlier, none) * F.col("_w")).alias("c"))
    some = r.join(ends.select("_k", "_b").distinct(), ["_k", "_b"], "left_semi")
    mixed = some.select("_k", "_b", "_t", one.alias("_n"), none.alias("_s")) \
        .unionByName(ends.select("_k", "_b", "_t", none.alias("_n"), "_s"))
    # an instant comes before the readings of its own time: they are not before it
    before = F.sum("_n").over(Window.partitionBy("_k", "_b").orderBy("_t", "_n").rowsBetween(Window.unboundedPreceding, 0))
    inside = mixed.select("_s", before.alias("_c")).where("_s <> 0").select((F.col("_c") * F.col("_s")).alias("c"))
    return whole.unionByName(inside).agg(F.coalesce(F.sum("c"), none).alias("marked_total"))


def label_counts(telemetry: DataFrame, failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS,
                 key: str = S.KEY, time: str = S.TIME, label: str = S.LABEL) -> DataFrame:
    """Pairs marked (overlaps counted again) vs distinct positive readings, and the rate."""
    pairs = marked_total(telemetry, failures, days, key, time)
    labeled = failure_labels(telemetry, failures, days, key, time, label).agg(
        F.count(F.lit(1)).cast("long").alias("total_rows"),
        F.sum(label).cast("long").alias("positive_rows"),
        (F.avg(label) * 100.0).alias("positive_rate_pct"))
    # one row each: an equi-join on a constant key, no cartesian product
    return pairs.withColumn("_one", F.lit(1)).join(labeled.withColumn("_one", F.lit(1)), "_one").drop("_one")


def label_balance(labeled: DataFrame, key: str | None = None, label: str = S.LABEL) -> DataFrame:
    """A17 (+A3 on the label): rows, positives and positive rate, overall or per ``key``."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum(label).cast("long").alias("positives"),
            F.avg(label).alias("positive_rate")]
    return labeled.groupBy(key).agg(*aggs) if key else labeled.agg(*aggs)
