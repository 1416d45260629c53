"""Data profiling as single-pass aggregations.

Each report is one ``agg`` (partial aggregation on every task, one small merge),
not one job per statistic. Calendars (days, months, bins) come from
``sequence`` spines so empty periods appear, as in pandas ``resample``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import epoch_micros, is_missing, nan_to_null
from ..plans.quantiles import describe, quantiles

DAY_US = 86_400_000_000


def _days_floor(lo, hi):
    """pandas ``(max - min).days``: whole days, floored."""
    return F.floor((epoch_micros(hi) - epoch_micros(lo)) / F.lit(DAY_US)).cast("long")


def _distinct(key: str, approx: bool):
    """Exact distinct count, or HyperLogLog++ (``approx``: one bounded pass, ~2 % error)."""
    return F.approx_count_distinct(key, 0.02) if approx else F.countDistinct(key)


def ingest_stats(telemetry: DataFrame, failures: DataFrame, key: str = S.KEY, time: str = S.TIME,
                 approx: bool = False) -> DataFrame:
    """Rows, failures, distinct machines, collection days."""
    t = telemetry.agg(F.count(F.lit(1)).alias("telemetry_records"),
                      _distinct(key, approx).alias("unique_machines"),
                      F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    f = failures.agg(F.count(F.lit(1)).alias("failure_records"))
    return (t.withColumn("_one", F.lit(1)).join(f.withColumn("_one", F.lit(1)), "_one")
             .select("telemetry_records", "failure_records", "unique_machines",
                     _days_floor(F.col("_lo"), F.col("_hi")).alias("date_range_days")))


def null_counts(df: DataFrame, table: str = "telemetry") -> DataFrame:
    """Missing (NULL or NaN) per column, one pass, long form (table, column, nulls)."""
    fields = df.schema.fields
    wide = df.agg(*[F.count_if(is_missing(f.name, f.dataType)).alias(f.name) for f in fields])
    return (wide.unpivot([], [f.name for f in fields], "column", "nulls")
                .select(F.lit(table).alias("table"), "column", F.col("nulls").cast("long").alias("nulls")))


def validation_summary(telemetry: DataFrame, failures: DataFrame, key: str = S.KEY,
                       time: str = S.TIME, approx: bool = False) -> DataFrame:
    """A1/A2: shapes, date range, distinct machines, failure count, total missing values
    -- one aggregation per table."""
    tf = telemetry.schema.fields
    t = telemetry.agg(F.count(F.lit(1)).alias("telemetry_rows"),
                      F.min(time).alias("first_reading"), F.max(time).alias("last_reading"),
                      _distinct(key, approx).alias("unique_machines"),
                      sum(F.count_if(is_missing(f.name, f.dataType)) for f in tf).alias("missing_values"))
    f = failures.agg(F.count(F.lit(1)).alias("total_failures"))
    return (t.withColumn("_one", F.lit(1)).join(f.withColumn("_one", F.lit(1)), "_one")
             .select("telemetry_rows", F.lit(len(tf)).alias("telemetry_columns"),
                     F.lit(len(failures.columns)).alias("failures_columns"),
                     "first_reading", "last_reading", "unique_machines", "total_failures",
                     F.col("missing_values").cast("long").alias("missing_values")))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """A3: non-null values and their counts, most frequent first (pandas ``value_counts``)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.col(name).desc(), F.col(column).asc()))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """A4: count and percent share of each value; the total is a one-row aggregate joined
    by broadcast, so a column with many distinct values never meets in one task."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total")).withColumn("_one", F.lit(1))
    return (counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
                  .select(column, "count", (F.col("count") * 100.0 / F.col("_total")).alias("percent")))


def sensor_describe(df: DataFrame, sensors: Sequence[str] = S.SENSORS, approx: bool = False) -> DataFrame:
    """A5 on the sensor columns."""
    return describe(df, sensors, approx=approx, name="sensor")


def records_describe(df: DataFrame, key: str = S.KEY, approx: bool = False) -> DataFrame:
    """A5 on the per-machine record counts."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("records"))
    return describe(counts, ["records"], approx=approx, name="column")


def correlation(df: DataFrame, sensors: Sequence[str] = S.SENSORS) -> DataFrame:
    """Pearson matrix in long form (sensor_a, sensor_b, corr): one aggregation of the
    distinct pairs, mirrored. Pairwise-complete rows like pandas; a constant sensor has no correlation, also
    not with itself."""
    pairs = [(a, b) for i, a in enumerate(sensors) for b in sensors[i + 1:]]
    clean = nan_to_null(df.select(*sensors))

    def pearson(a, b):
        """NULL for a constant (or empty) column; over the rows that have both values."""
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    wide = clean.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs],
                     *[F.when(F.stddev_pop(s) > 0, 1.0).alias(f"{s}|{s}") for s in sensors])
    cells = []
    for a, b in pairs:
        cells.append(F.struct(F.lit(a).alias("sensor_a"), F.lit(b).alias("sensor_b"), F.col(f"`{a}|{b}`").alias("corr")))
        cells.append(F.struct(F.lit(b).alias("sensor_a"), F.lit(a).alias("sensor_b"), F.col(f"`{a}|{b}`").alias("corr")))
    for s in sensors:
        cells.append(F.struct(F.lit(s).alias("sensor_a"), F.lit(s).alias("sensor_b"), F.col(f"`{s}|{s}`").alias("corr")))
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def histogram(df: DataFrame, sensors: Sequence[str] = S.SENSORS, bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max per sensor, last bin closed, empty bins 0.

    Pass 1 (one aggregation) gives the bounds; pass 2 counts per (sensor, bin) and
    a spine of ``bins`` rows per sensor brings back the empty bins."""
    from ..plans.quantiles import long_values
    vals = long_values(df, sensors, "sensor")
    bounds = vals.groupBy("sensor").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # numpy: a constant column gets the range (v - 0.5, v + 0.5)
    bounds = bounds.select("sensor",
                           F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                           F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    idx = F.least(F.floor((F.col("value") - F.col("lo")) * F.lit(float(bins)) / (F.col("hi") - F.col("lo"))),
                  F.lit(bins - 1)).cast("int")
    counts = (vals.join(F.broadcast(bounds), "sensor")   # one row per sensor
                  .groupBy("sensor", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    spine = bounds.select("sensor", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (spine.join(counts, ["sensor", "bin"], "left")
                 .select("sensor", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                         (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
                         F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def daily_mean(df: DataFrame, sensors: Sequence[str] = S.SENSORS, time: str = S.TIME) -> DataFrame:
    """Mean per calendar day over all machines; days without readings present as NULL."""
    day = F.to_date(F.col(time))
    means = df.groupBy(day.alias("day")).agg(*[F.avg(s).alias(s) for s in sensors])
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return spine.join(means, "day", "left").select("day", *sensors)


def monthly_counts(df: DataFrame, time: str = S.TIME) -> DataFrame:
    """A10: events per calendar month labelled by the month's last day; empty months 0."""
    month_end = F.last_day(F.to_date(F.col(time)))
    counts = df.groupBy(month_end.alias("month_end")).agg(F.count(F.lit(1)).alias("failures"))
    span = df.agg(F.trunc(F.min(F.to_date(F.col(time))), "month").alias("lo"),
                  F.trunc(F.max(F.to_date(F.col(time))), "month").alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("m"))
    spine = spine.select(F.last_day("m").alias("month_end"))
    return (spine.join(counts, "month_end", "left")
                 .select("month_end", F.coalesce(F.col("failures"), F.lit(0)).cast("long").alias("failures")))


def hourly_pattern(df: DataFrame, sensors: Sequence[str] = S.SENSORS, time: str = S.TIME) -> DataFrame:
    """Mean per hour of day."""
    return df.groupBy(F.hour(F.col(time)).alias("hour")).agg(*[F.avg(s).alias(s) for s in sensors])


def group_mean(df: DataFrame, key: str = S.KEY, sensors: Sequence[str] = S.SENSORS) -> DataFrame:
    """Mean per machine."""
    return df.groupBy(key).agg(*[F.avg(s).alias(s) for s in sensors])


def iqr_outliers(df: DataFrame, sensors: Sequence[str] = S.SENSORS, k: float = 1.5,
                 approx: bool = False) -> DataFrame:
    """Q1-k*IQR, Q3+k*IQR per sensor (exact quartiles), then one pass counting
    values strictly outside; percent of all rows (pandas divides by ``len``)."""
    q = quantiles(df, sensors, [0.25, 0.75], approx=approx, name="sensor")
    b = (q.groupBy("sensor").agg(F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
                                 F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"))
          .withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_bound", F.col("q1") - F.lit(k) * F.col("iqr"))
          .withColumn("upper_bound", F.col("q3") + F.lit(k) * F.col("iqr")))
    # The bounds are one row per sensor; pivot them to columns and count all sensors in one pass.
    bw = b.agg(*[F.max(F.when(F.col("sensor") == s, F.col("lower_bound"))).alias(f"lo_{s}") for s in sensors],
               *[F.max(F.when(F.col("sensor") == s, F.col("upper_bound"))).alias(f"hi_{s}") for s in sensors])
    counted = df.withColumn("_one", F.lit(1)).join(F.broadcast(bw.withColumn("_one", F.lit(1))), "_one")
    c = counted.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(((F.col(s) < F.col(f"lo_{s}")) | (F.col(s) > F.col(f"hi_{s}")))
                               & ~F.isnan(F.col(s).cast("double"))).alias(s)
                      for s in sensors])
    cl = c.unpivot(["_rows"], list(sensors), "sensor", "count")
    return (b.join(cl, "sensor")
             .select("sensor", "q1", "q3", "iqr", "lower_bound", "upper_bound", F.col("count").cast("long").alias("count"),
                     (F.col("count") * 100.0 / F.col("_rows")).alias("percentage")))


def business_facts(telemetry: DataFrame, failures: DataFrame, key: str = S.KEY, time: str = S.TIME,
                   failure_col: str = "failure", approx: bool = False) -> DataFrame:
    """Machines, collection days, missing cells, failures, failures per machine and the
    most common failure type (ties: smallest name)."""
    tf = telemetry.schema.fields
    t = telemetry.agg(_distinct(key, approx).alias("machines"),
                      _days_floor(F.min(time), F.max(time)).alias("collection_days"),
                      sum(F.count_if(is_missing(f.name, f.dataType)) for f in tf).cast("long").alias("missing_cells"))
    counts = failures.where(F.col(failure_col).isNotNull()).groupBy(failure_col).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.agg(F.min_by(F.col(failure_col), F.struct(-F.col("n"), F.col(failure_col))).alias("most_common_failure"))
    f = failures.agg(F.count(F.lit(1)).alias("total_failures"))
    one = F.lit(1)
    return (t.withColumn("_one", one).join(f.withColumn("_one", one), "_one").join(mode.withColumn("_one", one), "_one")
             .select("machines", "collection_days", "missing_cells", "total_failures",
                     F.try_divide(F.col("total_failures"), F.col("machines")).alias("failures_per_machine"),
                     "most_common_failure"))
