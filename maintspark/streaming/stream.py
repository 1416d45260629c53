"""Structured Streaming forms of the request path.

* X5 ``telemetry_stream``: incremental CSV ingest with the T1 schema.
* X1 ``rolling_stream``: rolling statistics per machine. The last ``max(window)-1`` readings
  of a machine are one state row in RocksDB (``transformWithState``), so a trigger reads and
  writes only the machines it has readings of; every row sees only itself and earlier rows.
  A row older than the newest kept row of its machine is *late*: emitted with
  ``status='late'`` and no statistics, never reordered into features already emitted.
* X2 ``score_stream``: stateless scoring of a reading stream.
* X3 ``label_stream``: reading stream LEFT OUTER failure stream within the horizon: 1 at the
  first failure, 0 once the watermarks tell that none can come (they bound the join state).
  ``late_failures`` lists the failures that came after their readings' zeros.
* X4 ``rollup_stream``: prediction-log rollups per event-time window with a watermark; rows
  later than the watermark are dropped, and ``dropped_rows`` counts them.

``withWatermark`` needs TIMESTAMP (not TIMESTAMP_NTZ), so event times are cast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from .. import schemas as S
from ..functions.expr import add_micros
from ..operators.labels import DAY_US, label_pairs
from ..operators.monitor import bin_count_columns
from ..session import rocksdb_state, stream_checkpoint
from ..sources.io import bad_row, convert


def telemetry_stream(spark: SparkSession, path: str, schema: T.StructType = S.TELEMETRY,
                     max_files_per_trigger: int | None = 16, bad_rows: bool = False) -> DataFrame:
    """CSV files arriving in ``path`` -> T1 rows, converted as in batch (every column read
    as text). ``bad_rows``: the rows that do not convert instead (``raw_record``), for a second
    query. A trigger takes ``max_files_per_trigger`` files at most, so a backlog is worked
    off in bounded batches (``None``: no bound)."""
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    r = spark.readStream.schema(text).option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.csv(path)
    conv = {f.name: convert(F.col(f.name), f, [S.TIME]) for f in schema.fields}
    bad = bad_row(schema)
    if bad_rows:
        return raw.filter(bad).select(F.to_json(F.struct(*schema.names)).alias("raw_record"))
    return raw.filter(~bad).select(*[c.alias(name) for name, c in conv.items()])


# ------------------------------------------------------------------------- X1
def _stat_names(sensors, windows, stats):
    return [f"{s}_{w}h_{st}" for w in windows for s in sensors for st in stats]


def window_statistics(values: np.ndarray, skip: int, windows: Sequence[int], stats: Sequence[str]) -> np.ndarray:
    """(rows after ``skip``, windows * sensors * stats): statistics over the last w rows, NaN
    left out, of a (rows, sensors) array; all windows from one strided view."""
    widest = max(windows)
    if len(values) == skip:
        return np.zeros((0, len(windows) * values.shape[1] * len(stats)))
    padded = np.vstack([np.full((max(widest - 1 - skip, 0), values.shape[1]), np.nan), values])
    view = np.lib.stride_tricks.sliding_window_view(padded, widest, axis=0)[len(padded) - widest + 1 - (len(values) - skip):]
    out = []
    for w in windows:
        v = view[..., widest - w:]
        there = ~np.isnan(v)
        n = there.sum(axis=-1)
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.where(there, v, 0.0).sum(axis=-1) / n
            told = {"mean": mean,
                    "std": np.sqrt(np.where(there, v - mean[..., None], 0.0).__pow__(2).sum(axis=-1) / np.where(n > 1, n - 1, np.nan)),
                    "max": np.where(n > 0, np.where(there, v, -np.inf).max(axis=-1), np.nan),
                    "min": np.where(n > 0, np.where(there, v, np.inf).min(axis=-1), np.nan)}
        out.append(np.stack([told[s] for s in stats], axis=-1).reshape(len(v), -1))
    return np.hstack(out)


class RollingProcessor(StatefulProcessor):
    """A machine's readings of one trigger, computed together with its kept rows."""

    def __init__(self, sensors, windows, stats, cols, time: str, tie: str | None, fill: bool, ttl_ms: int | None):
        self.sensors, self.windows, self.stats, self.cols = sensors, windows, stats, cols
        self.time, self.tie, self.fill, self.ttl_ms = time, tie, fill, ttl_ms
        self.names = _stat_names(sensors, windows, stats)

    def init(self, handle) -> None:
        # times, ties and sensor values of the kept rows in one cell: a machine is read and written in one step each
        self.kept = handle.getValueState("kept", T.StructType([T.StructField("rows", T.BinaryType())]), self.ttl_ms)
        if self.fill:
            self.last = handle.getValueState("last", T.StructType([T.StructField("values", T.ArrayType(T.DoubleType()))]), self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a trigger may hold very many machines of a few readings each: arrays, and one frame at the end
        parts = [part for part in rows if len(part)]
        new = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        t = new[self.time].astype("int64").to_numpy()
        tie = new[self.tie].astype("int64").to_numpy() if self.tie else np.zeros(len(new), np.int64)
        order = np.lexsort((tie, t, new[self.time].isna().to_numpy()))  # missing times are last
        t, tie = t[order], tie[order]
        cells = np.frombuffer((self.kept.get() or (b"",))[0], np.int64).reshape(2 + len(self.sensors), -1)
        old_t, old_tie, old = cells[0], cells[1], np.ascontiguousarray(cells[2:].view(np.float64).T)
        late = np.zeros(len(new), bool)
        if len(old):
            last_t, last_tie = old_t[-1], old_tie[-1]
            # without a tie column readings of one time have no order among them, so an equal time isn't late
            late = (t < last_t) | ((t == last_t) & (tie <= last_tie) if self.tie else False)
        ok = order[~late]
        read = np.column_stack([new[s].to_numpy(np.float64, na_value=np.nan) for s in self.sensors])
        values = np.vstack([old, read[ok]])
        told = window_statistics(values, len(old), self.windows, self.stats)
        filled = None
        if self.fill and len(ok):
            carry = self.last.get()[0] if self.last.exists() else [None] * (len(self.sensors) + len(self.names))
            seeded = np.vstack([np.array([np.nan if c is None else c for c in carry], np.float64)[None], np.hstack([read[ok], told])])
            seeded = pd.DataFrame(seeded).ffill().to_numpy()
            self.last.update(([None if np.isnan(v) else float(v) for v in seeded[-1]],))
            filled = np.nan_to_num(seeded[1:], nan=0.0)
            told = filled[:, len(self.sensors):]
        if len(ok):
            # one row at least: it also tells which readings are late
            keep = max(max(self.windows) - 1, 1)
            cells = [np.r_[old_t, t[~late]][-keep:], np.r_[old_tie, tie[~late]][-keep:], *values[-keep:].T.copy().view(np.int64)]
            self.kept.update((np.stack(cells).tobytes(),))
        if late.any():
            told = np.vstack([told, np.full((late.sum(), len(self.names)), np.nan)])
            ok = np.r_[ok, order[late]]
        in_order = len(ok) == 0 or (ok == np.arange(len(ok))).all()
        out = {c: new[c] if in_order else new[c].take(ok) for c in self.cols}
        if filled is not None:
            for i, s in enumerate(self.sensors):
                out[s] = np.r_[filled[:, i], read[order[late], i]]
        out = {c: v.array if isinstance(v, pd.Series) else v for c, v in out.items()}
        out["_told"] = list(told)  # one cell a row: a frame's cost is that of its columns
        out["status"] = np.repeat(np.array(["ok", "late"], object), [len(ok) - late.sum(), late.sum()])
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def rolling_stream(stream: DataFrame, sensors: Sequence[str] = S.SENSORS, windows: Sequence[int] = S.WINDOWS,
                   stats: Sequence[str] = S.STATS, key: str = S.KEY, time: str = S.TIME,
                   tie: str | None = None, fill: bool = False, ttl_days: float | None = None) -> DataFrame:
    """The W1 statistics on a stream, exact across micro-batches for in-order rows.

    ``fill``: forward fill within the machine (the last non-null value of every sensor
    and statistic is kept in state), then 0 -- the batch ``frame_fill(mode='machine')``.
    The frame-wide fill of the batch table needs the previous machine, which a stream
    does not have. ``ttl_days``: a machine without readings for so long (of the clock) is
    forgotten; none is without it. It is for queries that run on with a ``processingTime``
    trigger: an ``availableNow`` query would wait for the clock and never end. State is kept in RocksDB: the session's state store is
    set to it, as ``transformWithState`` asks for it."""
    rocksdb_state(stream.sparkSession)
    sensors, windows, stats = list(sensors), list(windows), list(stats)
    fields = {f.name: f.dataType for f in stream.schema.fields}
    cols = [key, time] + ([tie] if tie else []) + sensors
    out = T.StructType([T.StructField(c, fields[c]) for c in cols]
                       + [T.StructField("_told", T.ArrayType(T.DoubleType())), T.StructField("status", T.StringType())])
    ttl_ms = None if ttl_days is None else int(ttl_days * DAY_US // 1000)
    if fill:
        out = T.StructType([T.StructField(f.name, T.DoubleType()) if f.name in sensors else f for f in out.fields])
    worker = RollingProcessor(sensors, windows, stats, cols, time, tie, fill, ttl_ms)
    known = stream.where(F.col(key).isNotNull()).select(*cols).groupBy(key).transformWithStateInPandas(
        worker, out, "Append", "None" if ttl_ms is None else "ProcessingTime")
    told = [F.col("_told")[i] for i in range(len(worker.names))]
    known = known.select(*cols, *[F.when(~F.isnan(c), c).alias(n) for c, n in zip(told, worker.names)], "status")
    # readings without a machine have no statistics, as in the batch, and no state
    none = F.lit(0.0 if fill else None).cast("double")
    unknown = stream.where(F.col(key).isNull()).select(
        *[F.coalesce(F.col(c).cast("double"), none).alias(c) if fill and c in sensors else F.col(c) for c in cols],
        *[none.alias(n) for n in worker.names], F.lit("ok").alias("status"))
    return known.unionByName(unknown)


# ------------------------------------------------------------------------- X2
def score_stream(readings: DataFrame, scorer) -> DataFrame:
    """``scorer`` maps a DataFrame of readings to predictions (e.g. a PipelineModel
    transform); stateless, so it runs per micro-batch unchanged."""
    return scorer(readings)


# ------------------------------------------------------------------------- X3
def label_stream(readings: DataFrame, failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS,
                 key: str = S.KEY, time: str = S.TIME, delay: str = "1 hour", failure_delay: str = "1 hour",
                 label: str = S.LABEL) -> DataFrame:
    """Every reading once, with the batch label of J1: 1 when a failure of its machine
    follows within ``days``, else 0.

    A LEFT OUTER join of the streams: a reading comes out as 1 with its first failure, or as 0
    when both watermarks have passed its horizon. A reading that meets several failures comes
    out of the join several times; the id it was given before keeps the first. Readings wait
    ``days`` (plus the delays) in state and go then, so the state is bounded by the readings
    and failures of that time. A machine or time that is missing can meet no failure: 0 at
    once. ``delay`` / ``failure_delay``: how much later than newer rows of its stream a row
    may come. Rows later than that are dropped by the join; see :func:`late_failures`."""
    hours = int(round(days * 24))
    whole = F.col(key).isNotNull() & F.col(time).isNotNull()
    r = (readings.where(whole).withColumn("_rid", F.expr("uuid()")).withColumn("_t", F.col(time).cast("timestamp"))
                 .withWatermark("_t", delay))
    f = (failures.select(F.col(key).alias("_fk"), F.col(time).cast("timestamp").alias("_ft"))
                 .withWatermark("_ft", failure_delay))
    cond = ((F.col(key) == F.col("_fk")) & (F.col("_t") >= F.col("_ft") - F.expr(f"INTERVAL {hours} HOURS"))
            & (F.col("_t") < F.col("_ft")))
    told = r.join(f, cond, "left_outer").select(*readings.columns, "_t", "_rid", F.col("_fk").isNotNull().cast("int").alias(label))
    once = told.dropDuplicates(["_rid", "_t"]).select(*readings.columns, label)
    return once.unionByName(readings.where(~whole).withColumn(label, F.lit(0)))


def closing_rows(readings: DataFrame, failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS, key: str = S.KEY,
                 time: str = S.TIME) -> tuple[DataFrame, DataFrame]:
    """One reading and one failure so late that, read as the last rows of a closed stream, they
    move the watermarks of :func:`label_stream` past every reading's horizon. The reading
    itself stays in state (it is later than the failure) and never comes out. Good for delays
    of up to ``days``."""
    span = int(3 * days * DAY_US) + 4 * DAY_US
    ends = [d.agg(F.max(time).alias("m")) for d in (readings, failures)]
    last = ends[0].unionByName(ends[1]).agg(F.max("m").alias("_end"))
    some = readings.where(F.col(key).isNotNull()).limit(1).withColumn("_one", F.lit(1)).join(last.withColumn("_one", F.lit(1)), "_one")
    failure = failures.where(F.col(key).isNotNull()).limit(1).withColumn("_one", F.lit(1)).join(last.withColumn("_one", F.lit(1)), "_one")
    return (some.withColumn(time, add_micros("_end", 2 * span)).select(*readings.columns),
            failure.withColumn(time, add_micros("_end", span)).select(*failures.columns))


def late_failures(labels: DataFrame, failures: DataFrame, days: float = S.PREDICTION_WINDOW_DAYS, key: str = S.KEY,
                  time: str = S.TIME, label: str = S.LABEL) -> DataFrame:
    """The failures that came too late for :func:`label_stream`: those with readings of their
    horizon among the emitted zeros, and how many (``readings``). Only missed pairs are joined."""
    missed = label_pairs(labels.where(F.col(label) == 0), failures, days, key, time, failure_cols=())
    return missed.groupBy(key, F.col("failure_datetime").alias(time)).agg(F.countDistinct("failure_id").alias("failures"),
                                                                          F.count(F.lit(1)).alias("pairs"))


# ------------------------------------------------------------------------- X4
def rollup_stream(log: DataFrame, window: str = "300 seconds", watermark: str = "10 minutes",
                  time: str = "prediction_timestamp", bins: int = 10) -> DataFrame:
    """Per event-time window -- predictions by risk level (O1), requests and errors
    (O3, input of O8), mean latency (O9) and probability bin counts (input of O6, see
    ``monitor.drift_from_bins`` / ``monitor.error_alerts_from_rollups``); append mode,
    so each window is emitted once after the watermark passes its end."""
    t = log.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", watermark)
    g = t.groupBy(F.window("_t", window).alias("w"))
    agg = g.agg(F.count(F.lit(1)).alias("requests"),
                F.count_if(F.col("status") == "error").alias("errors"),
                F.count_if(F.col("risk_level") == "LOW").alias("low"),
                F.count_if(F.col("risk_level") == "MEDIUM").alias("medium"),
                F.count_if(F.col("risk_level") == "HIGH").alias("high"),
                F.avg("duration_seconds").alias("mean_latency"),
                *(bin_count_columns("failure_probability", bins) if "failure_probability" in log.columns else []))
    bin_cols = [c for c in agg.columns if c.startswith("p_bin_")]
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), "requests",
                      "errors", (F.col("errors") / F.col("requests")).alias("error_rate"), "low", "medium", "high",
                      "mean_latency", *bin_cols)


def dropped_rows(progress: Iterable, rollups: DataFrame) -> int:
    """Rows of the log that came behind the watermark, of a stream that was read to its end and
    closed: rows read (as the query's progress tells) less those in the emitted windows."""
    read = sum(p["numInputRows"] for p in progress)
    return read - (rollups.agg(F.sum("requests")).first()[0] or 0)


# ------------------------------------------------------------------------- running
def follow(slices: Sequence[dict[str, DataFrame]], folder: str, build: Callable[[dict[str, DataFrame]], DataFrame],
           name: str) -> tuple[DataFrame, list]:
    """Read tables as they arrive: the rows of each slice are written below ``folder``, then the
    query ``build(streams)`` takes all new files in one trigger and stops; the next start goes on
    from its checkpoint. Returns the sink's table and the progress of all starts."""
    spark = next(iter(slices[0].values())).sparkSession
    progress = []
    for part in slices:
        for table, rows in part.items():
            rows.write.mode("append").parquet(f"{folder}/in/{table}")
        streams = {t: spark.readStream.schema(spark.read.parquet(f"{folder}/in/{t}").schema).parquet(f"{folder}/in/{t}") for t in slices[0]}
        handle = start_to_parquet(out := build(streams), f"{folder}/out", f"{name}-{len(progress)}", checkpoint=f"{folder}/checkpoint")
        handle.awaitTermination()
        progress += list(handle.recentProgress)
    return spark.read.schema(out.schema).parquet(f"{folder}/out"), progress


def run_to_table(stream: DataFrame, name: str, checkpoint: str | None = None, mode: str = "append",
                 available_now: bool = True):
    """Drive a stream to completion into an in-memory table (tests, local runs)."""
    checkpoint = checkpoint or stream_checkpoint(stream.sparkSession, name)
    q = (stream.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q
    handle = q.start()
    handle.awaitTermination()
    return handle


def start_to_parquet(stream: DataFrame, path: str, name: str, checkpoint: str | None = None,
                     processing_time: str | None = None, partition_by: Sequence[str] = ()):
    """Production sink: parquet files (exactly-once file sink) with the query's state and
    offsets in the shared checkpoint folder; ``processing_time`` (e.g. '1 minute') for a
    continuous query, else ``availableNow`` (process what is there, then stop)."""
    w = (stream.writeStream.format("parquet").option("path", path).queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint or stream_checkpoint(stream.sparkSession, name)))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()
