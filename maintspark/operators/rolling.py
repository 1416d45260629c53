"""Rolling sensor statistics per machine over the last N *rows*.

One ``Window.partitionBy(key).orderBy(time, tie)`` per frame width; Catalyst's
window extraction groups every expression of one spec into one Window operator
and all specs share the same exchange and sort, so the 32 statistics cost one
shuffle by machine and one sort. A window aggregates the whole frame anew for each row, which
took most of the time; machines that are not cut get the same statistics from the
same exchange and sort in Arrow batches instead (``_rolled``).

Hot machines: with ``chunk_rows`` set (or ``'auto'``), machines holding more rows
than that are cut into chunks of that many rows. Their rows get an id each and their
position in the machine's order (a scan cut over all tasks), so equal or missing times
lose nothing and chunks are even. The last ``max(window)-1`` rows of a chunk also go to
the next one as context, so one busy machine is many tasks, the window runs once and the
result stays exact. ``chunked_rolling_with_summary`` also returns each chunk's last
non-null values for the frame fill, from the chunks' last rows only.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..plans.ordered import global_row_index, global_scan
from ..plans.sizing import materialize

_AGG = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "max": F.max,
    "min": F.min,
}


def feature_names(df: DataFrame, exclude: Sequence[str] = S.EXCLUDE_FROM_FEATURES) -> list[str]:
    """Every column except time, key and label, in frame order (schema only, no job)."""
    return [c for c in df.columns if c not in set(exclude)]


def feature_names_like(df: DataFrame, pattern: str) -> list[str]:
    """P2 by name pattern, e.g. ``'_3h_'`` or ``'_mean'``."""
    return [c for c in df.columns if pattern in c]


def default_spec(windows: Sequence[int] = S.WINDOWS, stats: Sequence[str] = S.STATS) -> dict[int, list[str]]:
    return {w: list(stats) for w in windows}


def _order(time: str, tie) -> list[Column]:
    """Row order inside a machine: time, then ties; missing values last (as pandas sorts)."""
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    return [F.col(c).asc_nulls_last() for c in [time, *ties]]


def _reverse_order(time: str, tie) -> list[Column]:
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    return [F.col(c).desc_nulls_first() for c in [time, *ties]]


def order_key(time: str, tie=None) -> Column:
    """A struct that ranks rows like ``_order`` (for max_by/min_by): missing times last."""
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    return F.struct(F.col(time).isNull(), F.col(time), *[F.struct(F.col(t).isNull(), F.col(t)) for t in ties])


def rolling_exprs(spec: Mapping[int, Sequence[str]], sensors: Sequence[str], part: Sequence[str],
                  order: Sequence[Column], key: str, min_periods: str = "one") -> list[Column]:
    """The statistic columns, named ``{sensor}_{w}h_{stat}``, order window > sensor > stat.

    ``min_periods='one'``: pandas ``min_periods=1``; ``'full'``: NULL until the frame
    holds ``w`` non-null observations (pandas ``rolling(w)``).
    """
    base = Window.partitionBy(*part).orderBy(*order)
    out = []
    for w, stats in spec.items():
        frame = base.rowsBetween(-(int(w) - 1), Window.currentRow)
        for s in sensors:
            for st in stats:
                e = _AGG[st](F.col(s)).over(frame)
                if min_periods == "full":
                    e = F.when(F.count(F.col(s)).over(frame) >= int(w), e)
                # pandas drops rows with a NULL group key: their statistics are NaN.
                e = F.when(F.col(key).isNotNull(), e)
                out.append(e.alias(f"{s}_{w}h_{st}"))
    return out


def frame_statistics(x: np.ndarray, there: np.ndarray, behind: np.ndarray, width: int, stats: Sequence[str]) -> tuple[dict, np.ndarray]:
    """Statistics of the last ``width`` rows, for (sensors, rows) values: ``behind`` counts the rows
    a row has before it in its group. Values are taken oldest first with Spark's own updates, so
    sums and deviations are those of a window; NaN is a value, and the largest one."""
    n, total, mean, m2 = (np.zeros(x.shape) for _ in range(4))
    top, low = np.full(x.shape, -np.inf), np.full(x.shape, np.nan)
    size = x.shape[1]
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        for j in range(min(width, size) - 1, -1, -1):
            at = np.s_[:, j:]
            v = x[:, :size - j]
            in_ = there[:, :size - j] & (behind[j:] >= j)
            n[at] += in_
            if "mean" in stats:
                total[at] += np.where(in_, v, 0.0)
            if "std" in stats:
                delta = v - mean[at]
                step = delta / n[at]
                mean[at] += np.where(in_, step, 0.0)
                m2[at] += np.where(in_, delta * (delta - step), 0.0)
            if "max" in stats:
                top[at] = np.maximum(top[at], np.where(in_, v, -np.inf))
            if "min" in stats:
                low[at] = np.fmin(low[at], np.where(in_, v, np.nan))
        told = {"mean": total / n, "std": np.sqrt(m2 / (n - 1)), "max": top, "min": low}
    return told, n


def _rolled_batches(batches: Iterator[pa.RecordBatch], spec: Mapping[int, Sequence[str]], sensors: Sequence[str],
                    key: str, full: bool, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The sorted rows of a task, the last column their number in the group, with their statistics. Between two batches the last
    ``max(window)-1`` rows are kept, so no machine is held whole."""
    halo = max(spec) - 1
    x, there, behind = np.zeros((len(sensors), 0)), np.zeros((len(sensors), 0), bool), np.zeros(0, np.int64)
    for batch in batches:
        kept, rows_at = len(behind), batch.num_columns - 1
        behind = np.concatenate([behind, batch.column(rows_at).to_numpy().astype(np.int64) - 1])
        cells = [batch.column(batch.schema.get_field_index(s)) for s in sensors]
        x = np.concatenate([x, np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in cells])], axis=1)
        there = np.concatenate([there, np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in cells])], axis=1)
        nameless = batch.column(batch.schema.get_field_index(key)).is_null().to_numpy(zero_copy_only=False)
        out = []
        for w, stats in spec.items():
            told, n = frame_statistics(x, there, behind, w, stats)
            n = n[:, kept:]
            for i in range(len(sensors)):
                for st in stats:
                    least = max(w if full else 1, 2 if st == "std" else 1)
                    out.append(pa.array(told[st][i, kept:], mask=(n[i] < least) | nameless))
        yield pa.RecordBatch.from_arrays([*batch.columns[:rows_at], *out], names=[*batch.schema.names[:rows_at], *names])
        first = max(len(behind) - halo, 0) if halo else len(behind)
        x, there, behind = x[:, first:], there[:, first:], behind[first:]


def _rolled(df: DataFrame, spec: Mapping[int, Sequence[str]], sensors: Sequence[str], part: Sequence[str],
            order: Sequence[Column], key: str, min_periods: str) -> DataFrame:
    """``df`` with the statistics of ``rolling_exprs``. A window aggregates every frame anew for each
    row; here the rows, sorted in their tasks, are taken in Arrow batches, a frame's shift for all rows of a
    batch at once. Sensors that are not doubles keep Spark's arithmetic, in windows."""
    spec = {int(w): list(stats) for w, stats in spec.items()}
    types = {f.name: f.dataType for f in df.schema.fields}
    if any(types[s] != T.DoubleType() for s in sensors):
        return df.select("*", *rolling_exprs(spec, sensors, part, order, key, min_periods))
    names = [f"{s}_{w}h_{st}" for w, stats in spec.items() for s in sensors for st in stats]
    sensors, full = list(sensors), min_periods == "full"
    work = lambda batches: _rolled_batches(batches, spec, sensors, key, full, names)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    # the row's number: its window deals and sorts the rows, without an exchange where a table is bucketed
    return df.withColumn("_number", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).mapInArrow(work, schema)


def rolling_features(df: DataFrame, sensors: Sequence[str] = S.SENSORS,
                     windows: Sequence[int] = S.WINDOWS, stats: Sequence[str] = S.STATS,
                     spec: Mapping[int, Sequence[str]] | None = None,
                     key: str = S.KEY, time: str = S.TIME, tie=None,
                     min_periods: str = "one", chunk_rows: int | None = None,
                     keep_chunk: bool = False) -> DataFrame:
    """W1 (and W2 via ``spec``, W3 via ``min_periods='full'``).

    ``tie``: column(s) that order readings with equal ``time`` (pandas keeps file order).
    ``chunk_rows``: split machines with more rows than this into chunks of so many (skew);
    ``'auto'`` decides from the largest machine's row count (one aggregation);
    ``keep_chunk`` keeps the chunk number as column ``_chunk`` (0 for machines not split).
    """
    spec = dict(spec or default_spec(windows, stats))
    order = _order(time, tie)
    if chunk_rows == "auto":
        chunk_rows = auto_chunk_rows(df, key)
    if not chunk_rows:
        return _rolled(df, spec, sensors, [key], order, key, min_periods)
    return _chunked_rolling(df, spec, sensors, key, time, tie, min_periods, int(chunk_rows), keep_chunk)


# A machine with more rows than this is cut into chunks of so many rows (one window task each).
CHUNK_ROWS = 2_000_000


def auto_chunk_rows(df: DataFrame, key: str, limit: int = CHUNK_ROWS) -> int | None:
    """``limit`` when some machine holds more rows than that, else None (a partial
    count per machine, then the maximum; only the key column is read)."""
    top = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return limit if (top or 0) > limit else None


def rolling_preview(df: DataFrame, machine_id=None, sensors: Sequence[str] = S.SENSORS,
                    windows: Sequence[int] = S.WINDOWS, key: str = S.KEY, time: str = S.TIME,
                    tie=None, chunk_rows=None) -> DataFrame:
    """W3 (+ P3 with ``machine_id``): mean and std with ``min_periods = window`` and no
    fill, for one machine or for all (``chunk_rows`` splits very long histories)."""
    one = df if machine_id is None else df.filter(F.col(key) == F.lit(machine_id))
    return rolling_features(one, sensors, spec={w: ["mean", "std"] for w in windows},
                            key=key, time=time, tie=tie, min_periods="full", chunk_rows=chunk_rows)


BASELINE_SPEC = {3: ["mean", "std"], 24: ["mean"]}


def rolling_baseline(df: DataFrame, sensors: Sequence[str] = S.SENSORS, **kw) -> DataFrame:
    """The notebook's 16 features (3-row mean and std, 24-row mean) plus raw sensors."""
    return rolling_features(df, sensors, spec=BASELINE_SPEC, **kw)


# ---------------------------------------------------------------- skew-safe plan
def _chunked_rolling(df, spec, sensors, key, time, tie, min_periods, chunk_rows, keep_chunk=False,
                     with_summary=False):
    halo = max(int(w) for w in spec) - 1
    chunk_rows = max(chunk_rows, halo + 1)
    order = [*_order(time, tie), F.col("_row").asc_nulls_last()]
    # One partial aggregation; machines above chunk_rows are at most rows/chunk_rows. The
    # table is written once and broadcast only after that bound is checked.
    hot = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                        .filter(F.col(key).isNotNull() & (F.col("_n") > chunk_rows)))
    near = F.broadcast if _bounded(hot, 100_000) else (lambda side: side)
    # Every row of a busy machine gets an id of its own, written once: rows that agree in
    # time and tie stay different rows, in one order, in every later pass.
    busy = materialize(df.join(near(hot), key, "left_semi").withColumn("_row", F.monotonically_increasing_id()))
    at = global_row_index(busy, [F.col(key).asc_nulls_last(), *order], name="_pos", written=True)
    # where a busy machine begins: the rows of the busy machines before it
    first = global_scan(hot, [key], sums=["_n"], written=True).select(key, (F.col("_n_cum") - F.col("_n")).alias("_first"))
    if with_summary:
        at = materialize(at)   # read by several branches
    at = at.join(near(first), key).withColumn("_at", F.col("_pos") - F.col("_first"))
    # Chunks of chunk_rows rows; the last `halo` rows of a chunk also go to the next one as context.
    own = F.floor(F.col("_at") / chunk_rows).cast("long")
    places = F.array(F.struct(own.alias("_chunk"), F.lit(False).alias("_ctx")),
                     F.when(F.pmod("_at", F.lit(chunk_rows)) >= chunk_rows - halo,
                            F.struct((own + 1).alias("_chunk"), F.lit(True).alias("_ctx"))))
    at = at.withColumn("_place", F.explode(F.filter(places, lambda p: p.isNotNull()))) \
           .select(*df.columns, "_row", "_place._chunk", "_place._ctx")
    cold = df.join(near(hot), key, "left_anti") \
             .select("*", F.lit(None).cast("long").alias("_row"), F.lit(0).cast("long").alias("_chunk"), F.lit(False).alias("_ctx"))
    tagged = cold.filter(F.col(key).isNotNull()).unionByName(at)
    part = [key, "_chunk"]
    exprs = rolling_exprs(spec, sensors, part, order, key, min_periods)
    stat_cols = [f"{s}_{int(w)}h_{st}" for w, stats in spec.items() for s in sensors for st in stats]
    chunked = at.select("*", *exprs).filter(~F.col("_ctx")).drop("_ctx")
    whole = _rolled(cold.filter(F.col(key).isNotNull()).drop("_ctx"), spec, sensors, [key], _order(time, tie), key, min_periods)
    rolled = chunked.unionByName(whole)
    # rows without a machine have no statistics: they see no window
    nameless = cold.filter(F.col(key).isNull())
    rolled = rolled.select(*df.columns, "_row", "_chunk", *stat_cols)
    rolled = rolled.unionByName(nameless.drop("_ctx").select("*", *[F.lit(None).cast("double").alias(c) for c in stat_cols]))
    if not with_summary:
        return rolled.select(*df.columns, *stat_cols, *(["_chunk"] if keep_chunk else []))
    # The last rows of every chunk (a top-k Spark limits before the shuffle): the last
    # halo+1 of 2*halo+1 rows have their whole window among them.
    newest = Window.partitionBy(*part).orderBy(*_reverse_order(time, tie), F.col("_row").desc_nulls_first())
    tails = tagged.withColumn("_rd", F.row_number().over(newest)).filter(F.col("_rd") <= 2 * halo + 1)
    columns = list(sensors) + stat_cols
    okey = order_key(time, [*([] if tie is None else [tie] if isinstance(tie, str) else list(tie)), "_row"])
    exact = tails.select("*", *exprs).filter(~F.col("_ctx") & (F.col("_rd") <= halo + 1))
    summ = materialize(exact.groupBy(key, "_chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(c) for c in columns]))
    unresolved = F.lit(False)
    for c in columns:
        unresolved = unresolved | F.col(c).isNull()
    # groups where a column is NULL in all exact tail rows: their whole rolled rows
    redo_keys = summ.filter(unresolved).select(key, "_chunk")
    full = tagged.join(redo_keys, [key, "_chunk"], "left_semi").select("*", *exprs).filter(~F.col("_ctx"))
    redo_summ = full.groupBy(key, "_chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(c) for c in columns])
    nul = nameless.groupBy(key, "_chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(c) for c in sensors],
        *[F.lit(None).cast("double").alias(c) for c in stat_cols])
    summary = summ.filter(~unresolved).unionByName(redo_summ).unionByName(nul.select(key, "_chunk", *columns))
    return rolled, summary


def chunked_rolling_with_summary(df: DataFrame, sensors: Sequence[str] = S.SENSORS,
                                 windows: Sequence[int] = S.WINDOWS, stats: Sequence[str] = S.STATS,
                                 key: str = S.KEY, time: str = S.TIME, tie=None, chunk_rows: int = CHUNK_ROWS):
    """(rolled table with ``_chunk`` and the row id ``_row``, per-(machine, chunk) last non-null value of every
    sensor and statistic) -- the summary comes from the small edge set, not from a
    second pass over the rolled table."""
    spec = default_spec(windows, stats)
    return _chunked_rolling(df, spec, sensors, key, time, tie, "one", int(chunk_rows), keep_chunk=True,
                            with_summary=True)


def _bounded(df: DataFrame, max_rows: int) -> bool:
    """Size check before a broadcast: True when ``df`` has at most ``max_rows`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows
