"""Prefix computations in a *global* order without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves the whole input into one
task. The plan here is the classic two-pass scan:

1. range-partition the input on the order key and tag each row with its
   partition id; the tagged table is written so that both passes below see the
   same partition of every row (also after an executor loss);
2. one summary row per partition (sum, or last non-null value) -> the exclusive
   prefix over at most ``n`` partition rows, joined back by broadcast
   (bounded by ``n``, the partition count we chose);
3. the running value inside each partition (a window per partition id),
   combined with the carry of all earlier partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .sizing import materialize

_PID = "_scan_pid"
# Inputs with a proven row count up to this size are scanned in one task.
SINGLE_TASK_ROWS = 100_000
# Target rows per range partition of the distributed scan.
ROWS_PER_PARTITION = 1_000_000


def _order_cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _tagged(df: DataFrame, order: Sequence, num_partitions: int | None, written: bool = False) -> DataFrame:
    """Range-partitioned, partition-tagged and checkpointed copy of ``df``.

    The input is written once (``written``: it is a written table already); its count, the range sampling and the shuffle read that table.
    The number of range partitions follows the row count (about ``ROWS_PER_PARTITION`` each);
    an input of at most ``SINGLE_TASK_ROWS`` rows is one partition."""
    spark = df.sparkSession
    src = df if written else materialize(df, "scan")
    rows = src.count()
    if rows <= SINGLE_TASK_ROWS:
        return src.coalesce(1).withColumn(_PID, F.lit(0))
    n = num_partitions or min(shuffle_partitions(spark), -(-rows // ROWS_PER_PARTITION))
    ranged = src.repartitionByRange(max(n, 2), *_order_cols(order)).withColumn(_PID, F.spark_partition_id())
    return materialize(ranged, "ranges")


def global_scan(df: DataFrame, order: Sequence, sums: Sequence[str] = (),
                carries: Sequence[str] = (), num_partitions: int | None = None,
                known_rows: int | None = None, written: bool = False) -> DataFrame:
    """Add ``{c}_cum`` (inclusive running sum) for ``sums`` and ``{c}_prev``
    (last non-null value strictly before the row) for ``carries``.

    ``order`` must be a total order (unique) for a deterministic result.
    ``known_rows``: an exact row count of ``df`` the caller already has; at most
    ``SINGLE_TASK_ROWS`` rows are scanned in one task (no sampling, no checkpoint).
    ``written``: ``df`` reads a materialized table, so it need not be written again.
    """
    if known_rows is not None and known_rows <= SINGLE_TASK_ROWS:
        tagged = df.withColumn(_PID, F.lit(0))
    else:
        tagged = _tagged(df, order, num_partitions, written)
    ocols = _order_cols(order)

    # Per-partition summaries: totals and the last non-null value of each carry column.
    # The position of a row inside its partition is its order key; max_by over a
    # struct of the order columns picks the last row.
    summary_aggs = [F.sum(c).alias(f"_tot_{c}") for c in sums]
    if carries:   # (order given as plain columns here: a struct of them ranks the rows)
        okey = F.struct(*ocols)
        summary_aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(f"_last_{c}")
                         for c in carries]
    summary = tagged.groupBy(_PID).agg(*summary_aggs)
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)   # <= n rows
    carry_cols = [F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_base_{c}") for c in sums]
    carry_cols += [F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_base_{c}") for c in carries]
    bases = summary.select(_PID, *carry_cols)

    inside = Window.partitionBy(_PID).orderBy(*ocols)
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.select(
        "*",
        *[F.sum(c).over(run).alias(f"_run_{c}") for c in sums],
        *[F.last(c, ignorenulls=True).over(prev).alias(f"_runp_{c}") for c in carries],
    )
    out = local.join(F.broadcast(bases), _PID, "left")   # bases: one row per partition
    out = out.select(
        *[c for c in df.columns],
        *[(F.col(f"_base_{c}") + F.col(f"_run_{c}")).alias(f"{c}_cum") for c in sums],
        *[F.coalesce(F.col(f"_runp_{c}"), F.col(f"_base_{c}")).alias(f"{c}_prev") for c in carries],
    )
    return out


def global_row_index(df: DataFrame, order: Sequence, num_partitions: int | None = None,
                     name: str = "row_index", written: bool = False) -> DataFrame:
    """0-based position of every row in the global order (a distributed zipWithIndex)."""
    one = "_one_for_index"
    out = global_scan(df.withColumn(one, F.lit(1)), order, sums=[one], num_partitions=num_partitions, written=written)
    return out.withColumn(name, F.col(f"{one}_cum") - 1).drop(one, f"{one}_cum")
