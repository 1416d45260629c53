"""Projection, filters, ordered head/tail, repeatable samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.expr import md5_bucket


def sensors_only(df: DataFrame, sensors: Sequence[str] = S.SENSORS) -> DataFrame:
    """P1."""
    return df.select(*sensors)


def machine(df: DataFrame, machine_id, key: str = S.KEY) -> DataFrame:
    """One machine (pushed down to the parquet scan as an equality filter)."""
    return df.filter(F.col(key) == F.lit(machine_id))


def head(df: DataFrame, n: int, order: Sequence[str], descending: bool = False) -> DataFrame:
    """First ``n`` rows in ``order`` (planned as TakeOrderedAndProject: a per-task top-n, no full sort)."""
    cols = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    return df.orderBy(*cols).limit(n)


def tail_per_key(df: DataFrame, n: int, key: str, order: Sequence[str], pos: str = "pos") -> DataFrame:
    """P10: the last ``n`` rows of every key; ``pos`` 1 is the newest.

    The window keeps a running row number and Spark's WindowGroupLimit drops rows
    beyond ``n`` before the window materialises them.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_first() for c in order])  # missing keys are last, so newest
    return df.withColumn(pos, F.row_number().over(w)).filter(F.col(pos) <= n)


def hash_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = S.RANDOM_STATE) -> DataFrame:
    """Fixed-size repeatable sample -- the ``n`` rows with the smallest
    ``md5(seed|keys)`` (a top-n, TakeOrderedAndProject); all rows when there are no more."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")


def percent_sample(df: DataFrame, percent: int, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose md5 bucket (0..99) of ``keys`` is below ``percent`` --
    repeatable, the same rows in batch and in a stream."""
    return df.filter(md5_bucket(*keys) < F.lit(percent))


def order_desc(df: DataFrame, by: str, tie: Sequence[str] = ()) -> DataFrame:
    """Sort by value descending with a deterministic tie order."""
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in tie])
