"""Size checks that guard every broadcast."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Rows of a narrow side table that may be broadcast (a few tens of MB at most).
BROADCAST_ROWS = 2_000_000


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads at most max_rows+1 rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after the row bound is checked; otherwise a shuffle join
    (AQE may still turn it into a broadcast from runtime sizes)."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read back: its
    lineage ends there, and nothing is kept on the executors. Use it for tables read by
    several jobs or branches of a plan, which Spark would otherwise compute for each."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files no plan holds any more, instead of whenever
    the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
