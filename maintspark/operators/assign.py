"""K7: champion/challenger assignment of keys to model versions by percentage.

The reference only sets endpoint traffic: the new model gets ``v`` %, every other
deployed version ``(100 - v) // n``. We turn that into a deterministic
assignment: a key's md5 bucket (0..99) is matched to the cumulative percentage
ranges, expanded to one row per bucket and joined on the bucket. The
integer-division leftover goes to the first existing version so the ranges
cover 0..99.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import md5_bucket


def traffic_split(existing: Sequence[str], new_version: str, new_percent: int) -> list[tuple[str, int]]:
    """[(version, percent)] -- the new version first, then the existing ones."""
    shares = [(new_version, int(new_percent))]
    if existing:
        each = (100 - int(new_percent)) // len(existing)
        rest = 100 - int(new_percent) - each * len(existing)
        shares += [(v, each + (rest if i == 0 else 0)) for i, v in enumerate(existing)]
    return shares


def split_table(spark: SparkSession, shares: Sequence[tuple[str, int]]) -> DataFrame:
    """(version, percent, lo, hi): bucket b goes to the version with lo <= b < hi."""
    rows, lo = [], 0
    for v, p in shares:
        rows.append((v, p, lo, lo + p))
        lo += p
    return spark.createDataFrame(rows, "version string, percent int, lo int, hi int")


def assign_versions(df: DataFrame, splits: DataFrame, key: str, bucket_col: str = "bucket") -> DataFrame:
    """Each row of ``df`` gets ``version`` by the md5 bucket of ``key``."""
    b = df.withColumn(bucket_col, md5_bucket(key))
    # one row per bucket (100 at most): an equi-join instead of a range comparison per version
    buckets = splits.where("lo < hi").select("version", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias(bucket_col))
    return b.join(F.broadcast(buckets), bucket_col, "left").select(*b.columns, "version")
