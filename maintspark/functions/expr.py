"""Column-expression builders shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

_EPOCH = "1970-01-01 00:00:00"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(c) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ (or TIMESTAMP) column, time-zone free."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), col(c).cast("timestamp_ntz"))


def add_micros(c, micros) -> Column:
    return F.timestamp_add("MICROSECOND", micros if isinstance(micros, Column) else F.lit(micros), col(c))


def safe_div(num, den, default: float = 0.0) -> Column:
    """num/den as double; ``default`` when den is 0 or NULL (reference: 0 when the denominator is 0)."""
    num, den = col(num), col(den)
    return F.when(den.isNotNull() & (den != 0), num.cast("double") / den.cast("double")).otherwise(F.lit(default))


def risk_band(p, thresholds=S.RISK_THRESHOLDS) -> Column:
    """``p < lo`` LOW, ``p < hi`` MEDIUM, else HIGH."""
    lo, hi = thresholds
    p = col(p)
    return F.when(p < lo, "LOW").when(p < hi, "MEDIUM").otherwise("HIGH")


def risk_band_strict(p, thresholds=S.STRICT_RISK_THRESHOLDS) -> Column:
    """Notebook banding: ``p > hi`` HIGH, ``p > lo`` MEDIUM, else LOW."""
    lo, hi = thresholds
    p = col(p)
    return F.when(p > hi, "HIGH").when(p > lo, "MEDIUM").otherwise("LOW")


def decision(p, threshold: float = S.DECISION_THRESHOLD) -> Column:
    return (col(p) > threshold).cast("int")


def quality_band(auc, high: float = 0.85, mid: float = 0.75) -> Column:
    a = col(auc)
    return F.when(a >= high, "EXCELLENT").when(a >= mid, "GOOD").otherwise("NEEDS_IMPROVEMENT")


def md5_bucket(*keys, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 from the first 32 bits of md5 of the key text."""
    text = F.concat_ws("|", *[col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for engine-independent comparison only)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def is_missing(c, dtype) -> Column:
    """NULL, or NaN for floating columns (pandas counts both as missing)."""
    c = col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """pandas skips NaN in statistics; Spark treats NaN as a value. Turn NaN into NULL on load."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    targets = set(columns or [n for n, t in fields.items() if isinstance(t, (T.DoubleType, T.FloatType))])
    return df.select(*[F.nanvl(F.col(n), F.lit(None).cast(fields[n])).alias(n) if n in targets else F.col(n)
                       for n in df.columns])


def floor_time(c, micros: int) -> Column:
    """Start of the ``micros``-wide bucket holding ``c`` (TIMESTAMP_NTZ, time-zone free)."""
    n = F.floor(epoch_micros(c) / F.lit(micros)).cast("long")
    return F.timestamp_add("MICROSECOND", n * F.lit(micros), F.lit(_EPOCH).cast("timestamp_ntz"))


def bucket_number(c, micros: int) -> Column:
    return F.floor(epoch_micros(c) / F.lit(micros)).cast("long")


def bucket_start(n, micros: int) -> Column:
    return F.timestamp_add("MICROSECOND", col(n) * F.lit(micros), F.lit(_EPOCH).cast("timestamp_ntz"))
