"""Exact quantiles with linear interpolation (pandas ``quantile``/``describe``), distributed.

Spark's exact ``percentile`` aggregate keeps a value->count map per group and merges it in one
task, which does not survive a column with billions of distinct values; a sort of the table
would move all of it for a few values. Here every (column, quantile) is a bracketed selection:

1. one pass over the columns: counts, moments and a quantile sketch, whose values a little
   below and above the quantile bracket it (the sketch's error is bounded);
2. one pass that counts the values below and inside each bracket exactly; a bracket that the
   counts show to miss the rank is widened, one that holds more than ``PICK_ROWS`` values is
   sketched again inside;
3. the values inside are counted per distinct value (map-side first, so a value that fills
   the column is one row a task) and the two neighbours of the rank are picked by running
   sums over at most ``PICK_ROWS`` rows.

The driver sees one row of bounds and counts a pass. ``approx=True`` stops after the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of a bracket that are looked at one by one.
PICK_ROWS = 200_000
#: Accuracy of the sketches: ranks are off by 1/ACCURACY of the values at most.
ACCURACY = 10_000


def long_values(df: DataFrame, columns: Sequence[str], name: str = "column") -> DataFrame:
    """(column, value) for the non-null, non-NaN values of ``columns`` (pandas skips NaN)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("value"))
                                for c in columns])).alias("_p")
    return df.select(pairs).select("_p.*").where(F.col("value").isNotNull() & ~F.isnan("value"))


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles ``_0, _1, ...``; NaN counts as missing (as pandas does)."""
    d = [F.col(c).cast("double") for c in columns]
    return df.select(*[F.when(~F.isnan(c), c).alias(f"_{i}") for i, c in enumerate(d)])


def _inside(column: str, low: float, high: float) -> Column:
    return F.col(column).between(F.lit(low), F.lit(high))


class _Target:
    """One quantile of one column and the bracket of values that holds its rank."""

    def __init__(self, column: int, q: float, n: int, low: float, high: float):
        self.column, self.q = f"_{column}", q
        self.pos = (n - 1) * q
        self.lo, self.hi = math.floor(self.pos), math.ceil(self.pos)
        self.low, self.high = low, high
        self.below = self.count = None

    def holds(self) -> bool:
        return self.below <= self.lo and self.hi < self.below + self.count


def _bracket(sketch: Sequence[float]) -> tuple[float, float]:
    return float(sketch[0]), float(sketch[-1])


def _around(q: float) -> list[float]:
    """Fractions that lie on both sides of ``q`` whatever the sketch's error."""
    return [max(q - 3.0 / ACCURACY, 0.0), min(q + 3.0 / ACCURACY, 1.0)]


def _narrow(wide: DataFrame, targets: Sequence[_Target], ends: dict[str, tuple[float, float]], pick_rows: int) -> None:
    """Count the brackets; widen those that miss their rank, sketch again inside large ones."""
    open_ = list(targets)
    while open_:
        told = wide.agg(*[F.count_if(F.col(t.column) < F.lit(t.low)).alias(f"b{i}") for i, t in enumerate(open_)],
                        *[F.count_if(_inside(t.column, t.low, t.high)).alias(f"c{i}") for i, t in enumerate(open_)]).first()
        large, again = [], []
        for i, t in enumerate(open_):
            t.below, t.count = told[f"b{i}"], told[f"c{i}"]
            if not t.holds():
                t.low, t.high = ends[t.column]
                again.append(t)
            elif t.count > pick_rows and t.low < t.high:
                large.append(t)
        if large:
            # fractions inside the bracket; one value that fills it is a bracket of its own
            told = wide.agg(*[F.percentile_approx(F.when(_inside(t.column, t.low, t.high), F.col(t.column)),
                                                  [_around((t.lo - t.below) / t.count)[0], _around((t.hi - t.below) / t.count)[1]],
                                                  ACCURACY).alias(f"s{i}") for i, t in enumerate(large)]).first()
            for i, t in enumerate(large):
                low, high = _bracket(told[f"s{i}"])
                if (low, high) != (t.low, t.high):
                    t.low, t.high = low, high
                    again.append(t)
        open_ = again


def _picked(wide: DataFrame, targets: Sequence[_Target]) -> DataFrame:
    """(t, lo_value, hi_value): the values at the two ranks of every target."""
    cells = F.array(*[F.struct(F.lit(i).alias("t"), F.col(t.column).alias("v"), _inside(t.column, t.low, t.high).alias("in"))
                      for i, t in enumerate(targets)])
    found = wide.select(F.explode(F.filter(cells, lambda x: F.coalesce(x["in"], F.lit(False)))).alias("x"))
    counts = found.groupBy("x.t", "x.v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select("t", "v", "n", upto.alias("upto"))
    rank = lambda of: F.element_at(F.array(*[F.lit(of(t)) for t in targets]), F.col("t") + 1)
    at = lambda r: (F.col("upto") - F.col("n") <= r) & (r < F.col("upto"))
    lo, hi = rank(lambda t: t.lo - t.below), rank(lambda t: t.hi - t.below)
    return ranked.groupBy("t").agg(F.max(F.when(at(lo), F.col("v"))).alias("lo_value"), F.max(F.when(at(hi), F.col("v"))).alias("hi_value"))


def _summary(wide: DataFrame, width: int, probs: Sequence[float]):
    """One row: per column its count, mean, sample deviation, ends and sketch."""
    fractions = [f for q in probs for f in _around(q)]
    aggs = []
    for i in range(width):
        c = F.col(f"_{i}")
        aggs += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"mean{i}"), F.stddev_samp(c).alias(f"std{i}"),
                 F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}"), F.percentile_approx(c, fractions, ACCURACY).alias(f"s{i}")]
    return wide.agg(*aggs).first()


def _exact(wide: DataFrame, columns: Sequence[str], probs: Sequence[float], told, name: str, pick_rows: int) -> DataFrame:
    ends = {f"_{i}": (told[f"min{i}"], told[f"max{i}"]) for i in range(len(columns))}
    targets = []
    for i in range(len(columns)):
        n = told[f"n{i}"]
        for k, q in enumerate(probs):
            if n:
                few = n <= pick_rows
                low, high = ends[f"_{i}"] if few else _bracket(told[f"s{i}"][2 * k:2 * k + 2])
                targets.append(t := _Target(i, q, n, low, high))
                if few:
                    t.below, t.count = 0, n
    spark = wide.sparkSession
    if not targets:
        return spark.createDataFrame([], f"`{name}` string, q double, value double")
    _narrow(wide, [t for t in targets if t.count is None], ends, pick_rows)
    names = F.array(*[F.lit(columns[int(t.column[1:])]) for t in targets])
    of = lambda f: F.element_at(F.array(*[F.lit(float(f(t))) for t in targets]), F.col("t") + 1)
    value = F.col("lo_value") + (F.col("hi_value") - F.col("lo_value")) * of(lambda t: t.pos - t.lo)
    return _picked(wide, targets).select(F.element_at(names, F.col("t") + 1).alias(name), of(lambda t: t.q).alias("q"), value.alias("value"))


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], approx: bool = False,
              name: str = "column", pick_rows: int = PICK_ROWS) -> DataFrame:
    """Long table (column, q, value); columns without a value have no rows."""
    probs, columns = [float(p) for p in probs], list(columns)
    wide = _numbers(df, columns)
    if approx:
        told = wide.agg(*[F.percentile_approx(f"_{i}", probs, 100000).alias(c) for i, c in enumerate(columns)])
        return (told.select(F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias("vals"))
                                                for c in columns])).alias("_r"))
                    .select("_r.*")
                    .select(name, F.posexplode("vals").alias("i", "value"))
                    .select(name, F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("i") + 1).alias("q"),
                            "value"))
    return _exact(wide, columns, probs, _summary(wide, len(columns), probs), name, pick_rows)


def describe(df: DataFrame, columns: Sequence[str], approx: bool = False, name: str = "column",
             pick_rows: int = PICK_ROWS) -> DataFrame:
    """A5: pandas ``describe`` per column: count, mean, std, min, 25%, 50%, 75%, max."""
    probs, columns = [0.25, 0.5, 0.75], list(columns)
    wide = _numbers(df, columns)
    told = _summary(wide, len(columns), probs)
    q = quantiles(df, columns, probs, approx=True, name=name) if approx else _exact(wide, columns, probs, told, name, pick_rows)
    rows = [(c, told[f"n{i}"], told[f"mean{i}"], told[f"std{i}"], told[f"min{i}"], told[f"max{i}"])
            for i, c in enumerate(columns) if told[f"n{i}"]]
    moments = df.sparkSession.createDataFrame(rows, f"`{name}` string, count long, mean double, std double, min double, max double")
    three = q.groupBy(name).agg(*[F.max(F.when(F.col("q") == p, F.col("value"))).alias(f"p{int(100 * p)}") for p in probs])
    return F.broadcast(moments).join(three, name).select(name, "count", "mean", "std", "min", "p25", "p50", "p75", "max")
