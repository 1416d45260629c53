"""Mixing sources to target weights by Pareto order sampling.

A document expects ``e = min(cap, c * w)`` copies, ``w`` its weight and ``c`` set per source so
that the expected words meet the source's target. ``floor(e)`` copies are certain. For the
rest, ``pi = e - floor(e)``, documents are ranked within their source by random odds over
inclusion odds, ``(u / (1 - u)) / (pi / (1 - pi))``, and taken from the least rank on until the
source has the words it still lacks: a sample of fixed size, in words, with unequal
probabilities. Weights fall slowly with the size class (power of two of the words), so that
a few very long documents don't fill a source's remainder.

The cut needs the running sum of a source in rank order. Ranks are binned (``BINS`` bins a
source), bins are summed where the rows are, and only the bin in which the target falls is
ordered row by row, so a source with a third of all rows is no single task.

Defined results: a null text has size 0; size 0 is never taken; a null source is a source
of its own, last in order; equal rows (id, source, text) are one unit of several copies, of
which any may be the ones taken; null ids are ids like others; reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ordered import global_row_index
from .store import write_table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BINS = 1 << 13
#: Sources (about 60 bytes each) that may be broadcast.
BROADCAST_SOURCES = 200_000
#: Decisions on units (about 60 bytes each) that may be broadcast to the documents.
BROADCAST_UNITS = 400_000
SEED = 20240613


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(source):
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def units(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, skey, source, size, h) with ``n`` equal rows each."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(text).alias("size"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h")) \
        .groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("n")) \
        .withColumn("skey", _key(F.col("source")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sizes(skey, source, source_size)`` -> with ``target``: sources by code point, null last,
    weigh ``weights`` in turn and share ``share`` of all words; a target stops at ``cap`` times
    its source's size and the excess is shared again until none is above."""
    turn = F.pmod("row_index", F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int"))
    # keys sort like sources ('s' + source), with the null source's key moved behind
    ranked = global_row_index(sizes.withColumn("o", F.when(F.col("source").isNull(), 1).otherwise(0)), ["o", "skey"])
    ranked = write_table(ranked.withColumn("w", w).withColumn("top", F.col("source_size") * float(cap)).drop("o", "row_index"),
                         "sources")
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    rate = 0.0
    while True:
        full = F.col("top") < F.col("w") * rate
        held, free = ranked.agg(F.sum(F.when(full, F.col("top")).otherwise(0.0)),
                                F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("w")))).first()
        new = (budget - held) / free if free else rate
        if not free or new <= rate:
            break
        rate = new
    return ranked.withColumn("target", F.least("top", F.col("w") * rate)).drop("w", "top")


def _source_rates(u: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Per source the ``c`` with sum(min(cap, c * w) * size) = target; null: all at the cap.

    At most 63 size classes a source, so its window is short."""
    cls = u.where("size > 0").groupBy("skey", "lv").agg(F.sum(F.col("size") * F.col("n")).cast("double").alias("s"), F.max("w").alias("w"))
    by = Window.partitionBy("skey").orderBy("lv")
    before = F.coalesce(F.sum("s").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(F.col("w") * F.col("s")).over(by.rowsBetween(0, Window.unboundedFollowing))
    c = cls.join(targets.select("skey", "target"), "skey") \
        .withColumn("c", (F.col("target") - before * cap) / rest)
    # the fewest classes at the cap with which the others stay within it
    ok = c.where(F.col("c") * F.col("w") <= cap).groupBy("skey").agg(F.min(F.struct("lv", "c")).alias("m")) \
        .select("skey", F.col("m.c").alias("c"))
    return targets.join(ok, "skey", "left")


def _near(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """One row a unit (equal rows): ``doc_id, skey, h, n, size, source_size, target``, the
    ``certain`` copies of every row, and for how many of the ``n`` rows one ``extra`` is taken."""
    u = write_table(units(docs, id_col, text_col, source_col)
                    .withColumn("lv", F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int"))
                    .withColumn("w", F.pow(F.lit(2.0), F.col("lv") / -8.0)), "units")
    sizes = u.groupBy("skey").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, weights, share, cap)
    plan = write_table(_source_rates(u, targets, float(cap)), "rates")
    sources = plan.count()
    e = F.when(F.col("size") == 0, 0.0).otherwise(F.least(F.lit(float(cap)), F.coalesce(F.col("c") * F.col("w"), F.lit(float(cap)))))
    x = u.join(_near(plan.select("skey", "target", "source_size", "c"), sources), "skey").withColumn("e", e) \
        .withColumn("certain", F.floor(F.col("e") + 1e-9)).withColumn("pi", F.greatest(F.col("e") - F.col("certain"), F.lit(0.0)))
    # 53 bits of a hash, never 0 or 1
    draw = (F.shiftrightunsigned(F.xxhash64("doc_id", "skey", "h", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    odds = (draw / (1 - draw)) / (F.col("pi") / (1 - F.col("pi")))
    x = x.withColumn("q", F.when(F.col("pi") > 1e-9, odds)) \
        .withColumn("bin", F.least(F.floor(F.col("q") / (1 + F.col("q")) * BINS), F.lit(BINS - 1)).cast("int"))
    # words still lacking a source, and the bin in which they are reached
    words = F.col("size") * F.col("n")
    lack = x.groupBy("skey").agg((F.first("target") - F.sum(F.col("certain") * words)).alias("lack"))
    per_bin = x.where("bin is not null").groupBy("skey", "bin").agg(F.sum(words).alias("s"))
    run = Window.partitionBy("skey").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cut = per_bin.withColumn("below", F.coalesce(F.sum("s").over(run), F.lit(0))).join(lack, "skey") \
        .where(F.col("below") < F.col("lack")).groupBy("skey") \
        .agg(F.max(F.struct("bin", "below", "lack")).alias("m")).select("skey", F.col("m.bin").alias("cut"), "m.below", "m.lack")
    cut = write_table(cut, "cuts")
    x = x.join(_near(cut, sources), "skey", "left")
    inside = x.where("bin = cut").select("doc_id", "skey", "h", "n", "size", "q", "below", "lack")
    rank = Window.partitionBy("skey").orderBy("q", "h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("lack") - F.col("below") - F.coalesce(F.sum(words).over(rank), F.lit(0))
    inside = inside.withColumn("some", F.least(F.greatest(F.floor(left / F.col("size") + 0.5), F.lit(0)), F.col("n")))
    inside = write_table(inside.select("doc_id", "skey", "h", "some"), "cut-bin")
    y = inside.withColumnRenamed("doc_id", "d2").withColumnRenamed("skey", "k2").withColumnRenamed("h", "h2")
    out = x.join(y, x.doc_id.eqNullSafe(y.d2) & (x.skey == y.k2) & (x.h == y.h2), "left")
    extra = F.coalesce("some", F.when(F.col("bin") < F.col("cut"), F.col("n")), F.lit(0)).cast("long")
    return out.select("doc_id", "skey", "h", "n", "size", "source_size", "target", "certain", extra.alias("extra"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row a document: ``doc_id, size, source_size, target, taken`` (words, repeats counted)."""
    d = decide(docs, **options).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
    copies = F.col("certain") + F.when(F.col("i") <= F.col("extra"), 1).otherwise(0)
    return d.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                    (copies * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: ``docs`` with every row as often as the mix takes it, all columns as
    they were. Where only some of a unit's equal rows get one more copy, those rows are
    numbered in a global order that is cut over all tasks."""
    d = write_table(decide(docs, id_col, text_col, source_col, **options), "mix")
    p = {c: f"_mix_{c}" for c in ("doc_id", "skey", "h", "n", "certain", "extra")}
    d = d.select(*[F.col(c).alias(a) for c, a in p.items()])
    on = docs[id_col].cast("long").eqNullSafe(F.col("_mix_doc_id")) & (_key(docs[source_col].cast("string")) == F.col("_mix_skey")) \
        & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col("_mix_h"))
    j = docs.join(F.broadcast(d) if d.count() <= BROADCAST_UNITS else d, on)
    part = (F.col("_mix_extra") > 0) & (F.col("_mix_extra") < F.col("_mix_n"))
    whole = j.where(~part).withColumn("_mix_more", F.when(F.col("_mix_extra") > 0, 1).otherwise(0))
    out = whole
    if not d.where(part).isEmpty():
        key = ["_mix_skey", "_mix_h", "_mix_doc_id"]
        rows = write_table(j.where(part).withColumn("_mix_at", F.monotonically_increasing_id()), "equal-rows")
        at = global_row_index(rows.select(*key, "_mix_at"), [*key, "_mix_at"], name="_mix_index")
        at = write_table(at, "numbered")
        # one unit a source is cut, so its source names it
        first = at.groupBy("_mix_skey").agg(F.min("_mix_index").alias("_mix_first"))
        at = at.join(first, "_mix_skey").select("_mix_at", (F.col("_mix_index") - F.col("_mix_first")).alias("_mix_i"))
        rows = rows.join(at, "_mix_at").withColumn("_mix_more", F.when(F.col("_mix_i") < F.col("_mix_extra"), 1).otherwise(0))
        out = whole.unionByName(rows.drop("_mix_at", "_mix_i"))
    copies = F.array_repeat(F.lit(1), (F.col("_mix_certain") + F.col("_mix_more")).cast("int"))
    return out.withColumn("_mix_copy", F.explode(copies)).select(*docs.columns)
