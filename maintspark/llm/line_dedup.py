"""Line dedup by a deletion-neighbourhood join over the words of lines.

Lines (between line feeds) are compared as sequences of lower-cased words. Lines of fewer
than ``MIN_WORDS`` words are never dropped; equal lines keep their earliest occurrence; of
lines of ``FUZZY_WORDS`` words or more within one word edit (a word inserted, deleted or
replaced) the earlier stays. Order: document id (null last), text hash, line number.

1. Every eligible line becomes a digest; equal lines are aggregated to their earliest occurrence.
2. Two lines within one edit have their first or their last half in common: of the shorter
   line's m words, prefix and suffix share m - 1 at least, so one of them (m - 1) / 2. Only
   distinct lines that share the hash of such a half with another go on, for m being their
   own length and one less. This drops no pair.
3. Those lines emit their deletion neighbourhood: a hashed key for every line with one word
   left out, with the place of the word, and the line's own key.
4. Lines with an equal key at an equal place differ by one replaced word at most, all of them
   mutually, so each is held against the earliest only. A line whose own key equals
   another's variant differs from it by one inserted word. No other pairs are within the
   bound, so no group has to be compared pair by pair.
5. Every such pair is verified on the words of both lines.

Defined results: a null text has no lines and stays null; an empty text has one empty line;
rows that are equal in id and text keep the same lines each; null ids are ordered last; extra
columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import global_row_index
from .store import drop_table, release_shuffles, write_table
from .textbytes import NOT_SPACE, Words, buffers, chunks, lean, mix

MIN_WORDS = 5
FUZZY_WORDS = 10
HALVES = ("a1", "a2", "a3", "a4")
#: Documents, and lines in them, that may be broadcast (20 bytes each, 24 a document).
BROADCAST_ROWS = 400_000


#: Modulus of the spans' polynomial hashes: a prime, so that sums of different words don't cancel by structure.
PRIME = np.uint64((1 << 61) - 1)
_STEP = 0x1D8AF066F2B2E6C7 % ((1 << 61) - 1)
_powers: dict[int, np.ndarray] = {}


def _reduce(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values below it, by halves of 31 bits."""
    k, low = np.uint64(31), np.uint64((1 << 31) - 1)
    ah, al, bh, bl = a >> k, a & low, b >> k, b & low
    mid = ah * bl + al * bh
    return _reduce(np.uint64(2) * (ah * bh) + (mid >> np.uint64(30)) + ((mid & np.uint64((1 << 30) - 1)) << k) + _reduce(al * bl))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """At least ``n`` powers of the step, or of its inverse, modulo the prime."""
    base = pow(_STEP, -1, int(PRIME)) if inverse else _STEP
    p = _powers.setdefault(base, np.ones(1, np.uint64))
    while len(p) < n:
        p = np.r_[p, _times(p, np.uint64(pow(base, len(p), int(PRIME))))]
    _powers[base] = p
    return p


class Spans:
    """Hashes of any span of a sequence of 64-bit values, by prefix sums."""

    def __init__(self, values: np.ndarray):
        self.p, self.inv = powers(len(values) + 1), powers(len(values) + 2, inverse=True)
        term = _times(_reduce(values), self.p[:len(values)])
        low, high = np.cumsum(term & np.uint64((1 << 31) - 1)), np.cumsum(term >> np.uint64(31))
        self.run = np.r_[np.zeros(1, np.uint64), _reduce(_times(_reduce(high), np.uint64(1 << 31)) + _reduce(low))]

    def raw(self, s, e):
        return _times(_reduce(self.run[e] + PRIME - self.run[s]), self.inv[s])

    def of(self, s, e):
        return mix(self.raw(s, e) + ((e - s).astype(np.uint64) << np.uint64(40)))

    def without(self, s, e, at):
        """Hash of span s..e with the value at ``at`` left out; the same as that of the shorter sequence."""
        rest = _times(_reduce(self.run[e] + PRIME - self.run[at + 1]), self.inv[s + 1])
        return mix(_reduce(self.raw(s, at) + rest) + ((e - s - 1).astype(np.uint64) << np.uint64(40)))


class Lines:
    """Lines of some texts: first word, last word + 1, document and number in it."""

    def __init__(self, texts: pa.Array):
        data, off = buffers(texts)
        null = np.asarray(texts.is_null())
        self.words = Words(data, off, NOT_SPACE)
        feed = np.flatnonzero(data == 10)
        doc_of_feed = np.searchsorted(off, feed, side="right") - 1
        per = np.bincount(doc_of_feed, minlength=len(off) - 1) + 1
        self.doc = np.repeat(np.arange(len(per)), per)
        before = np.cumsum(per) - per
        self.number = np.arange(len(self.doc)) - before[self.doc]
        start = np.empty(len(self.doc), np.int64)
        start[before] = off[:-1]
        inner = self.number > 0
        start[inner] = feed + 1
        first = np.searchsorted(self.words.start, start)
        self.s, self.e = first, np.r_[first[1:], len(self.words.start)]
        self.hashes = self.words.hashes()
        if null.any():
            keep = ~null[self.doc]
            self.doc, self.number, self.s, self.e = self.doc[keep], self.number[keep], self.s[keep], self.e[keep]


def _occurrences(batches):
    """(doc_id, h, line, d1, d2, n) of every eligible line, and a1..a4: its distinct halves, if long enough."""
    for batch in batches:
        for c in chunks(batch, "text"):
            ls = Lines(c.column(2))
            ok = ls.e - ls.s >= MIN_WORDS
            s, e, doc = ls.s[ok], ls.e[ok], ls.doc[ok]
            spans, other = Spans(ls.hashes), Spans(mix(ls.hashes))
            at = pa.array(doc)
            k, j = (e - s) // 2, (e - s - 1) // 2
            halves = np.stack([other.of(s, s + k), other.of(s, s + j), spans.of(e - k, e), spans.of(e - j, e)], axis=1).astype(np.int64)
            # the halves of an odd number of words are of one length: each is written once
            same = (e - s < FUZZY_WORDS)[:, None] | ((k == j)[:, None] & np.array([False, True, False, True]))
            yield pa.RecordBatch.from_arrays(
                [c.column(0).take(at), c.column(1).take(at), pa.array(ls.number[ok].astype(np.int32)),
                 pa.array(spans.of(s, e).astype(np.int64)), pa.array(other.of(s, e).astype(np.int64)), pa.array((e - s).astype(np.int32)),
                 *[pa.array(x, mask=gone) for x, gone in zip(halves.T, same.T)]],
                names=["doc_id", "h", "line", "d1", "d2", "n", "a1", "a2", "a3", "a4"])


def _line_words(batches):
    """(id, words, own, variants) of the wanted lines: rows (text, lines array<struct<line, id>>)."""
    for batch in batches:
        for c in chunks(batch, "text"):
            ls = Lines(c.column(0))
            want = c.column(1)
            wanted = want.flatten()
            doc = np.repeat(np.arange(c.num_rows), np.asarray(want.value_lengths()))
            number = np.asarray(wanted.field("line"))
            begin = np.searchsorted(ls.doc, np.arange(c.num_rows))
            i = begin[doc] + number
            s, e = ls.s[i], ls.e[i]
            n = e - s
            spans = Spans(ls.hashes)
            off = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s, n)
            ss, ee = np.repeat(s, n), np.repeat(e, n)
            variants = spans.without(ss, ee, at).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [wanted.field("id"), pa.ListArray.from_arrays(off, pa.array(ls.hashes[at].astype(np.int64))),
                 pa.array(spans.of(s, e).astype(np.int64)), pa.ListArray.from_arrays(off, pa.array(variants))],
                names=["id", "words", "own", "variants"])


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                       F.col(text_col).alias("text"))


def _by_document(docs: DataFrame, side: DataFrame, d_id: Column, d_hash: Column, lines: str, how: str) -> DataFrame:
    """Join per-document line arrays (k_id, k_h, ``lines``); broadcast only within the bound."""
    rows, inner = side.agg(F.count("*"), F.sum(F.size(lines))).first()
    if rows <= BROADCAST_ROWS and (inner or 0) <= 4 * BROADCAST_ROWS:
        side = F.broadcast(side)
    return docs.join(side, (d_hash == F.col("k_h")) & d_id.eqNullSafe(F.col("k_id")), how)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k_id, k_h, drop): per document with dropped lines their numbers (from 0)."""
    spark = docs.sparkSession
    src = _source(docs, id_col, text_col)
    seen = write_table(src.mapInArrow(lean(_occurrences), "doc_id long, h long, line int, d1 long, d2 long, n int, a1 long, a2 long, a3 long, a4 long"), "lines")
    order = F.struct(F.isnull("doc_id").alias("z"), "doc_id", "h", "line")
    distinct = write_table(seen.groupBy("d1", "d2").agg(F.min(order).alias("o"), F.count("*").alias("m"), F.min("n").alias("n"),
                                                        *[F.min(a).alias(a) for a in HALVES]), "distinct-lines")
    release_shuffles(spark)
    fuzzy = distinct.where(F.col("n") >= FUZZY_WORDS)
    ends = fuzzy.select("d1", "d2", F.explode(F.array_distinct(F.array_compact(F.array(*HALVES)))).alias("a"))
    shared = write_table(ends.groupBy("a").agg(F.count("*").alias("m")).where("m > 1").select("a"), "anchors")
    near = ends.join(shared, "a", "left_semi").select("d1", "d2").distinct()
    picked = write_table(fuzzy.join(near, ["d1", "d2"], "left_semi").select("d1", "d2", "o.*"), "candidates")
    drop_table(shared)
    release_shuffles(spark)
    ranked = write_table(global_row_index(picked, ["z", "doc_id", "h", "line"], name="id").select("d1", "d2", "doc_id", "h", "line", "id"), "ranked")
    drop_table(picked)
    release_shuffles(spark)
    per_doc = write_table(ranked.groupBy(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h"))
                          .agg(F.collect_list(F.struct("line", "id")).alias("lines")), "per-document")
    rows = _by_document(src, per_doc, F.col("doc_id"), F.col("h"), "lines", "inner") \
        .select("text", "lines")
    near_lines = write_table(rows.mapInArrow(lean(_line_words), "id long, words array<long>, own long, variants array<long>")
                             .dropDuplicates(["id"]), "neighbourhood")
    drop_table(per_doc)
    release_shuffles(spark)
    keys = near_lines.select("id", F.posexplode("variants").alias("at", "key"))
    # replaced word: all lines of a (key, place) against the earliest
    least = write_table(keys.groupBy("key", "at").agg(F.min("id").alias("e"), F.count("*").alias("m")).where("m > 1").drop("m"), "least")
    release_shuffles(spark)
    replaced = keys.join(least, ["key", "at"]).where("id <> e").select(F.col("id").alias("a"), F.col("e").alias("b"), "at")
    # inserted word: a line's own key among the others' variants
    own = near_lines.select(F.col("id").alias("short"), F.col("own").alias("key"))
    inserted = keys.join(own, "key").select("id", "short", "at")
    inserted = inserted.select(F.col("id").alias("a"), F.col("short").alias("b"), "at")
    w = near_lines.select("id", "words")
    pairs = replaced.unionByName(inserted).join(w.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a") \
        .join(w.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b")
    head, tail = F.slice("wa", F.lit(1), F.col("at")), F.slice("wa", F.col("at") + 2, F.size("wa"))
    cut = F.concat(head, tail)
    cut_b = F.concat(F.slice("wb", F.lit(1), F.col("at")), F.slice("wb", F.col("at") + 2, F.size("wb")))
    ok = F.when(F.size("wa") == F.size("wb"), cut == cut_b).otherwise(cut == F.col("wb"))
    late = pairs.where(ok).select(F.greatest("a", "b").alias("id")).distinct()
    late = write_table(ranked.join(late, "id", "left_semi").select("d1", "d2"), "late")
    for t in (ranked, near_lines, least):
        drop_table(t)
    release_shuffles(spark)
    # an occurrence goes if its line has an earlier neighbour, or is not the line's earliest
    many = distinct.where("m > 1").select("d1", "d2", "o")
    bad = write_table(many.join(late.withColumn("late", F.lit(True)), ["d1", "d2"], "full").select("d1", "d2", "o", "late"), "bad-lines")
    release_shuffles(spark)
    x = seen.join(bad, ["d1", "d2"]).where(F.coalesce("late", F.lit(False)) | (order != F.col("o")))
    drop = x.groupBy(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h")).agg(F.sort_array(F.collect_set("line")).alias("drop"))
    out = write_table(drop, "dropped")
    for t in (seen, distinct, late, bad):
        drop_table(t)
    release_shuffles(spark)
    return out


def _kept(text: Column) -> Column:
    # filter() passes the element's number
    return F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.coalesce(F.array_contains("drop", i), F.lit(False))), "\n")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, n_lines, n_dropped`` and ``kept_sha256`` of its kept text (null: of '')."""
    src = _source(docs, id_col, text_col)
    j = _by_document(src, dropped_lines(docs, id_col, text_col), F.col("doc_id"), F.col("h"), "drop", "left")
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    return j.select("doc_id", n.alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.sha2(F.coalesce(_kept(F.col("text")), F.lit("")), 256).alias("kept_sha256"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = True) -> DataFrame:
    """``docs`` with duplicate lines cut out of the text. ``drop_emptied``: a document that
    lost lines and has no line with a word left is a copy and goes."""
    d = dropped_lines(docs, id_col, text_col)
    names = list(docs.columns)
    inner = docs.select(F.struct("*").alias("row"))  # own columns can't clash with those of the join
    text, key = F.col(f"row.`{text_col}`"), F.col(f"row.`{id_col}`").cast("long")
    j = _by_document(inner, d, key, F.xxhash64(F.coalesce(text, F.lit(""))), "drop", "left")
    if drop_emptied:
        j = j.where(F.col("drop").isNull() | _kept(text).rlike(r"[^\x20\x09-\x0D]"))
    kept = F.when(F.col("drop").isNull(), text).otherwise(_kept(text))
    return j.select(*[(kept if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in names])
