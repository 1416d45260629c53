"""Document fingerprints from prefix polynomial hashes.

The prefix arrays of a text hold, modulo two primes, the polynomial hash of its first i code
points, so the hash of any span costs two look-ups: spans are compared at once, and longest
common extensions are found by binary search. A fingerprint is the text's length, the hash
of the whole, and a sketch of the hashes of all its ``WIDTH``-point spans (the least of each
of ``SLOTS`` bins); the likeness of two fingerprints is the share of equal slots.

:func:`edited_neighbours` needs each document's successor in descending order of id. Ids are
cut into ranges that Spark's range partitioning finds; each row goes to its range once, and
the first row of a range also to the range before it, so texts are shuffled once and no
window runs over the whole table.

Defined results: a null text is empty; an empty text has a fingerprint without slots, which
is like itself only; null ids come last, rows of equal id follow by text hash, and equal rows
are each other's neighbours; a single document follows itself.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .textbytes import mix

#: Fixed: two primes below 2**31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 69069069)
WIDTH = 16
SLOTS = 64
RANGES_PER_PARTITION = 4
_tables: dict = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of a base and of its inverse, modulo its prime."""
    have = _tables.get(which)
    if have is None or len(have[0]) < n:
        p = PRIMES[which]
        made = []
        for b in (BASES[which], pow(BASES[which], -1, p)):
            a = np.ones(1, np.uint64)
            while len(a) < max(n, 1 << 14):
                a = np.r_[a, a * np.uint64(pow(b, len(a), p)) % np.uint64(p)]
            made.append(a)
        have = _tables[which] = made[0], made[1]
    return have


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.run = []
        for w, p in enumerate(PRIMES):
            power, _ = _powers(w, self.n + 1)
            run = np.zeros(self.n + 1, np.uint64)
            # terms are below 2**31, so sums of up to 2**33 of them fit
            np.cumsum(codes * power[:self.n] % np.uint64(p), out=run[1:])
            self.run.append(run % np.uint64(p))

    def spans(self, start: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the spans of ``length`` at ``start``: equal spans have equal hashes."""
        out = np.zeros(len(start), np.uint64)
        for w, p in enumerate(PRIMES):
            _, inverse = _powers(w, self.n + 1)
            q = np.uint64(p)
            h = (self.run[w][start + length] + q - self.run[w][start]) % q * inverse[start] % q
            out = (out << np.uint64(31)) | h
        return out

    def span(self, start: int, length: int) -> int:
        return int(self.spans(np.array([start]), length)[0])

    def common(self, i: int, other: PrefixHash, j: int) -> int:
        """Longest common extension of this text from ``i`` and another from ``j``, by binary search."""
        lo, hi = 0, min(self.n - i, other.n - j)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.span(i, mid) == other.span(j, mid):
                lo = mid
            else:
                hi = mid - 1
        return lo


def fingerprint(h: PrefixHash) -> str:
    """``length-whole-slots``; slots of 16 bits, 0 for a bin without spans."""
    slots = np.zeros(SLOTS, np.uint64)
    if h.n:
        width = min(WIDTH, h.n)
        v = mix(h.spans(np.arange(h.n - width + 1), width) + np.uint64(width))
        least = np.full(SLOTS, 2**64 - 1, np.uint64)
        np.minimum.at(least, (v % np.uint64(SLOTS)).astype(np.int64), v)
        some = least != np.uint64(2**64 - 1)
        slots[some] = mix(least[some]) % np.uint64(65535) + np.uint64(1)
    whole = h.span(0, h.n) if h.n else 0
    return f"{h.n:x}-{whole:016x}-{slots.astype('>u2').tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    """Share of the slots in use (by either) that agree; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x = np.frombuffer(bytes.fromhex(a.rsplit("-", 1)[1]), ">u2")
    y = np.frombuffer(bytes.fromhex(b.rsplit("-", 1)[1]), ">u2")
    used = (x > 0) | (y > 0)
    return float(((x == y) & used).sum() / used.sum()) if used.any() else 0.0


def _ranges(docs: DataFrame, n: int) -> list[tuple]:
    """First order key of each of at most ``n`` ranges: as many rows as ranges."""
    keys = docs.select("z", "nd", "h").repartitionByRange(n, "z", "nd", "h").withColumn("pid", F.spark_partition_id())
    rows = keys.groupBy("pid").agg(F.min(F.struct("z", "nd", "h")).alias("k")).collect()
    return sorted(tuple(r.k) for r in rows)


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document against its edited text (the last third replaced by the beginning of
    the next document, in descending order of id, the first after the last) and against that
    next document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` and the common beginnings ``common_edited, common_next``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")) \
        .select(F.isnull("doc_id").cast("int").alias("z"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("nd"),
                F.xxhash64("text").alias("h"), "doc_id", "text")
    n = shuffle_partitions(spark)
    heads = _ranges(src, RANGES_PER_PARTITION * n)
    last = len(heads) - 1

    def deal(batches):
        """(range, look) for each row; look 1: it is read ahead by the range before, 2: by the last."""
        for b in batches:
            keys = list(zip(*(b.column(i).to_pylist() for i in range(3))))
            at, rid, look = [], [], []
            for i, k in enumerate(keys):
                r = bisect.bisect_right(heads, k) - 1
                at.append(i), rid.append(r), look.append(0)
                if k == heads[r] and r:
                    at.append(i), rid.append(r - 1), look.append(1)
                if k == heads[0]:
                    at.append(i), rid.append(last), look.append(2)
            t = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int32()), pa.array(look, pa.int32()), *t.columns],
                                             names=["rid", "look", *b.schema.names])

    def pair(batches):
        wait = None  # (range, doc_id, text, prefix hash, fingerprint)
        for b in batches:
            out = []
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("rid", "look", "doc_id", "text")]
            for rid, look, doc_id, t in zip(*cols):
                h = PrefixHash(t)
                f = fingerprint(h)
                if wait is not None and wait[0] == rid:
                    _, d0, t0, h0, f0 = wait
                    m = h0.n // 3
                    edited = t0[:h0.n - m] + t[:m]
                    he = PrefixHash(edited)
                    fe = fingerprint(he)
                    out.append((d0, h0.n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), f0, fe,
                                likeness(f0, fe), likeness(f0, f), h0.common(0, he, 0), h0.common(0, h, 0)))
                wait = (rid, doc_id, t, h, f) if not look else None
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(list(zip(*out)) or [()] * 9, types)], names=names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
             "common_edited", "common_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    dealt = src.mapInArrow(deal, "rid int, look int, z int, nd long, h long, doc_id long, text string")
    return dealt.repartition(n, "rid").sortWithinPartitions("rid", "look", "z", "nd", "h") \
        .mapInArrow(pair, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                          "near_edited double, near_next double, common_edited long, common_next long")
