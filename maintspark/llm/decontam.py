"""Benchmark decontamination with suffix arrays over shards of the training text.

Each task cuts its documents into shards of about ``SHARD_WORDS`` words and sorts the
shard's suffixes (prefix doubling on word ids). Every suffix of every benchmark item is
looked up in that array by binary search, all of them at once: the neighbours of its place
give its longest verbatim match and where it lies; for suffixes that match a whole window,
two more searches give the range of all suffixes that begin with the window, which are all
its occurrences. Documents are not shuffled, so a hot source or a group of copies is dealt
like any other rows. The benchmark is the stated query set: it is read in blocks of at most
``block_bytes`` of text, and only one block at a time is in a task's memory.

Defined results: a null or empty text has no words and is never contaminated; items
without words have no window; items with equal ids count once; an item whose id is null
counts as the id ``''``; repeated documents get the same result each; extra columns of
``docs`` are left alone whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textbytes import ALNUM, chunks, lean, ranges, words

WINDOW = 13
#: Words of a shard; a longer document makes a shard of its own.
SHARD_WORDS = 1 << 18
#: Text bytes of the benchmark in one broadcast block.
BLOCK_BYTES = 32 << 20

REPORT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                       T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
                       T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType())])


# --- suffix array of a shard -------------------------------------------------------------

def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``ids`` sorted by the ``depth`` words that follow (ties in any order).

    Prefix doubling; after the first round only groups that still tie are sorted again."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = ids.astype(np.int64)
    # rank = first place of its group
    sorted_ids = ids[order]
    head = np.flatnonzero(np.r_[True, sorted_ids[1:] != sorted_ids[:-1]])
    size = np.diff(np.r_[head, n])
    rank[order] = np.repeat(head, size)
    h = 1
    while h < depth:
        tied = np.repeat(size > 1, size)
        at = np.flatnonzero(tied)
        if not len(at):
            break
        pos = order[at]
        nxt = np.where(pos + h < n, rank[np.minimum(pos + h, n - 1)] + 1, 0)
        key = rank[pos] * np.int64(n + 2) + nxt
        by = np.argsort(key, kind="stable")
        pos, key = pos[by], key[by]
        order[at] = pos
        new = np.r_[True, key[1:] != key[:-1]]
        rank[pos] = np.repeat(at[new], np.diff(np.r_[np.flatnonzero(new), len(at)]))
        ranks = rank[order]
        head = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        size = np.diff(np.r_[head, n])
        h *= 2
    return order


def _common(shard: np.ndarray, at: np.ndarray, bench: np.ndarray, q: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Words that the shard from ``at`` and the benchmark from ``q`` have in common, up to ``length``."""
    out = np.zeros(len(q), dtype=np.int64)
    live = np.flatnonzero((at >= 0) & (at < len(shard)) & (length > 0))
    k = 0
    while len(live):
        live = live[(at[live] + k < len(shard)) & (k < length[live])]
        live = live[shard[at[live] + k] == bench[q[live] + k]]
        out[live] = k = k + 1
    return out


def search(shard: np.ndarray, order: np.ndarray, bench: np.ndarray, q: np.ndarray, length: np.ndarray,
           after: bool) -> np.ndarray:
    """For each query ``bench[q : q+length]`` the number of suffixes that are smaller than it
    (``after``: or begin with it), by binary search for all queries together."""
    n = len(order)
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), n, np.int64)
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        at, qq, ll = order[mid], q[open_], length[open_]
        same = _common(shard, at, bench, qq, ll)
        inside = same < ll
        s = np.where(at + same < n, shard[np.minimum(at + same, n - 1)], -1)
        b = bench[np.minimum(qq + same, len(bench) - 1)]
        less = np.where(inside, s < b, after)
        lo[open_] = np.where(less, mid + 1, lo[open_])
        hi[open_] = np.where(less, hi[open_], mid)


# --- benchmark block ---------------------------------------------------------------------

class Block:
    """The items of one block: word hashes, item bounds, and the suffixes that have a window."""

    def __init__(self, ids: list, texts: list, window: int):
        w = words(pa.array(texts, pa.large_string()), ALNUM)
        self.ids = ["" if i is None else str(i) for i in ids]
        self.hash, off = w.hashes(), w.offsets
        n = np.diff(off)
        self.item = np.repeat(np.arange(len(ids)), n)
        self.left = np.repeat(off[1:], n) - np.arange(len(self.hash))  # words up to the item's end
        first = np.arange(len(self.hash)) == np.repeat(off[:-1], n)
        size = np.repeat(n, n)
        #: length of the window that begins here, 0 for none
        self.window = np.where(self.left >= window, window, np.where(first & (size < window), size, 0))
        self.depth = int(n.max()) if len(n) else 0


def shard_matches(hashes: np.ndarray, block: Block) -> tuple[np.ndarray, ...]:
    """Look up every suffix of the block's items in one shard.

    ``hashes``: the shard's words, 0 between documents. Returns per benchmark suffix its
    longest match (words) and its place in the shard, and the windows' occurrences:
    (first place in the suffix array, end, benchmark suffix) and the suffix array."""
    uniq, ids = np.unique(hashes, return_inverse=True)
    at = np.searchsorted(uniq, block.hash)
    found = (at < len(uniq)) & (uniq[np.minimum(at, len(uniq) - 1)] == block.hash)
    shard = 2 * ids.astype(np.int64) + 1
    bench = np.where(found, 2 * at + 1, 2 * at)  # a word that the shard lacks sorts between its words
    order = suffix_array(ids, max(block.depth, 1))
    q = np.arange(len(bench))
    place = search(shard, order, bench, q, block.left, after=False)
    best, where = np.zeros(len(q), np.int64), np.full(len(q), -1)
    for near in (place - 1, place):
        ok = (near >= 0) & (near < len(order))
        pos = np.where(ok, order[np.clip(near, 0, len(order) - 1)], -1)
        same = _common(shard, pos, bench, q, block.left)
        better = same > best
        best, where = np.where(better, same, best), np.where(better, pos, where)
    whole = np.flatnonzero((block.window > 0) & (best >= block.window))
    lo = search(shard, order, bench, whole, block.window[whole], after=False)
    hi = search(shard, order, bench, whole, block.window[whole], after=True)
    return best, where, lo, hi, whole, order


def _shards(batch: pa.RecordBatch, text_col: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, words with a 0 after each document, first word of each document, its words)."""
    for rows in chunks(batch, text_col, 6 * SHARD_WORDS):
        w = words(rows.column(rows.schema.get_field_index(text_col)), ALNUM)
        n = np.diff(w.offsets)
        start = w.offsets[:-1] + np.arange(len(n))
        hashes = np.zeros(len(w.start) + len(n), np.uint64)
        hashes[np.arange(len(w.start)) + np.repeat(np.arange(len(n)), n)] = w.hashes()
        yield rows, hashes, start, n


def _document_hits(hashes, start, n, block: Block):
    """Hit words of a shard (bool) and the distinct (document, item id) pairs, from one block."""
    hit = np.zeros(len(hashes) + 1, np.int64)
    doc = np.zeros(0, np.int64)
    item = np.zeros(0, np.int64)
    if len(block.hash) and n.sum():
        _, _, lo, hi, whole, order = shard_matches(hashes, block)
        if len(whole):
            # equal windows have the same range: mark each range once
            keys, back = np.unique(np.stack([lo, hi, block.window[whole]]), axis=1, return_inverse=True)
            back = back.ravel()
            size = keys[1] - keys[0]
            pos = order[ranges(keys[0], size)]
            length = np.repeat(keys[2], size)
            np.add.at(hit, pos, 1)
            np.add.at(hit, pos + length, -1)
            docs = np.searchsorted(start, pos, side="right") - 1
            pair = np.unique(np.stack([np.repeat(np.arange(len(size)), size), docs]), axis=1)
            of = np.searchsorted(pair[0], np.arange(len(size) + 1))
            per = (of[1:] - of[:-1])[back]  # documents of each window
            doc = pair[1][ranges(of[:-1][back], per)]
            item = np.repeat(block.item[whole], per)
            both = np.unique(np.stack([doc, item]), axis=1)
            doc, item = both
    return np.cumsum(hit[:-1]) > 0, doc, item


def items_digest(ids) -> str:
    return hashlib.sha256(",".join(sorted(set(ids))).encode()).hexdigest()


def _judge(hit: np.ndarray, start, n, doc, names):
    run = np.r_[0, np.cumsum(hit)]
    n_hit = run[start + n] - run[start]
    by = np.argsort(doc, kind="stable")
    cut = np.searchsorted(doc[by], np.arange(len(n) + 1))
    of = [[names[j] for j in by[a:b]] for a, b in zip(cut[:-1], cut[1:])]
    return n_hit, of


# --- benchmark blocks --------------------------------------------------------------------

def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int, window: int):
    """Yield the benchmark block by block. Blocks are dealt by item hash so that each is
    expected to hold half of ``block_bytes``; a block found larger is read in parts."""
    bench = benchmark.select(F.col(item_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    total = bench.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    k = max(1, -(-2 * total // block_bytes) if total > block_bytes else 1)
    bench = bench.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(k)))
    for b in range(k):
        ids, texts, size = [], [], 0
        part = bench.where(F.col("b") == b).orderBy("i", "t")
        for r in (part.toLocalIterator() if k > 1 else part.collect()):
            ids.append(r.i)
            texts.append(r.t)
            size += len(r.t.encode())
            if size >= block_bytes:
                yield Block(ids, texts, window)
                ids, texts, size = [], [], 0
        if ids or k == 1:
            yield Block(ids, texts, window)


# --- operators ---------------------------------------------------------------------------

def _scan(block, text_col: str, finish, schema: T.StructType):
    """``finish(rows, hit, start, n, doc, names) -> RecordBatch`` over every shard."""
    def run(batches):
        b = block.value
        for batch in batches:
            for rows, hashes, start, n in _shards(batch, text_col):
                hit, doc, item = _document_hits(hashes, start, n, b)
                yield finish(rows, hit, start, n, doc, [b.ids[i] for i in item])
    return lambda df: df.mapInArrow(lean(run), schema)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  percent: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: its words, the words inside any occurrence of a benchmark window,
    the items with such windows, and whether at least ``percent`` of its words are hit.

    A benchmark of several blocks takes one pass a block; the passes' hits meet by document
    (id and text hash) and are merged there."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = benchmark_blocks(benchmark, item_col, item_text, block_bytes, window)
    first = next(blocks)
    second = next(blocks, None)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                        ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])

    def verdict(rows, hit, start, n, doc, names):
        n_hit, of = _judge(hit, start, n, doc, names)
        return pa.RecordBatch.from_arrays([
            rows.column(0), pa.array(n), pa.array(n_hit), pa.array([len(set(x)) for x in of], pa.int64()),
            pa.array([items_digest(x) for x in of], pa.string()),
            pa.array((n_hit > 0) & (100 * n_hit >= percent * n))], schema=schema)

    if second is None:
        return _scan(spark.sparkContext.broadcast(first), "text", verdict, REPORT)(src)
    part = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("h", T.LongType()),
                         T.StructField("n", T.LongType()), T.StructField("hit", T.ArrayType(T.LongType())),
                         T.StructField("items", T.ArrayType(T.StringType()))])

    def spans(rows, hit, start, n, doc, names):
        """Hit runs as alternating starts and ends, in words of the document."""
        _, of = _judge(hit, start, n, doc, names)
        runs = []
        for s, k in zip(start, n):
            edge = np.diff(np.r_[0, hit[s:s + k].astype(np.int8), 0])
            runs.append(np.flatnonzero(edge).tolist())
        return pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(n),
                                           pa.array(runs, pa.list_(pa.int64())),
                                           pa.array(of, pa.list_(pa.string()))],
                                          names=["doc_id", "h", "n", "hit", "items"])

    keyed = src.withColumn("h", F.xxhash64("text"))
    parts, todo = None, [first, second]
    while todo:
        block = spark.sparkContext.broadcast(todo.pop(0))
        got = _scan(block, "text", spans, part)(keyed)
        # copies of a row have the same hits; only one is needed beside the rows themselves
        got = got.where(F.size("hit") > 0)
        parts = got if parts is None else parts.unionByName(got)
        if not todo and (more := next(blocks, None)) is not None:
            todo.append(more)

    def merge(batches):
        for batch in batches:
            rows = batch.to_pydict()
            n_hit = []
            for k, runs in zip(rows["n"], rows["hit"]):
                mark = np.zeros((k or 0) + 1, np.int64)
                flat = np.array([x for r in runs or [] for x in r], np.int64)
                np.add.at(mark, flat[::2], 1)
                np.add.at(mark, flat[1::2], -1)
                n_hit.append(int((np.cumsum(mark) > 0).sum()))
            names = [{x for r in of or [] for x in r} for of in rows["items"]]
            n, hits = np.array(rows["n"], np.int64), np.array(n_hit, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(rows["doc_id"], pa.int64()), pa.array(n), pa.array(hits),
                pa.array([len(x) for x in names], pa.int64()), pa.array([items_digest(x) for x in names]),
                pa.array((hits > 0) & (100 * hits >= percent * n))], schema=schema)

    merged = parts.groupBy("doc_id", "h").agg(F.collect_set("hit").alias("hit"), F.collect_set("items").alias("items"))
    one = lambda c: F.regexp_count(F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                   F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    left = keyed.select("doc_id", "h", F.coalesce(one(F.col("text")), F.lit(0)).cast("long").alias("n")).alias("l")
    joined = left.join(merged.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.h") == F.col("r.h")), "left")
    return joined.select("l.doc_id", "l.n", "r.hit", "r.items").mapInArrow(merge, REPORT)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text: str = "text", window: int = WINDOW, percent: int = 5,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated rows, all columns as they were. One pass over the
    documents a benchmark block of ``block_bytes``; with several blocks the hits of a document
    are judged together (see :func:`contamination`)."""
    spark = docs.sparkSession
    blocks = benchmark_blocks(benchmark, item_col, item_text, block_bytes, window)
    first = next(blocks)
    if next(blocks, None) is None:
        schema = docs.schema

        def keep(rows, hit, start, n, doc, names):
            run = np.r_[0, np.cumsum(hit)]
            n_hit = run[start + n] - run[start]
            return rows.filter(pa.array(~((n_hit > 0) & (100 * n_hit >= percent * n))))

        return _scan(spark.sparkContext.broadcast(first), text_col, keep, schema)(docs)
    # the verdict depends on the text alone: judge by text hash
    told = contamination(docs.select(F.xxhash64(text_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark,
                         item_col=item_col, item_text=item_text, window=window, percent=percent, block_bytes=block_bytes)
    bad = told.where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, F.xxhash64(docs[text_col]) == F.col("_bad"), "left_anti")


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per benchmark item its longest verbatim match: ``item_id`` (as text), ``n_words``, the
    first word of the match in the item (``item_word``), ``doc_id`` and ``doc_word``. Items
    that share no word with any document are absent; of equally long matches the smallest
    (doc_id, doc_word, item_word) is told of those that the shards report."""
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("n_words", T.LongType()),
                           T.StructField("item_word", T.LongType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("doc_word", T.LongType())])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in benchmark_blocks(benchmark, item_col, item_text, block_bytes, window):
        held = spark.sparkContext.broadcast(block)

        def run(batches, held=held):
            b = held.value
            first = np.flatnonzero(np.r_[True, b.item[1:] != b.item[:-1]]) if len(b.item) else np.zeros(0, np.int64)
            begin = np.zeros(len(b.ids), np.int64)
            begin[b.item[first]] = first
            for batch in batches:
                for rows, hashes, start, n in _shards(batch, "text"):
                    if not len(b.hash) or not n.sum():
                        continue
                    best, where, *_ = shard_matches(hashes, b)
                    top = np.lexsort((np.arange(len(best)), -best, b.item))
                    top = top[np.r_[True, b.item[top][1:] != b.item[top][:-1]]]
                    top = top[best[top] > 0]
                    doc = np.searchsorted(start, where[top], side="right") - 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b.ids[i] for i in b.item[top]], pa.string()), pa.array(best[top]),
                        pa.array(top - begin[b.item[top]]), rows.column(0).take(pa.array(doc)),
                        pa.array(where[top] - start[doc])],
                        names=["item_id", "n_words", "item_word", "doc_id", "doc_word"])

        got = src.mapInArrow(run, schema)
        out = got if out is None else out.unionByName(got)
    pick = F.struct((-F.col("n_words")).alias("k"), "doc_id", "doc_word", "item_word", "n_words")
    best = out.groupBy("item_id").agg(F.min(pick).alias("m"))
    return best.select("item_id", "m.n_words", "m.item_word", "m.doc_id", "m.doc_word")
