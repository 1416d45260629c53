"""Katz backoff bigram model: trained and evaluated where its counts lie.

1. Texts become blocks of about ``BLOCK_BYTES``: the block's own vocabulary (64-bit word
   hashes) and its tokens as numbers in it. Every document ends with one end token.
2. Vocabularies go to parts by ranges of hashes, which add up the words' training counts. Words
   are numbered by falling count (0: unknown), part by part, and the numbers handed back to the
   blocks; since numbers follow counts, a table of the distinct counts tells every number's count.
3. A block's distinct bigrams, each once with its training count, go to parts by their context
   (the word before; the start before the first). A context with very many tokens is cut by the
   next word as well, in pieces by its count, so no part holds more than a bounded share. A
   frequent bigram is one entry a block, however often it occurs there. Each part's rows become
   one row of the model table: its distinct bigrams with training counts, and which of them
   every block asks for.
4. Counts of counts are summed over the parts; they give the Good-Turing discounts. The sums of
   cut contexts are summed by context and joined back to their parts.
5. Each bigram is evaluated recursively: a seen bigram has its discounted share; an unseen one
   gets the context's backoff weight times the word's probability; an unknown context leaves
   the word's probability; an unknown word has the whole unseen mass of the unigrams. Weights
   are exact: ``alpha = (1 - sum of seen P(w|v)) / (1 - sum of their P(w))``.
6. The answers go back to the blocks, whose tokens look them up; log probabilities are summed
   per document.

Defined results: a null text is empty and has its end token only; without training documents
every token is unknown; documents with a null id are held in training (they have no
remainder); equal rows are scored each.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import global_scan
from ..session import shuffle_partitions
from .store import drop_table, release_shuffles, write_table
from .textbytes import NOT_SPACE, chunks, lean, mix, words

BLOCK_BYTES = 8 << 20
PART_TOKENS = 1_000_000
#: Discounts apply to counts up to this (Katz's k).
DISCOUNT_TO = 5
#: Contexts are cut by the next word into one piece for every 1 / (HOT * parts) of the tokens.
HOT = 4
END = np.uint64(2)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def pack(a: np.ndarray) -> bytes:
    """Bytes of an integer array, byte planes apart, zstd."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return a.dtype.str.encode() + len(a).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if len(a) else b"")


def unpack(b: bytes) -> np.ndarray:
    kind, n = np.dtype(b[:3].decode()), int.from_bytes(b[3:11], "little")
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(b[11:], n * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
    return planes.reshape(kind.itemsize, n).T.copy().view(kind).ravel()


def _rows(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


# --- blocks ------------------------------------------------------------------------------

BLOCKS = "block long, n_vocab long, vocab binary, train binary, tokens binary, ends binary, doc_id array<long>, held array<boolean>"


def _blocks(batches):
    from pyspark import TaskContext
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for c in chunks(batch, "text", BLOCK_BYTES):
            # hashed in small pieces: a block's arrays per word are small, those per byte are not
            got = [(np.diff(w.offsets), w.hashes()) for w in (words(x.column(2), NOT_SPACE) for x in chunks(c, "text"))]
            n, hashes = (np.concatenate(x) for x in zip(*got))
            ends = np.cumsum(n + 1)  # first token of the next document
            h = np.empty(ends[-1], np.uint64)
            h[ends - 1] = END
            h[np.arange(len(hashes)) + np.repeat(np.arange(len(n)), n)] = hashes
            vocab, ids = np.unique(h, return_inverse=True)
            held = np.asarray(c.column(1).fill_null(False)).astype(bool)
            train = np.bincount(ids, np.repeat(~held, n + 1), len(vocab)).astype(np.int64)
            yield _rows(block=pa.array([block]), n_vocab=pa.array([len(vocab)]), vocab=pa.array([pack(np.diff(vocab, prepend=np.uint64(0)))], pa.binary()), train=pa.array([pack(train)], pa.binary()),
                        tokens=pa.array([pack(ids.astype(np.uint32))], pa.binary()), ends=pa.array([pack(ends)], pa.binary()),
                        doc_id=pa.array([c.column(0).to_pylist()], pa.list_(pa.int64())), held=pa.array([held.tolist()], pa.list_(pa.bool_())))
            block += 1


def _each(batches):
    for b in batches:
        for row in range(b.num_rows):
            yield {k: b.column(i)[row].as_py() for i, k in enumerate(b.schema.names)}


# --- words -------------------------------------------------------------------------------

def _words_asked(parts: int):
    """Blocks -> (part, block, word, n): the words of a part, a range of hashes, with their training counts."""
    def run(batches):
        for row in _each(batches):
            word, n = np.cumsum(unpack(row["vocab"]), dtype=np.uint64), unpack(row["train"])
            part = ((word >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
            at = np.flatnonzero(np.diff(part, prepend=-1))
            cut = list(zip(at, np.r_[at[1:], len(part)]))
            yield _rows(part=pa.array(part[at]), block=pa.array(np.full(len(at), row["block"])),
                        word=pa.array([pack(np.diff(word[i:j], prepend=np.uint64(0))) for i, j in cut], pa.binary()),
                        n=pa.array([pack(n[i:j]) for i, j in cut], pa.binary()))
    return run


WORDS = "part int, n binary, starts long, block binary, size binary, pair binary"


def _word_part(table: pa.Table) -> pa.Table:
    """All rows of a part -> its row: the counts of its words, those of the end token, and what
    every block asks for (its words' places, as steps)."""
    each, n = ([unpack(x.as_py()) for x in table.column(k)] for k in ("word", "n"))
    size = np.array([len(x) for x in each], np.int64)
    word, pair = np.unique(np.concatenate([np.cumsum(x, dtype=np.uint64) for x in each]), return_inverse=True)
    n = np.bincount(pair, np.concatenate(n), len(word)).astype(np.int64)
    row = {"n": pack(n), "block": pack(np.asarray(table.column("block"))), "size": pack(size), "pair": pack(np.diff(pair, prepend=0))}
    return pa.table({"part": table.column("part")[:1], "starts": pa.array([int(n[word == END].sum())]),
                     **{k: pa.array([x], pa.binary()) for k, x in row.items()}}).select(["part", "n", "starts", "block", "size", "pair"])


def _classes(batches):
    """(part, c, k): how many words of a part have the count c."""
    for row in _each(batches):
        n = unpack(row["n"])
        c, k = np.unique(n[n > 0], return_counts=True)
        yield _rows(part=pa.array(np.full(len(c), row["part"], np.int32)), c=pa.array(c), k=pa.array(k.astype(np.int64)))


def _asked(row: dict):
    """(block, places) of every block that asks a part."""
    pair, size = np.cumsum(unpack(row["pair"])), unpack(row["size"])
    for block, to, k in zip(unpack(row["block"]).tolist(), np.cumsum(size).tolist(), size.tolist()):
        yield block, pair[to - k:to]


def _word_numbers(batches):
    """(block, part, ids): the numbers of a block's words. ``first``: number of the part's first word of a count."""
    for row in _each(batches):
        n = unpack(row["n"])
        first = {r["c"]: r["first"] for r in row["first"] or ()}
        order = np.argsort(-n, kind="stable")
        c, at, k = np.unique(-n[order], return_index=True, return_counts=True)
        ids = np.zeros(len(n), np.int64)
        ids[order] = np.where(n[order] > 0, np.repeat(np.array([first.get(-x, 0) for x in c.tolist()], np.int64) - at, k) + np.arange(len(n)), 0)
        for block, places in _asked(row):
            yield _rows(block=pa.array([block]), part=pa.array([row["part"]], pa.int32()), ids=pa.array([pack(ids[places])], pa.binary()))


NUMBERED = "block long, tokens binary, ends binary, doc_id array<long>, held array<boolean>"


def _put(block: pa.Table, answers: pa.Table) -> pa.Table:
    told = sorted(zip(answers.column("part").to_pylist(), answers.column("ids").to_pylist()))
    number = np.concatenate([unpack(ids) for _, ids in told])  # parts are ranges of the sorted vocabulary
    ids = number[unpack(block.column("tokens")[0].as_py())]
    ids = ids.astype(np.uint32 if ids.max() < 2**32 else np.uint64)
    return pa.table({"block": block.column("block"), "tokens": pa.array([pack(ids)], pa.binary()),
                     **{k: block.column(k) for k in ("ends", "doc_id", "held")}})


def _numbered(blocks: DataFrame) -> tuple[DataFrame, dict[int, int], int]:
    """Blocks with every token as the corpus-wide number of its word; {count: number of words};
    training documents."""
    spark = blocks.sparkSession
    entries = blocks.agg(F.sum("n_vocab")).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-entries // PART_TOKENS))
    words_ = blocks.select("block", "vocab", "train").mapInArrow(lean(_words_asked(parts)), "part int, block long, word binary, n binary") \
        .groupBy("part").applyInArrow(_word_part, WORDS)
    words_ = write_table(words_, "words")
    release_shuffles(spark)
    classes = write_table(words_.select("part", "n").mapInArrow(lean(_classes), "part int, c long, k long"), "word-classes")
    # distinct counts: their sum is the number of tokens at most, so there are few (its square root)
    told = {r.c: r.k for r in classes.groupBy("c").agg(F.sum("k").alias("k")).collect()}
    starts = words_.agg(F.sum("starts")).first()[0] or 0
    first = global_scan(classes, [F.col("c").desc(), F.col("part").asc()], sums=["k"]) \
        .groupBy("part").agg(F.collect_list(F.struct("c", (F.col("k_cum") - F.col("k") + 1).alias("first"))).alias("first"))
    answers = words_.join(first, "part", "left").mapInArrow(lean(_word_numbers), "block long, part int, ids binary")
    out = blocks.select("block", "tokens", "ends", "doc_id", "held").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_put, NUMBERED)
    out = write_table(out, "numbered-blocks")
    drop_table(words_)
    drop_table(classes)
    return out, told, starts


# --- discounts ---------------------------------------------------------------------------

def discounts(counts_of_counts: dict[int, int], k: int = DISCOUNT_TO) -> np.ndarray:
    """Katz's Good-Turing factors for counts 0..k+1 (0 and k+1: 1). Where the counts of counts
    give no factor between 0 and 1, it is (r - 1/2) / r."""
    n = [counts_of_counts.get(r, 0) for r in range(k + 3)]
    d = np.ones(k + 2)
    tail = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        x = -1.0
        if n[r] and n[r + 1] and tail < 1:
            x = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
        d[r] = x if 0 < x < 1 else (r - 0.5) / r
    return d


class Unigrams:
    """P(w) by count: discounted shares; the unknown word has all of the rest. ``classes``:
    {count: number of words}; a word's number tells its count. ``starts``: training documents."""

    def __init__(self, classes: dict[int, int], starts: int = 0):
        self.starts = starts
        self.counts = np.array(sorted(classes, reverse=True), np.int64)
        words_ = np.array([classes[c] for c in self.counts.tolist()], np.int64)
        self.last = np.cumsum(words_)  # numbers up to this have at least the count
        self.total, self.distinct = int((self.counts * words_).sum()), int(words_.sum())
        self.start = self.distinct + 1  # number of the start
        self.d = discounts(classes)
        lost = sum(classes.get(r, 0) * r * (1 - self.d[r]) for r in range(1, DISCOUNT_TO + 1))
        # without any discounted word, one occurrence is set aside
        self.scale = 0.0 if not self.total else 1.0 / self.total if lost > 0 else 1.0 / (self.total + 1)
        self.unknown = 1.0 if not self.total else (lost or 1.0) * self.scale

    def count(self, ids: np.ndarray) -> np.ndarray:
        known = (ids > 0) & (ids <= self.distinct)
        at = np.searchsorted(self.last, ids, side="left")
        return np.where(known, np.r_[self.counts, 0][np.minimum(at, len(self.counts))], 0)

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d[np.minimum(c, DISCOUNT_TO + 1)] * c * self.scale, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def pieces(self, v: np.ndarray, parts: int) -> np.ndarray:
        """Parts that a context goes to: HOT for every mean part's worth of tokens. No counts hang
        on the unknown word, so it goes to all."""
        n = np.where(v == self.start, self.starts, self.count(v))
        return np.where(v == 0, parts, np.clip(-(-n * HOT * parts // max(self.total, 1)), 1, parts))


# --- parts -------------------------------------------------------------------------------

class _Pairs:
    """A block's distinct bigrams in the order (part, v, w): all parts get theirs and answer in that order."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, uni: Unigrams, parts: int):
        self.start = np.r_[0, ends[:-1]]
        before = np.r_[uni.start, ids[:-1]]
        before[self.start] = uni.start
        if uni.start < 2**32:
            order = np.argsort(before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64), kind="stable")
        else:
            order = np.lexsort((ids, before))
        v, w = before[order], ids[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        self.first = np.flatnonzero(new)
        v, w = v[new], w[new]
        pieces = uni.pieces(v, parts).astype(np.uint64)
        part = mix(v.astype(np.uint64) + _STEP)
        cut = pieces > 1
        part[cut] = mix(part[cut] + mix(w[cut].astype(np.uint64) + _STEP) % pieces[cut] * _STEP)
        part = (part % np.uint64(parts)).astype(np.int32)
        by = np.argsort(part, kind="stable")
        self.part, self.v, self.w, self.order, self.by = part[by], v[by], w[by], order, by
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        #: a token's place among the bigrams
        self.of = np.empty(len(ids), np.int64)
        self.of[order] = place[np.cumsum(new) - 1]

    def count(self, train: np.ndarray) -> np.ndarray:
        """Tokens of training documents a bigram."""
        return np.add.reduceat(train[self.order].astype(np.int64), self.first)[self.by]


def _requests(parts: int, uni: Unigrams):
    """Blocks -> (part, block, v, w, n): a block's distinct bigrams of a part, with its training counts."""
    def run(batches):
        for b in batches:
            col = {k: b.column(i) for i, k in enumerate(b.schema.names)}
            for row in range(b.num_rows):
                ids, ends = unpack(col["tokens"][row].as_py()).astype(np.int64), unpack(col["ends"][row].as_py())
                pairs = _Pairs(ids, ends, uni, parts)
                n = pairs.count(np.repeat(~np.array(col["held"][row].as_py(), bool), np.diff(np.r_[0, ends])))
                kind = np.uint32 if uni.start < 2**32 else np.uint64
                at = np.flatnonzero(np.diff(pairs.part, prepend=-1))
                to = np.r_[at[1:], len(pairs.part)]
                for lo in range(0, len(at), 64):
                    cut = list(zip(at[lo:lo + 64], to[lo:lo + 64]))
                    yield _rows(part=pa.array(pairs.part[at[lo:lo + 64]]), block=pa.array([col["block"][row].as_py()] * len(cut), pa.int64()),
                                v=pa.array([pack(np.diff(pairs.v[i:j], prepend=0).astype(kind)) for i, j in cut], pa.binary()),
                                w=pa.array([pack(pairs.w[i:j].astype(kind)) for i, j in cut], pa.binary()),
                                n=pa.array([pack(n[i:j]) for i, j in cut], pa.binary()))
    return run


PART = "part int, v binary, w binary, n binary, block binary, size binary, pair binary"


def _model_part(table: pa.Table) -> pa.Table:
    """All rows of a part -> its row of the model table: distinct bigrams (v as steps, w) with
    training counts n, and what every block asks for (its bigrams' numbers, as steps)."""
    each = {k: [unpack(x.as_py()) for x in table.column(k)] for k in ("v", "w", "n")}
    size = np.array([len(x) for x in each["w"]], np.int64)
    kind = each["w"][0].dtype
    v = np.concatenate([np.cumsum(x.astype(np.int64)) for x in each["v"]])
    w, n = np.concatenate(each["w"]), np.concatenate(each["n"])
    del each
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    pair = np.empty(len(v), np.int64)
    pair[order] = np.cumsum(new) - 1
    n = np.add.reduceat(n[order], np.flatnonzero(new))
    row = {"part": table.column("part")[0].as_py(), "v": pack(np.diff(v[new], prepend=0).astype(kind)), "w": pack(w[new]), "n": pack(n),
           "block": pack(np.asarray(table.column("block"))), "size": pack(size), "pair": pack(np.diff(pair, prepend=0))}
    return pa.table({k: pa.array([x], pa.int32() if k == "part" else pa.binary()) for k, x in row.items()})


class _Part:
    """The bigrams of a row of the model table, with the sums of its contexts."""

    def __init__(self, row: dict, uni: Unigrams):
        get = lambda k: unpack(row[k])
        self.v, self.vi = np.unique(np.cumsum(get("v").astype(np.int64)), return_inverse=True)
        self.w_count = uni.count(get("w").astype(np.int64))
        self.n = get("n")
        seen = self.n > 0
        vi, n, k = self.vi[seen], self.n[seen], len(self.v)
        #: training tokens, bigrams by count 1..k, sum of the seen words' P(w)
        self.total = np.bincount(vi, n, k)
        self.by = np.stack([np.bincount(vi[n == r], minlength=k) for r in range(1, DISCOUNT_TO + 1)], axis=1).astype(float)
        self.seen_p = np.bincount(vi, uni.p(self.w_count[seen]), k)


def _counts_of_counts(batches):
    for row in _each(batches):
        at = np.bincount(np.minimum(unpack(row["n"]), DISCOUNT_TO + 2), minlength=DISCOUNT_TO + 2)
        yield _rows(r=pa.array(np.arange(1, DISCOUNT_TO + 2)), n=pa.array(at[1:DISCOUNT_TO + 2].astype(np.int64)))


SUMS = ["total", "p", *[f"r{r}" for r in range(1, DISCOUNT_TO + 1)]]


def _cut_sums(uni: Unigrams, parts: int):
    """A part's share of the sums of the contexts that lie in several parts."""
    def run(batches):
        for row in _each(batches):
            m = _Part(row, uni)
            at = np.flatnonzero((m.v > 0) & (uni.pieces(m.v, parts) > 1))
            yield _rows(part=pa.array(np.full(len(at), row["part"], np.int32)), v=pa.array(m.v[at]), total=pa.array(m.total[at].astype(float)),
                        p=pa.array(m.seen_p[at]), **{f"r{j + 1}": pa.array(m.by[at, j]) for j in range(DISCOUNT_TO)})
    return run


def _whole_contexts(model: DataFrame, uni: Unigrams, parts: int) -> DataFrame:
    """(part, cut): the whole sums of those contexts of a part that lie in other parts too. A
    context is cut by its count, so there are a few rows a part."""
    cut = model.select("part", "v", "w", "n").mapInArrow(lean(_cut_sums(uni, parts)), "part int, v long, " + ", ".join(f"{k} double" for k in SUMS))
    cut = write_table(cut, "cut-contexts")
    whole = cut.groupBy("v").agg(*[F.sum(k).alias(k) for k in SUMS])
    out = cut.select("part", "v").join(whole, "v").groupBy("part").agg(F.collect_list(F.struct("v", *SUMS)).alias("cut"))
    out = write_table(out, "whole-contexts")
    drop_table(cut)
    return out


def _answers(uni: Unigrams, d: np.ndarray):
    """Model rows -> (block, part, value, code): log10 P of the bigrams that a block asked the part for."""
    def run(batches):
        for row in _each(batches):
            m = _Part(row, uni)
            for c in row["cut"] or ():
                j = np.searchsorted(m.v, c["v"])
                m.total[j], m.seen_p[j], m.by[j] = c["total"], c["p"], [c[k] for k in SUMS[2:]]
            lost = (m.by * (np.arange(1, DISCOUNT_TO + 1) * (1 - d[1:DISCOUNT_TO + 1]))).sum(axis=1)
            # a context without discounted bigrams sets one occurrence aside
            whole = np.maximum(np.where(lost > 0, m.total, m.total + 1), 1)
            alpha = np.where(m.total > 0, np.where(lost > 0, lost, 1.0) / whole / np.maximum(1 - m.seen_p, 1e-300), 1.0)
            seen = d[np.minimum(m.n, DISCOUNT_TO + 1)] * m.n / whole[m.vi]
            logp = np.log10(np.where(m.n > 0, seen, alpha[m.vi] * uni.p(m.w_count)))
            for block, places in _asked(row):
                value, code = np.unique(logp[places], return_inverse=True)
                yield _rows(block=pa.array([block]), part=pa.array([row["part"]], pa.int32()), value=pa.array([pack(value)], pa.binary()),
                            code=pa.array([pack(code.astype(np.uint32))], pa.binary()))
    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _block_scores(uni: Unigrams, parts: int):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        ids, ends = unpack(row["tokens"]).astype(np.int64), unpack(row["ends"])
        pairs, count = _Pairs(ids, ends, uni, parts), uni.count(ids)
        told = sorted(zip(*(answers.column(k).to_pylist() for k in ("part", "value", "code"))))
        logp = np.concatenate([unpack(value)[unpack(code)] for _, value, code in told])
        return pa.table({"doc_id": pa.array(row["doc_id"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
                         "n_tokens": ends - pairs.start, "n_known": np.add.reduceat((count > 0).astype(np.int64), pairs.start),
                         "base_score": np.add.reduceat(uni.base(count), pairs.start), "score": np.add.reduceat(logp[pairs.of], pairs.start)})
    return run


def score_documents(docs: DataFrame, held_out: Callable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows that ``held_out(id column)`` doesn't hold out, score all: ``doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    raw = write_table(src.mapInArrow(lean(_blocks), BLOCKS), "blocks")
    blocks, classes, starts = _numbered(raw)
    uni = Unigrams(classes, starts)
    drop_table(raw)
    release_shuffles(spark)
    parts = max(shuffle_partitions(spark), -(-uni.total // PART_TOKENS))
    model = blocks.mapInArrow(lean(_requests(parts, uni)), "part int, block long, v binary, w binary, n binary") \
        .groupBy("part").applyInArrow(_model_part, PART)
    model = write_table(model, "bigrams")
    release_shuffles(spark)
    told = model.select("n").mapInArrow(lean(_counts_of_counts), "r long, n long").groupBy("r").agg(F.sum("n").alias("n"))
    d = discounts({r.r: r.n for r in told.collect()})  # DISCOUNT_TO + 1 rows
    asked = model.join(_whole_contexts(model, uni, parts), "part", "left")
    answers = asked.mapInArrow(lean(_answers(uni, d)), "block long, part int, value binary, code binary")
    out = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_block_scores(uni, parts), SCORES)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(uni.total).cast("long").alias("train_tokens"), "base_score", "score")
