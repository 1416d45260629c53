"""Vector code compression: product-quantiser codes, nearest entries found by a GNAT.

Vectors become integers (``floor(scale * x)``) and are cut into equal consecutive parts; each
part position has a codebook of ``entries`` integer points, trained by rounds of exact
integer means. The nearest entry of every part is found by a geometric near-neighbour access
tree over the entries: a node's split points keep, for every other split point's subtree, the
least and the largest distance to its members, and a subtree goes when the query's distance
to a split point shows that all its members are strictly farther than the best so far.
Bounds are square roots rounded apart by more than their error, so rounding never removes a
subtree; the winner is told by (squared distance, index) in integers, so ties go to the
lower index.

Every pass reads the vectors where they lie; a task adds its parts up and hands on one row
an entry and component. The driver holds the codebooks alone (``parts * entries`` points).

Defined results: vectors that are null or hold null or non-finite components are left out;
an empty vector has only empty parts; of rows with equal ids every one counts, and the
seeds are the least by (id, vector, label), null ids last; fewer rows than entries make
smaller codebooks; an empty table has no codes. Vectors of unequal length, a length that the
parts don't divide, or components of 2**26 and more after scaling are errors that end the
job, as no exact code of them exists here. Extra columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import write_table
from .textbytes import lean

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Largest component after scaling: squared distances of parts of 512 components stay below 2**63.
LARGEST = 1 << 26
#: Vectors searched at a time.
BLOCK = 8192
#: Labels that are joined by broadcast; at most so many can hold 1/LABELS of the rows each.
LABELS = 100_000


# --- the tree ----------------------------------------------------------------------------

def _down(x: np.ndarray) -> np.ndarray:
    """Square root of integers, rounded down by more than all rounding errors of a comparison."""
    return np.sqrt(x.astype(np.float64)) * (1 - 2.0 ** -48)


def _up(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(np.float64)) * (1 + 2.0 ** -48)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


class Gnat:
    """Tree over integer ``points``; ``degree`` split points a node."""

    def __init__(self, points: np.ndarray, degree: int = 4, members: np.ndarray | None = None):
        self.points = points
        members = np.arange(len(points)) if members is None else members
        self.split = self._spread(members, degree)
        rest = np.setdiff1d(members, self.split)
        far = squared(points[rest][:, None], points[self.split][None]) if len(rest) else np.zeros((0, len(self.split)), np.int64)
        near = far.argmin(axis=1) if len(rest) else np.zeros(0, np.int64)
        k = len(self.split)
        self.low, self.high = np.zeros((k, k)), np.zeros((k, k))
        self.child: list[Gnat | None] = []
        for j in range(k):
            own = rest[near == j]
            d = squared(points[self.split][:, None], points[np.r_[self.split[j], own]][None])
            self.low[:, j], self.high[:, j] = _down(d.min(axis=1)), _up(d.max(axis=1))
            self.child.append(Gnat(points, degree, own) if len(own) else None)

    def _spread(self, members: np.ndarray, degree: int) -> np.ndarray:
        """Split points: the first member, then always the one farthest from those taken."""
        taken = [0]
        gap = squared(self.points[members], self.points[members[0]])
        while len(taken) < min(degree, len(members)):
            gap[taken] = -1
            taken.append(int(gap.argmax()))
            gap = np.minimum(gap, squared(self.points[members], self.points[members[taken[-1]]]))
        return np.sort(members[taken])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of every row's nearest point, and the distances computed."""
        index = np.full(len(x), len(self.points), np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max)
        return index, best, self._search(x, np.arange(len(x)), index, best)

    def _search(self, x, rows, index, best) -> int:
        live = np.ones((len(rows), len(self.split)), bool)
        work = 0
        for i, point in enumerate(self.split):
            at = np.flatnonzero(live[:, i])
            if not len(at):
                continue
            q = rows[at]
            d = squared(x[q], self.points[point])
            work += len(at)
            better = (d < best[q]) | ((d == best[q]) & (point < index[q]))
            index[q[better]], best[q[better]] = point, d[better]
            reach, down, up = _up(best[q])[:, None], _down(d)[:, None], _up(d)[:, None]
            live[at] &= ~((down > self.high[i] + reach) | (self.low[i] > up + reach))
        for j, child in enumerate(self.child):
            if child is not None and live[:, j].any():
                work += child._search(x, rows[live[:, j]], index, best)
        return work


# --- vectors of a batch ------------------------------------------------------------------

def _integers(column: pa.Array, scale: int, parts: int, length: int) -> np.ndarray:
    """(rows, parts, part length) integers of a list column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.asarray(column.value_lengths())
    if (sizes != length).any():
        raise ValueError(f"vectors must all have {length} components; found {sorted(set(sizes.tolist()) - {length})[:3]}")
    x = np.floor(flat * scale)
    if len(x) and np.abs(x).max() >= LARGEST:
        raise ValueError(f"components must stay below {LARGEST} after scaling")
    return x.astype(np.int64).reshape(len(column), parts, -1) if length else np.zeros((len(column), parts, 0), np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], column: int, scale: int, parts: int, length: int):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(at, BLOCK)
            yield rows, _integers(rows.column(column), scale, parts, length)


def assign(x: np.ndarray, trees: Sequence[Gnat]) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part: two (rows, parts) arrays."""
    found = [tree.nearest(np.ascontiguousarray(x[:, p])) for p, tree in enumerate(trees)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


# --- operators ---------------------------------------------------------------------------

def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, embedding, label) of the rows whose vector is whole and finite."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("embedding"), F.col(label_col).alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.where(F.col("embedding").isNotNull() & finite)


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks of ``usable`` rows, one (entries, part length) integer array a part; [] without rows."""
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding", "label").limit(entries).select("embedding").collect()
    if not seeds:
        return []
    length = len(seeds[0].embedding)
    if length % parts:
        raise ValueError(f"{parts} equal parts can't be cut from {length} components")
    start = _integers(pa.array([s.embedding for s in seeds], pa.list_(pa.float64())), scale, parts, length)
    books = [start[:, p] for p in range(parts)]
    spark = kept.sparkSession
    for _ in range(rounds):
        trees = spark.sparkContext.broadcast([Gnat(b) for b in books])

        def add_up(batches, trees=trees):
            total = np.zeros((parts, len(seeds), length // parts), np.int64)
            count = np.zeros((parts, len(seeds)), np.int64)
            for _, x in _blocks(batches, 0, scale, parts, length):
                code, _ = assign(x, trees.value)
                for p in range(parts):
                    np.add.at(total[p], code[:, p], x[:, p])
                    count[p] += np.bincount(code[:, p], minlength=len(seeds))
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(count[p, e]),
                                              pa.array(list(total[p, e]), pa.list_(pa.int64()))], names=["p", "e", "n", "s"])

        sums = kept.select("embedding").mapInArrow(lean(add_up), "p long, e long, n long, s array<long>")
        # one row an entry: its count, and its sums component by component
        told = sums.select("p", "e", F.posexplode_outer(F.concat(F.array("n"), "s")).alias("i", "v")) \
            .groupBy("p", "e", "i").agg(F.sum("v").alias("v")).collect()
        got = {(r.p, r.e, r.i): r.v for r in told}
        for p, e in {(p, e) for p, e, _ in got}:
            books[p][e] = [got[p, e, i] // got[p, e, 0] for i in range(1, length // parts + 1)]
        trees.unpersist()
    return books


def books_digest(books: Sequence[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(kept: DataFrame, books: Sequence[np.ndarray], scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error) of ``usable`` rows: two hex digits a part, summed squared distances."""
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, label {kept.schema['label'].dataType.simpleString()}, code string, error long"
    if not books:
        return kept.sparkSession.createDataFrame([], schema)
    parts, length = len(books), len(books) * books[0].shape[1]
    trees = kept.sparkSession.sparkContext.broadcast([Gnat(b) for b in books])

    def run(batches):
        for rows, x in _blocks(batches, 2, scale, parts, length):
            code, d = assign(x, trees.value)
            text = [c.tobytes().hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(text, pa.string()), pa.array(d.sum(axis=1))],
                                             names=["vec_id", "label", "code", "error"])

    return kept.select("vec_id", "label", "embedding").mapInArrow(lean(run), schema)


def decode(code: str, books: Sequence[np.ndarray]) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([b[i] for b, i in zip(books, bytes.fromhex(code))])


def add_label_error(codes: DataFrame, labels: int = LABELS) -> DataFrame:
    """``codes`` with ``label_error``, the error summed over equal labels (nulls are one label).

    Labels with more than 1/``labels`` of the rows, ``labels`` at most, are joined by
    broadcast, so none of them makes a large task; the others meet their rows in a shuffle."""
    sums = write_table(codes.groupBy(F.col("label").alias("_l")).agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")),
                       "label-errors")
    rows = sums.agg(F.sum("_n"), F.count("*")).first()
    same = F.col("label").eqNullSafe(F.col("_l"))
    if rows[1] <= labels:
        return codes.join(F.broadcast(sums.drop("_n")), same).drop("_l")
    hot = F.broadcast(sums.where(F.col("_n") * labels > rows[0]).drop("_n"))
    cold = sums.where(F.col("_n") * labels <= rows[0]).drop("_n")
    return codes.join(hot, same).drop("_l").unionByName(codes.join(hot, same, "left_anti").join(cold.hint("shuffle_hash"), same).drop("_l"))


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row a usable vector: ``vec_id, code, error, label_error, codebooks_sha256``."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part: 256 entries at most")
    kept = usable(vectors, id_col, vec_col, label_col)
    books = train(kept, parts, entries, rounds, scale)
    codes = write_table(encode(kept, books, scale), "codes")
    return add_label_error(codes).select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
