"""Merkle manifest of a dataset: trees of digests, stored in van Emde Boas layout.

Every row is a leaf; per group (source) the leaves, in order, hang in a tree in which every
``ARITY`` consecutive nodes have one parent, and the groups' roots hang in one more such tree.
A tree of any size is cut into aligned subtrees of ``ARITY ** height`` leaves. One row holds
such a block: its nodes lie in van Emde Boas order (a subtree is stored as its upper half, then
the lower halves one after another, each in the same way), so that construction and sibling
look-ups read nearby cells at every scale, without a chosen page size. Block roots are the
leaves of the next round, until a tree is one block; a round has ``ARITY ** height`` times
fewer rows. Way back: a block hands the siblings of its path down to the blocks below.

Leaves get their place by a sort over all tasks and per-task counts, so no group, however
large, is one task; a block is ``ARITY ** height`` leaves at most.

Defined results: null columns count as ``-`` in a leaf; a null or missing group is a group of
its own, the first; null ids come first in a group; rows with equal ids are ordered by their
leaf, and equal rows have leaves of their own; an empty text is ``0:``; an empty table has no
rows; extra columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import drop_table, write_table
from .textbytes import lean

ARITY = 3
#: Levels of a block below its root: 729 leaves, 1,093 nodes of 32 bytes.
DEFAULT_HEIGHT = 6
#: Leaves of a task of the ordering sort.
TASK_ROWS = 1_000_000
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- addresses ---------------------------------------------------------------------------

def nodes(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Cell of the ``index``-th node at ``depth`` (the root: 0) in the van Emde Boas order."""
    at = np.zeros(len(index), np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        span = ARITY ** (depth - upper)
        at += nodes(upper) + index // span * nodes(levels - upper)
        index, depth, levels = index % span, depth - upper, levels - upper
    return at


@lru_cache(maxsize=None)
def layout(levels: int) -> tuple[np.ndarray, ...]:
    """Per depth the cells of all its nodes."""
    return tuple(address(levels, d, np.arange(ARITY ** d)) for d in range(levels))


def h(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height_of(leaves: int) -> int:
    """Levels above ``leaves`` nodes until one is left."""
    up = 0
    while leaves > 1:
        leaves, up = -(-leaves // ARITY), up + 1
    return up


def build_block(leaves: Sequence[str], height: int) -> bytes:
    """Cells of one block: digests of its nodes, zeros where it has none."""
    cells = bytearray(nodes(height + 1) * DIGEST)
    level, at = list(leaves), layout(height + 1)
    for up in range(height + 1):
        for cell, digest in zip(at[height - up].tolist(), level):
            cells[cell * DIGEST:(cell + 1) * DIGEST] = bytes.fromhex(digest)
        if up < height:
            level = [h(*level[i:i + ARITY]) for i in range(0, len(level), ARITY)]
    return bytes(cells)


def read(cells: bytes, height: int, up: int, index: int) -> str:
    """Digest of the node ``up`` levels above the leaves."""
    at = int(layout(height + 1)[height - up][index]) * DIGEST
    return cells[at:at + DIGEST].hex()


def siblings(cells: bytes, leaves: int, height: int, index: int) -> tuple[list[str], list[str]]:
    """Per level from the leaf up: what stands left and right of its node in the node's run."""
    left, right, n = [], [], leaves
    for up in range(height):
        run = index // ARITY * ARITY
        left.append("".join(read(cells, height, up, i) for i in range(run, index)))
        right.append("".join(read(cells, height, up, i) for i in range(index + 1, min(run + ARITY, n))))
        index, n = index // ARITY, -(-n // ARITY)
    return left, right


def fold(leaf: str, left: Sequence[str], right: Sequence[str]) -> str:
    """The root that a leaf and its siblings make."""
    for a, b in zip(left, right):
        leaf = h(a, leaf, b)
    return leaf


# --- leaves ------------------------------------------------------------------------------

def leaf(fields: Sequence[Column]) -> Column:
    """Digest of some values: each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    told = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (c.cast("string") for c in fields)]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def ordered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows sorted over all tasks with ``_task`` and ``_i``, the place in the task's part of the
    group; per (group, ``_task``) the group's size ``n`` and the place ``_b`` of its first row).

    Rows that agree in everything are told apart by a row id that is written before the sort."""
    told = write_table(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-rows")
    tasks = max(1, -(-told.count() // TASK_ROWS))
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_row").asc()]
    cut = write_table(told.repartitionByRange(tasks, *keys).withColumn("_task", F.spark_partition_id()), "merkle-cut")
    drop_table(told)
    # windows over one row a task and group: the number of tasks at most
    over = Window.partitionBy(group)
    begin = cut.groupBy(group, "_task").agg(F.count("*").alias("_m")).select(
        group, "_task", F.sum("_m").over(over).alias("n"),
        (F.sum("_m").over(over.orderBy("_task").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_m")).alias("_b"))
    inside = cut.withColumn("_i", F.row_number().over(Window.partitionBy("_task", group).orderBy(*keys)) - 1).drop("_row")
    return inside, write_table(begin, "merkle-begin")


def placed(rows: DataFrame, begin: DataFrame, group: str) -> DataFrame:
    """The rows of :func:`ordered` with ``pos``, the place in the group, and the columns of ``begin``."""
    b = begin.withColumnRenamed(group, "_g").withColumnRenamed("_task", "_t")
    out = rows.join(b, (F.col("_task") == F.col("_t")) & F.col(group).eqNullSafe(F.col("_g")))
    return out.withColumn("pos", F.col("_b") + F.col("_i")).drop("_g", "_t", "_b", "_i", "_task")


# --- trees -------------------------------------------------------------------------------

def _construct(batches):
    """(tree, block, n, height, root, cells) from rows (tree, block, n, height, leaves); a tree's
    only block is as high as its leaves need."""
    for batch in batches:
        tree, block, n, high, leaves = (batch.column(i) for i in range(5))
        height = [height_of(k) if t is None else t for k, t in zip(n.to_pylist(), high.to_pylist())]
        cells = [build_block(x.as_py(), k) for x, k in zip(leaves, height)]
        yield pa.RecordBatch.from_arrays(
            [tree, block, n, pa.array(height, pa.int32()), pa.array([read(c, k, k, 0) for c, k in zip(cells, height)], pa.string()),
             pa.array(cells, pa.binary())], names=["tree", "block", "n", "height", "root", "cells"])


BLOCKS = "tree long, block long, n long, height int, root string, cells binary"


def build(leaves: DataFrame, height: int = DEFAULT_HEIGHT) -> list[DataFrame]:
    """Rounds of written blocks (``BLOCKS``) of the trees ``leaves`` (tree, pos, n, leaf; n: the
    tree's leaves). The first round holds the leaves; a tree's last block is in the round in
    which it is alone, and its root is the tree's."""
    rounds, size = [], ARITY ** height
    while True:
        grouped = leaves.groupBy("tree", F.floor(F.col("pos") / size).cast("long").alias("block")) \
            .agg(F.max("n").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "leaf"))).alias("x")) \
            .select("tree", "block", F.size("x").cast("long").alias("n"), F.when(F.col("total") > size, height).alias("height"),
                    F.col("x.leaf").alias("leaves"))
        made = write_table(grouped.mapInArrow(lean(_construct), BLOCKS), f"merkle-blocks-{len(rounds)}")
        rounds.append(made)
        more = made.where("block > 0").select("tree").distinct()  # trees of several blocks
        if more.isEmpty():
            return rounds
        last = made.join(more, "tree", "left_semi")
        sizes = last.groupBy("tree").agg(F.count("*").alias("n"))
        leaves = last.select("tree", F.col("block").alias("pos"), F.col("root").alias("leaf")).join(sizes, "tree")


def roots(rounds: Sequence[DataFrame]) -> DataFrame:
    """(tree, root): a tree's root is that of its block in the last round it is in."""
    told = None
    for i, made in enumerate(rounds):
        r = made.where("block = 0").select("tree", F.struct(F.lit(i).alias("i"), "root").alias("r"))
        told = r if told is None else told.unionByName(r)
    return told.groupBy("tree").agg(F.max("r").alias("r")).select("tree", F.col("r.root").alias("root"))


def _paths_below(batches):
    """(tree, pos, left, right) of every leaf of a block: its siblings in it, then those above."""
    for batch in batches:
        for r in batch.to_pylist():
            k = range(r["n"])
            first = r["block"] * ARITY ** r["height"]
            found = [siblings(r["cells"], r["n"], r["height"], i) for i in k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["tree"]] * r["n"], pa.int64()), pa.array([first + i for i in k], pa.int64()),
                 pa.array([a + (r["left"] or []) for a, _ in found], pa.list_(pa.string())),
                 pa.array([b + (r["right"] or []) for _, b in found], pa.list_(pa.string()))], names=["tree", "pos", "left", "right"])


PATHS = "tree long, pos long, left array<string>, right array<string>"


def block_paths(rounds: Sequence[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """(tree, block, left, right): siblings on the way from every block of the first round to
    its tree's root, and on through ``above`` (tree, left, right) where given."""
    path = None
    for i in range(len(rounds) - 1, 0, -1):
        blocks = rounds[i]
        if path is not None:
            blocks = blocks.join(path.withColumnRenamed("pos", "block"), ["tree", "block"], "left")
        else:
            blocks = blocks.withColumn("left", F.lit(None).cast("array<string>")).withColumn("right", F.lit(None).cast("array<string>"))
        path = write_table(blocks.mapInArrow(lean(_paths_below), PATHS), f"merkle-paths-{i}")
    first = rounds[0].select("tree", "block")
    none = F.array().cast("array<string>")
    if path is None:
        first = first.withColumn("left", none).withColumn("right", none)
    else:
        first = first.join(path.withColumnRenamed("pos", "block"), ["tree", "block"], "left") \
            .select("tree", "block", F.coalesce("left", none).alias("left"), F.coalesce("right", none).alias("right"))
    if above is None:
        return first
    up = above.select("tree", F.col("left").alias("_l"), F.col("right").alias("_r"))
    return first.join(up, "tree").select("tree", "block", F.concat("left", "_l").alias("left"), F.concat("right", "_r").alias("right"))


def leaf_paths(rounds: Sequence[DataFrame]) -> DataFrame:
    """(tree, pos, left, right) of every leaf, up to its tree's root."""
    whole = rounds[0].join(block_paths(rounds), ["tree", "block"])
    return whole.select("tree", "block", "n", "height", "cells", "left", "right").mapInArrow(lean(_paths_below), PATHS)


class Manifest:
    """Written tables of a dataset's trees: ``leaves`` (tree, pos, n and the leaves' columns),
    ``groups`` (tree, group, subroot), the groups' ``rounds`` and those of the tree of
    subroots (``top``), and ``root``."""

    def __init__(self, leaves: DataFrame, group: str, order: Sequence[str], height: int = DEFAULT_HEIGHT):
        self.height = height
        rows, begin = ordered(leaves, group, order)
        of_group, of_all = ordered(begin.select(F.col(group).alias("group")).distinct().withColumn("_all", F.lit(0)), "_all", ["group"])
        groups = write_table(placed(of_group, of_all, "_all").select("group", F.col("pos").alias("tree"), F.col("n").alias("of")),
                             "merkle-groups")
        # the tree's number joins the few rows of a group in `begin`, and with them the leaves
        begin = begin.join(groups.drop("of"), F.col(group).eqNullSafe(F.col("group"))).drop("group")
        self.leaves = write_table(placed(rows, begin, group), "merkle-leaves")
        self.rounds = build(self.leaves.select("tree", "pos", "n", "leaf"), height)
        self.groups = write_table(groups.join(roots(self.rounds), "tree").withColumnRenamed("root", "subroot"), "merkle-subroots")
        self.top = build(self.groups.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("of").alias("n"),
                                            F.col("subroot").alias("leaf")), height)
        last = roots(self.top).first()
        self.root = last.root if last else None

    def above(self) -> DataFrame:
        """(tree, left, right): a group's siblings on the way from its subroot to the root."""
        return leaf_paths(self.top).select(F.col("pos").alias("tree"), "left", "right")


def verify(manifest: Manifest, claimed: str, keep: Sequence[str]) -> DataFrame:
    """One row a leaf: ``keep``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (digest of its
    siblings up to the root), ``folded_root`` (from the column ``claimed`` and the siblings) and
    ``verified``. The leaves of a block travel as one row; a path above the block is sent once."""
    size = ARITY ** manifest.height
    rows = manifest.leaves.groupBy("tree", F.floor(F.col("pos") / size).cast("long").alias("block")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", *[F.col(c) for c in keep], "leaf", claimed))).alias("x"))
    blocks = manifest.rounds[0].join(block_paths(manifest.rounds, manifest.above()), ["tree", "block"]) \
        .join(rows, ["tree", "block"]).join(manifest.groups.select("tree", "subroot"), "tree")
    root = manifest.root
    fields = rows.schema["x"].dataType.elementType
    kept = [f"{c} {fields[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kept, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                cells, n, height = (one.column(j)[0].as_py() for j in range(3))
                left, right, subroot = (one.column(j)[0].as_py() for j in range(3, 6))
                x = one.column(6).flatten()
                # the leaves of a run have the rest of the path in common
                proof, folded = [], []
                for k, told in enumerate(x.field(claimed).to_pylist()):
                    a, b = siblings(cells, n, height, k)
                    a, b = a + left, b + right
                    proof.append(h(*[s for pair in zip(a, b) for s in pair]))
                    folded.append(fold(told, a, b))
                yield pa.RecordBatch.from_arrays(
                    [*[x.field(c) for c in keep], x.field("leaf"), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()),
                     pa.array(proof, pa.string()), pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_())],
                    names=[*keep, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return blocks.select("cells", "n", "height", "left", "right", "subroot", "x").mapInArrow(lean(run), schema)


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(source, doc_id, leaf, claimed): ``claimed`` is the leaf of the row with its line feeds
    deleted where ``tampered`` is true, else the leaf itself."""
    d = docs.select(*[F.col(c) for c in FIELDS])
    cut = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text")) if tampered is not None else F.col("text")
    return d.select("source", "doc_id", leaf([F.col(c) for c in FIELDS]).alias("leaf"),
                    leaf([*[F.col(c) for c in FIELDS[:-1]], cut]).alias("claimed"))


def tampering_report(docs: DataFrame, height: int = DEFAULT_HEIGHT) -> DataFrame:
    """Every document's leaf, proof and check after line feeds were deleted from the texts of
    documents whose decimal id has an even crc32 (a null id isn't tampered with)."""
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    manifest = Manifest(document_leaves(docs, even), "source", ["doc_id", "leaf"], height)
    return verify(manifest, "claimed", ["doc_id"])
