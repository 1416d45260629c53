"""MinHash near-duplicates: one-permutation hashing with optimal densification.

1. Every document becomes the set of its word shingles; equal sets are one node.
2. The node's densified signature is cut into bands; nodes with an equal band share a bucket.
3. Within a bucket the edges form a star: each member is held against the bucket's hub only,
   so a bucket of m members gives m-1 candidates. They are confirmed on full sets. The hub is
   the member that meets most others over all its buckets: of a text and its edited copies
   the text itself, to which nearly all that link with any copy link themselves.
4. A star can miss a link between two members that both fail against its centre. Members of
   buckets that still hold more than one component are therefore joined exactly: two sets
   that reach the similarity share a shingle among the first few of each in one common order
   (rarest first), at places that leave enough shingles behind (prefix and position filter).
   This join covers whole buckets of any size; nothing is capped.
5. Confirmed links are closed into components.

With 48 bands of 5 bins, two sets of similarity 0.75 miss each other in every band with
probability 2e-6, and more alike sets far more rarely.

Defined results: a null or wordless text has no shingles, is linked with nothing and is its
own component; equal rows have the same component; a null id never names a component unless
all ids in it are null; extra columns of ``docs`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shingles import SHINGLE, band_keys, set_digest, shingle_sets, signatures
from .store import drop_table, release_shuffles, write_table
from .textbytes import chunks, lean

BANDS, ROWS = 48, 5
PERCENT = 75
#: Rows of (node, id, hash) that may be broadcast (about 48 bytes each).
BROADCAST_ROWS = 400_000


def _nodes(s, off):
    return [x.tobytes() for x in set_digest(s, off).astype(">u8")]


def sketch(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, h, n, node, bands) of every document; node is null without shingles."""
    def run(batches):
        for batch in batches:
            for c in chunks(batch, "text"):
                s, off = shingle_sets(c.column(2), shingle)
                n = np.diff(off)
                keys = band_keys(signatures(s, off, bands * rows), rows).astype(np.int64)
                some = n > 0
                flat = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(some * keys.shape[1])], pa.int32()),
                                                pa.array(keys[some].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [c.column(0), c.column(1), pa.array(n),
                     pa.array([x if k else None for x, k in zip(_nodes(s, off), n)], pa.binary()), flat],
                    names=["doc_id", "h", "n", "node", "bands"])

    return docs.mapInArrow(lean(run), "doc_id long, h long, n long, node binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, n, set) of the wanted (node, doc_id, h) rows, from their whole texts."""
    rows = wanted.count()
    side = F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted
    w = side.select("node", F.col("doc_id").alias("w_id"), F.col("h").alias("w_h"))
    picked = docs.join(w, (F.col("h") == F.col("w_h")) & F.col("doc_id").eqNullSafe(F.col("w_id"))) \
        .select("node", "text")

    def run(batches):
        for batch in batches:
            for c in chunks(batch, "text"):
                s, off = shingle_sets(c.column(1), shingle)
                yield pa.RecordBatch.from_arrays(
                    [c.column(0), pa.array(np.diff(off)),
                     pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(s.astype(np.int64)))],
                    names=["node", "n", "set"])

    # a node's row may occur several times as equal rows: keep one
    return picked.mapInArrow(lean(run), "node binary, n long, set array<long>").dropDuplicates(["node"])


def _hubs(shared: DataFrame) -> DataFrame:
    """(key, hub) of the buckets in ``shared`` (key, node, m): the member whose buckets have the
    most members in all, of several the least. One order holds in all buckets, so that two
    nodes are never each other's hub."""
    met = shared.groupBy("node").agg(F.sum("m").alias("met"))
    first = F.min(F.struct((-F.col("met")).alias("met"), "node"))
    return shared.join(met, "node").groupBy("key").agg(first.alias("r")).select("key", F.col("r.node").alias("hub"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (u, v) of ``pairs`` whose full sets reach the similarity."""
    a = sets.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("set").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("set").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    return pairs.join(a, "u").join(b, "v") \
        .where(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent) \
        .where(both * 100 >= (F.col("nu") + F.col("nv") - both) * percent).select("u", "v")


def _exact_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All pairs of ``sets`` in different components that can reach the similarity, by prefix
    and position filter over shingles ordered by (documents that have it, hash)."""
    t = sets.select("node", "n", F.explode("set").alias("token"))
    often = write_table(t.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "often")
    # shingles of one node only come first; their number is all that matters about them
    shared = t.join(often, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ts"))
    shared = shared.select("node", "n", "ts", (F.col("n") - F.size("ts")).alias("alone"))
    p = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    pre = shared.select("node", "n", F.posexplode("ts").alias("i", "t"), "alone", p.alias("p")) \
        .select("node", "n", (F.col("alone") + F.col("i")).alias("at"), F.col("t.token").alias("token"), "p") \
        .where("at < p").drop("p")
    pre = write_table(pre.join(labels.withColumnRenamed("comp", "c0"), "node", "left")
                      .withColumn("c", F.coalesce("c0", "node")).drop("c0"), "prefix")
    drop_table(often)
    x = pre.select("token", *[F.col(k).alias(f"{k}_x") for k in ("node", "n", "at", "c")])
    y = pre.select("token", *[F.col(k).alias(f"{k}_y") for k in ("node", "n", "at", "c")])
    need = F.ceil((F.col("n_x") + F.col("n_y")) * percent / (100 + percent))
    return x.join(y, (x.token == y.token) & (F.col("c_x") != F.col("c_y"))
                  & ((F.col("n_x") > F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("node_x") > F.col("node_y"))))
                  & (F.col("n_x") * percent <= F.col("n_y") * 100)
                  & (F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y")) >= need)) \
        .select(F.col("node_x").alias("u"), F.col("node_y").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row a document: ``doc_id, h`` (text hash), ``n_shingles, component_id`` (least id
    of its component), ``node`` (digest of its shingle set) and ``comp`` (least node of its component)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                      F.col(text_col).alias("text"))
    told = write_table(sketch(src, shingle, bands, rows), "sketch")
    members = told.where("node is not null").select("node", F.explode("bands").alias("key")).distinct()
    buckets = write_table(members.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "buckets")
    shared = write_table(members.join(buckets, "key"), "shared")
    drop_table(buckets)
    hubs = write_table(_hubs(shared), "hubs")
    release_shuffles(spark)
    wanted = told.join(shared.select("node").distinct(), "node") \
        .groupBy("node").agg(F.min(F.struct("doc_id", "h")).alias("r")).select("node", "r.*")
    sets = write_table(_sets(src, write_table(wanted, "wanted"), shingle), "sets")
    release_shuffles(spark)

    star = shared.join(hubs, "key").where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    links = write_table(_confirm(star, sets, percent), "confirmed")
    labels = write_table(components(links), "labels")
    open_ = shared.join(labels, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("c"))
    undecided = open_.groupBy("key").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a <> b").select("key")
    rest = write_table(sets.join(shared.join(undecided, "key", "left_semi").select("node").distinct(), "node", "left_semi"),
                       "undecided")
    more = write_table(_confirm(_exact_pairs(rest, labels, percent), rest, percent), "confirmed")
    if not more.isEmpty():
        labels = write_table(components(labels.select(F.col("node").alias("u"), F.col("comp").alias("v")).unionByName(more)),
                             "labels")
    for t in (hubs, shared, sets, rest):
        drop_table(t)
    release_shuffles(spark)
    # the least document id of each component, over all its nodes and their copies
    least = told.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    ids = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    # single sets are most of the nodes: only nodes with copies or links are looked up
    lookup = write_table(named.join(ids, "comp").select("node", "component_id", "comp"), "named")
    return told.join(lookup, "node", "left").select(
        "doc_id", "h", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "node", "comp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, all columns as they were: the
    row with the group's least id (null last), of several texts with that id the one of least
    hash, and of rows that agree in both the least in all columns that can be ordered. Rows
    without shingles all stay."""
    told = write_table(near_duplicates(docs, id_col, text_col, **options).where("n_shingles > 0")
                       .groupBy("comp", "doc_id", "h").agg(F.count("*").alias("m")), "members")
    order = F.struct(F.isnull("doc_id").alias("z"), "doc_id", "h")
    first = told.groupBy("comp").agg(F.min(order).alias("first"))
    ranked = told.join(first, "comp").select("doc_id", "h", "m", (order == F.col("first")).alias("stays"))
    # (id, hash) in the documents' rows: those that go, and those that stay once of several rows
    marked = write_table(ranked.where("not stays or m > 1").select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "stays"), "gone")
    drop_table(told)
    gone, twins = marked.where("not stays"), marked.where("stays")
    if marked.count() <= BROADCAST_ROWS:
        gone, twins = F.broadcast(gone), F.broadcast(twins)
    key = docs[id_col].cast("long"), F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    same = key[0].eqNullSafe(F.col("_id")) & (key[1] == F.col("_h"))
    rest = docs.join(gone, same, "left_anti")
    if marked.where("stays").isEmpty():
        return rest
    sortable = [c for c in docs.columns if "map<" not in (kind := docs.schema[c].dataType.simpleString()) and kind != "variant"]
    by = F.struct(*[F.col(f"`{c}`") for c in sortable])
    # one row of each (id, hash): the rows of a group meet in the map-side aggregate first
    one = docs.join(twins, same, "left_semi").groupBy(key[0].alias("_id"), key[1].alias("_h")) \
        .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), by).alias("_row"))
    return rest.join(twins, same, "left_anti").unionByName(one.select("_row.*"))
