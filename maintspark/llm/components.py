"""Connected components of a link table by alternating large and small stars.

Every half round is two joins on tables in the shared folder; nothing is collected. Minima
are aggregated before the shuffle, and the join back reads two plain tables, so adaptive
execution can split a node with very many links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop_table, write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = write_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    far = both.where("v > u") if large else both
    out = far.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.union(least.select("u", F.col("m").alias("v")))
    made = write_table(out.where("u <> v").distinct(), "star")
    drop_table(least)
    return made


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` -> ``(node, comp)``: the least node that each linked node reaches.

    Links of a node with itself are ignored; nodes without links don't occur. The columns
    may be of any ordered type; links with a null end are ignored."""
    edges = write_table(links.select("u", "v").where("u <> v").distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        large = _star(edges, True)
        small = _star(large, False)
        drop_table(edges)
        drop_table(large)
        edges, last = small, mark
        mark = _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")) \
        .union(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
