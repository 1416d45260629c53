"""URL rules by host-suffix and path-prefix expressions (DataFrame functions only).

A URL is expanded into ``host suffix + path prefix`` expressions. Only suffixes of as many
labels, and prefixes of as many characters, as some rule has are made, which loses no match.
Expressions meet the rules by an equi-join on the first 4 bytes of their SHA-256; then the
full digests are compared, and of the rules that fit the longest wins (by characters of host
and path, then of the host; of contradicting rules with equal host and path, block wins).

Defined results: a null URL or one without ``://`` has an empty host and path; an empty host
fits no rule; no fitting rule gives the ``default`` verdict and a null rule; rules with a
null host or path are no rules; repeated rows are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
PREFIX_HEX = 8
#: Rules (host, path and digest, about 200 bytes each) that may be broadcast.
BROADCAST_RULES = 200_000
_AZ = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url):
    """(host, path) columns of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    head = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return F.coalesce(F.translate(head, *_AZ), F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", keep: tuple[str, ...] = ("page_id",),
               default: str = "allow") -> DataFrame:
    """``keep`` columns of ``pages`` with ``host, path, rule, verdict``; ``rules(host, path, verdict)``."""
    rules = rules.where("host is not null and path is not null and verdict is not null") \
        .select(F.translate("host", *_AZ).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    shape = rules.agg(F.collect_set(F.size(F.split("r_host", r"\."))), F.collect_set(F.length("r_path")), F.count("*")).first()
    labels, lengths, n = sorted(shape[0]), sorted(shape[1]), shape[2]
    r = rules.withColumn("digest", F.sha2(F.concat("r_host", "r_path"), 256)) \
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    if n <= BROADCAST_RULES:
        r = F.broadcast(r)
    host, path = host_path(F.col(url_col))
    p = pages.select(*[F.col(c).alias(f"k_{c}") for c in keep], host.alias("host"), path.alias("path")) \
        .withColumn("row", F.monotonically_increasing_id())
    have = F.size(F.split("host", r"\."))
    made = [F.when((F.col("host") != "") & (have >= k) & (F.length("path") >= m),
                   F.concat(F.substring_index("host", ".", -k), F.substring(F.col("path"), F.lit(1), F.lit(m))))
            for k in labels for m in lengths]
    exprs = F.filter(F.array(*made), lambda x: x.isNotNull()) if made else F.array().cast("array<string>")
    one = p.select("row", *[f"k_{c}" for c in keep], "host", "path", F.posexplode_outer(exprs).alias("i", "expr"))
    # the URL's own columns travel with its first expression only
    first = F.coalesce("i", F.lit(0)) == 0
    one = one.select("row", *[F.when(first, F.col(c)).alias(c) for c in [f"k_{c}" for c in keep] + ["host", "path"]],
                     F.sha2("expr", 256).alias("d")).withColumn("p", F.substring("d", 1, PREFIX_HEX))
    hit = one.join(r, (F.col("p") == F.col("prefix")) & (F.col("d") == F.col("digest")), "left")
    best = F.max(F.when(F.col("r_host").isNotNull(), F.struct(
        (F.length("r_host") + F.length("r_path")).alias("long"), F.length("r_host").alias("host_long"),
        (F.col("r_verdict") == "block").alias("block"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))))
    out = hit.groupBy("row").agg(best.alias("best"), *[F.max(c).alias(c) for c in [f"k_{c}" for c in keep] + ["host", "path"]])
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep], "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
