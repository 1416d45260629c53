"""The queries of this subpackage, ``opN_<name>``, and DuckDB SQL where SQL can tell their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, html_paths, katz, license_scan, line_dedup, merkle, near_dup, pareto_mix, prefix_hash, tool_chat,
               toxic_grammar, url_rules, vector_codes)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return put


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, s)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query(OP1_SQL)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix-array contamination report of every document against the whole benchmark."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 75 * (a.n + b.n - k)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.d WHERE r.c < e.v),
c AS (SELECT d AS doc_id, min(c) AS component_id FROM r GROUP BY d)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""


@query(OP5_SQL)
def op5_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document (5-word shingles, similarity 0.75)."""
    told = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return told.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query()
def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document (weights 3, 1, 2; 150 % of all words; cap 2)."""
    return pareto_mix.mix_report(table(spark, sf_dir, "documents"))


OP7_SQL = rf"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
u AS (SELECT row_number() OVER () AS k, page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), {_AZ}) AS host,
             regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                     ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT k, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
      FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m USING (k)
"""


@query(OP7_SQL)
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL under the five rules."""
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


@query()
def op10_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = F.coalesce(toxic_grammar.held_out(F.col("doc_id")), F.lit(False))
    model = toxic_grammar.learn(docs.where(~out), table(spark, sf_dir, "labels"))
    told = toxic_grammar.score(docs, model, keep=("doc_id",))
    return told.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


OP3_SQL = rf"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
o AS (SELECT doc_id, i - 1 AS line, regexp_extract_all(translate(ls[i], {_AZ}), '[^\x20\x09-\x0D]+') AS w
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
e AS (SELECT doc_id, line, w, array_to_string(w, ' ') AS s FROM o WHERE len(w) >= 5),
f AS (SELECT s, any_value(w) AS w, min(struct_pack(d := doc_id, l := line)) AS o FROM e GROUP BY s),
v AS (SELECT s, o, i, array_to_string(w[1:i - 1] || w[i + 1:], ' ') AS v
      FROM (SELECT s, o, w, unnest(range(1, len(w) + 1)) AS i FROM f WHERE len(w) >= 10)),
late AS (SELECT s FROM (SELECT s, o, min(o) OVER (PARTITION BY v, i) AS m FROM v) WHERE m < o
         UNION SELECT v.s FROM v JOIN f ON f.s = v.v WHERE len(f.w) >= 10 AND f.o < v.o
         UNION SELECT f.s FROM v JOIN f ON f.s = v.v WHERE len(f.w) >= 10 AND v.o < f.o),
x AS (SELECT e.doc_id, e.line FROM e JOIN f USING (s) WHERE f.o <> struct_pack(d := e.doc_id, l := e.line) OR s IN (SELECT s FROM late)),
k AS (SELECT o.doc_id, count(x.line) AS n_dropped FROM o LEFT JOIN x USING (doc_id, line) GROUP BY o.doc_id),
t AS (SELECT doc_id, string_agg(ls[line + 1], chr(10) ORDER BY line) AS t FROM o JOIN l USING (doc_id)
      WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.doc_id = o.doc_id AND x.line = o.line) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query(OP3_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat an earlier line, or are one word edit from one."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query()
def op2_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    told = html_paths.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return told.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op6_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return prefix_hash.edited_neighbours(table(spark, sf_dir, "documents"))


@query()
def op8_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz bigram score of every document; trained on those that are not held out."""
    def out(doc_id):
        return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) == 0
    return katz.score_documents(table(spark, sf_dir, "documents"), out)


OP9_SQL = r"""
WITH t AS (SELECT conv_id, turn, role, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM conversations),
c AS (SELECT *, 'c' || conv_id || '_' || turn AS call_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS seq,
             list_sort(list_distinct(list_filter([CASE WHEN turn >= 2 THEN 'c' || conv_id || '_' || (turn - 2) END,
                 CASE WHEN length(text) % 2 = 0 AND turn > 0 THEN 'c' || conv_id || '_0' END,
                 CASE WHEN length(text) % 2 = 0 AND turn > 1 THEN 'c' || conv_id || '_1' END], lambda x: x IS NOT NULL))) AS deps,
             CASE WHEN n <= 40 AND n < 1 THEN 'limit:minimum' WHEN n <= 40 AND n > 25 THEN 'limit:maximum'
                  WHEN n > 100 THEN 'max_words:maximum' ELSE '' END AS errors
      FROM t WHERE role = 'user'),
a AS (SELECT 'c' || conv_id || '_' || (turn - 1) AS call_id, text AS result FROM t WHERE role = 'assistant'),
l AS (SELECT c.*, a.result, a.call_id IS NOT NULL AS answered,
             CASE WHEN errors <> '' THEN 'invalid' WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'ok' END AS status
      FROM c LEFT JOIN a USING (call_id))
SELECT conv_id, turn, role, call_id, seq, status, errors,
       CAST(json_object('arguments', CASE WHEN n <= 40 THEN json_object('limit', n, 'query', text) ELSE json_object('max_words', n, 'text', text) END,
            'call_id', call_id, 'depends_on', to_json(deps), 'errors', CASE WHEN errors = '' THEN to_json(CAST([] AS VARCHAR[])) ELSE to_json([errors]) END,
            'name', CASE WHEN n <= 40 THEN 'search' ELSE 'summarise' END, 'result', result, 'role', 'call', 'seq', seq, 'status', status) AS VARCHAR) AS json
FROM l
UNION ALL
SELECT t.conv_id, t.turn, t.role, x.call_id, NULL, x.status, NULL,
       CAST(json_object('call_id', x.call_id, 'content', t.text, 'role', t.role, 'status', x.status) AS VARCHAR)
FROM t LEFT JOIN c ON c.conv_id = t.conv_id AND c.turn = t.turn - 1,
LATERAL (SELECT CASE WHEN t.role = 'assistant' THEN 'c' || t.conv_id || '_' || (t.turn - 1) END AS call_id,
                CASE WHEN t.role <> 'assistant' THEN 'message' WHEN c.call_id IS NULL THEN 'orphan' ELSE 'result' END AS status) x
WHERE t.role <> 'user'
"""


@query(OP9_SQL)
def op9_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations formatted: calls linked, ordered, validated, in canonical JSON."""
    schemas = spark.createDataFrame(tool_chat.SCHEMAS, tool_chat.SCHEMA_COLUMNS)
    return tool_chat.format_conversations(table(spark, sf_dir, "conversations"), schemas)


def _crc32(text: str) -> str:
    """SQL: unsigned crc32 of an ASCII text, bit by bit."""
    shift = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    return (f"xor(list_reduce([4294967295] || list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(({text})[i]) AS BIGINT)), "
            f"lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, k: {shift})), 4294967295)")


def _field(v: str) -> str:
    return f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR) END"


_LEAF = " || ".join(_field(v) for v in merkle.FIELDS[:-1])
OP11_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, sha256({_LEAF} || {_field('text')}) AS leaf,
    CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN sha256({_LEAF} || {_field("replace(text, chr(10), '')")})
         ELSE sha256({_LEAF} || {_field('text')}) END AS claimed FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS cnt FROM d),
n AS (SELECT source, 0 AS lvl, pos, leaf AS h, cnt FROM l
      UNION ALL
      SELECT source, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (cnt + 2) // 3 FROM n WHERE cnt > 1
      GROUP BY source, lvl, pos // 3, cnt),
s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS cnt FROM n WHERE cnt = 1),
t AS (SELECT 0 AS lvl, pos, subroot AS h, cnt FROM s
      UNION ALL
      SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (cnt + 2) // 3 FROM t WHERE cnt > 1 GROUP BY lvl, pos // 3, cnt),
runs AS (SELECT l.doc_id, n.lvl, n.pos, n.h, CAST(floor(l.pos / power(3, n.lvl)) AS BIGINT) AS own
         FROM l JOIN n ON n.source IS NOT DISTINCT FROM l.source AND n.cnt > 1 AND n.pos // 3 = CAST(floor(l.pos / power(3, n.lvl + 1)) AS BIGINT)
         UNION ALL
         SELECT l.doc_id, 1000 + t.lvl, t.pos, t.h, CAST(floor(s.pos / power(3, t.lvl)) AS BIGINT) FROM l JOIN s ON s.source IS NOT DISTINCT FROM l.source
         JOIN t ON t.cnt > 1 AND t.pos // 3 = CAST(floor(s.pos / power(3, t.lvl + 1)) AS BIGINT)),
steps AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY lvl) AS k,
                 coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < own), '') AS a, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > own), '') AS b
          FROM runs GROUP BY doc_id, lvl),
f AS (SELECT doc_id, 0 AS k, claimed AS h FROM d
      UNION ALL SELECT f.doc_id, f.k + 1, sha256(a || f.h || b) FROM f JOIN steps ON steps.doc_id = f.doc_id AND steps.k = f.k + 1),
folded AS (SELECT doc_id, arg_max(h, k) AS folded_root FROM f GROUP BY doc_id),
p AS (SELECT d.doc_id, sha256(coalesce(string_agg(a || b, '' ORDER BY k), '')) AS proof_sha256 FROM d LEFT JOIN steps USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM d JOIN s ON s.source IS NOT DISTINCT FROM d.source JOIN p USING (doc_id) JOIN folded USING (doc_id), (SELECT h AS root FROM t WHERE cnt = 1)
"""


@query(OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document after the tampering."""
    return merkle.tampering_report(table(spark, sf_dir, "documents"))


def _op12_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    ctes = [f"""v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding, label) AS rn, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""x AS MATERIALIZED (SELECT rn, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x
        FROM v, (SELECT unnest(range({parts})) AS p))""",
            f"b0 AS MATERIALIZED (SELECT p, rn - 1 AS e, x AS c FROM x WHERE rn <= {entries})"]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT rn, p, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS m FROM (SELECT rn, x.p, x, e,
            coalesce(CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT), 0) AS d
            FROM x JOIN b{i} ON b{i}.p = x.p) GROUP BY rn, p)""")
        if i < rounds:
            ctes.append(f"""b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(s.c, b.c) AS c FROM b{i} b LEFT JOIN
            (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM
             (SELECT p, e, i, sum(y) AS s, count(*) AS n FROM (SELECT p, m.e AS e, unnest(x) AS y, unnest(range(len(x))) AS i FROM a{i}) GROUP BY p, e, i)
             GROUP BY p, e) s USING (p, e))""")
    return "WITH " + ",\n".join(ctes) + f""",
c AS (SELECT rn, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rn)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN c USING (rn)
"""


@query(_op12_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every whole vector under codebooks trained on all of them."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


_TEMPLATES = ", ".join(f"({k}, '{label}', {base}, '{text}')" for k, (label, text, base) in enumerate(
    [(*t, True) for t in license_scan.PHRASES] + [(*t, False) for t in license_scan.TEMPLATES]))
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP13_SQL = f"""
WITH raw(k, label, base, s) AS (VALUES {_TEMPLATES}),
t AS (SELECT k, label, base, w, len(list_distinct(w)) AS size, CAST(greatest({license_scan.CLASS}, power(2, ceil(log2(len(w))))) AS BIGINT) AS width
      FROM (SELECT *, regexp_extract_all(translate(s, {_AZ}), {_WORDS}) AS w FROM raw)),
tw AS (SELECT DISTINCT k, width, unnest(w) AS word FROM t),
sub AS (SELECT a.k, b.k AS j FROM t a JOIN t b ON a.width = b.width AND NOT a.base AND NOT b.base AND a.size < b.size AND list_has_all(b.w, a.w)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_WORDS}) AS w FROM documents),
dw AS (SELECT r, i, word FROM (SELECT r, unnest(range(len(w))) AS i, unnest(w) AS word FROM d) WHERE word IN (SELECT word FROM tw)),
cell AS (SELECT DISTINCT r, k, (i // width) - o AS block, word FROM dw JOIN tw USING (word), (VALUES (0), (1)) AS h(o) WHERE i // width >= o),
m AS (SELECT r, k, block, count(*) AS common FROM cell GROUP BY r, k, block),
hit AS (SELECT r, k, block, label, common / size AS share FROM m JOIN t USING (k)
        WHERE NOT base AND common >= greatest(1, (size * {license_scan.PERCENT} + 99) // 100)),
blocks AS (SELECT r, label, share FROM hit WHERE NOT EXISTS (SELECT 1 FROM sub JOIN hit o ON o.k = sub.j
           WHERE sub.k = hit.k AND o.r = hit.r AND o.block = hit.block)),
place AS (SELECT dw.r, label, i FROM dw JOIN t ON base AND dw.word = t.w[1] JOIN d USING (r) WHERE d.w[i + 1:i + len(t.w)] = t.w),
p AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM place GROUP BY r),
e AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
      FROM (SELECT r, label, share FROM blocks UNION ALL SELECT r, label, 1.0 FROM place) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
       coalesce(p.labels, '') AS base_labels, coalesce(e.labels, '') AS labels, coalesce(CAST(score AS DOUBLE), 0.0) AS score
FROM d LEFT JOIN p USING (r) LEFT JOIN e USING (r)
"""


@query(OP13_SQL)
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and license sentences in every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.template_table(spark))
