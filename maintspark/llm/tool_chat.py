"""Chat formatting with tool calls, in DataFrame functions only.

Calls and their results are joined on (conversation, identifier). Calls are put in an order
in which every call follows those it depends on: where all dependencies stand earlier in the
conversation that is the order of the turns; conversations with a dependency that stands
later are ordered level by level (all calls whose dependencies are placed come next), and
what is left over when no call is ready lies on or behind a cycle. Arguments are parsed into variants
and checked against the tool's schema; records are serialised as canonical JSON (sorted
keys, no spaces). A conversation is never gathered into one row: order numbers come from a
scan that is cut over all tasks.

Defined results: a call or result without conversation or identifier is linked with nothing
and its status is ``unidentified``; calls of one identifier are one call, the least by (turn,
name, arguments); of several results the least by (turn, content) is linked, and their
number is told; dependencies on unknown calls are kept in the record and hold nobody up;
arguments that are no JSON object, or null, are invalid; a tool without schema is invalid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import global_row_index
from .store import drop_table, write_table

#: Tools that may be broadcast with their fields.
BROADCAST_TOOLS = 50_000
KEY = ["conv_id", "call_id"]

SCHEMA_COLUMNS = "name string, field string, type string, required boolean, minimum double, maximum double, choices array<string>"


def canonical_json(json: Column) -> Column:
    """Canonical text of a JSON string: object keys sorted, no white space; null if it is none."""
    return F.to_json(F.try_parse_json(json))


def _kind(variant: Column) -> Column:
    of = F.schema_of_variant(variant)
    return F.when(of.isin("BIGINT"), "integer").when((of == "DOUBLE") | (of == "FLOAT") | of.startswith("DECIMAL"), "number") \
        .when(of == "STRING", "string").when(of == "BOOLEAN", "boolean").when(of == "VOID", "null") \
        .when(of.startswith("ARRAY"), "array").when(of.startswith("OBJECT"), "object").otherwise(of)


def argument_errors(arguments: Column, fields: Column) -> Column:
    """Sorted ``field:rule`` texts of what the arguments break; ``fields`` is the tool's array
    of schema rows, null for an unknown tool."""
    parsed = F.try_parse_json(arguments)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    given = F.when(is_object, F.try_variant_get(parsed, "$", "map<string,variant>"))

    def broken(f: Column) -> Column:
        value = F.element_at(given, f["field"])
        kind = _kind(value)
        number = F.when(kind.isin("integer", "number"), F.try_variant_get(value, "$", "double"))
        rule = F.when(~F.array_contains(F.map_keys(given), f["field"]), F.when(f["required"], "required")) \
            .when(~((kind == f["type"]) | ((f["type"] == "number") & (kind == "integer"))), "type") \
            .when(number < f["minimum"], "minimum").when(number > f["maximum"], "maximum") \
            .when(f["choices"].isNotNull() & ~F.array_contains(f["choices"], F.try_variant_get(value, "$", "string")), "choices")
        return F.when(rule.isNotNull(), F.concat(f["field"], F.lit(":"), rule))

    named = F.transform(fields, lambda f: f["field"])
    unknown = F.transform(F.array_except(F.map_keys(given), named), lambda k: F.concat(k, F.lit(":unknown")))
    errors = F.array_sort(F.array_union(F.filter(F.transform(fields, broken), lambda e: e.isNotNull()), unknown))
    return F.when(fields.isNull(), F.array(F.lit(":tool"))).when(given.isNull(), F.array(F.lit(":json"))).otherwise(errors)


def _levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) for the calls of conversations that aren't in turn order;
    level is null on and behind cycles. One round a level."""
    rest, edges, done, level = calls.select(*KEY), needs, None, 0
    while True:
        waiting = edges.select(*KEY).distinct()
        ready = write_table(rest.join(waiting, KEY, "left_anti").withColumn("level", F.lit(level)), "ready")
        if ready.isEmpty():
            break
        done = ready if done is None else done.unionByName(ready)
        rest = write_table(rest.join(waiting, KEY, "left_semi"), "waiting")
        placed = ready.select("conv_id", F.col("call_id").alias("dep_id"))
        edges = write_table(edges.join(placed, ["conv_id", "dep_id"], "left_anti"), "needs")
        level += 1
    rest = rest.withColumn("level", F.lit(None).cast("int"))
    return rest if done is None else done.unionByName(rest)


def topological_order(calls: DataFrame) -> DataFrame:
    """``calls(conv_id, call_id, turn, depends_on)``, one row an identifier -> with ``seq``
    (0, 1, ... within the conversation) and ``cyclic``."""
    calls = write_table(calls.select(*KEY, "turn", "depends_on"), "calls")
    known = calls.select("conv_id", F.col("call_id").alias("dep_id"), F.col("turn").alias("dep_turn"))
    needs = write_table(calls.select(*KEY, "turn", F.explode(F.array_distinct("depends_on")).alias("dep_id"))
                        .join(known, ["conv_id", "dep_id"]), "needs")
    # a dependency of the same or a later turn, or an unknown turn: not in turn order
    odd = needs.where(F.coalesce(F.col("dep_turn") >= F.col("turn"), F.lit(True))).select("conv_id").distinct()
    if odd.isEmpty():
        placed = calls.withColumn("level", F.lit(0)).withColumn("cyclic", F.lit(False))
    else:
        odd = write_table(odd, "odd")
        lv = _levels(calls.join(odd, "conv_id", "left_semi"), needs.join(odd, "conv_id", "left_semi").select(*KEY, "dep_id"))
        placed = calls.join(lv.withColumn("odd", F.lit(True)), KEY, "left") \
            .withColumn("cyclic", F.col("odd").isNotNull() & F.col("level").isNull()) \
            .withColumn("level", F.when(F.col("odd").isNull(), 0).otherwise(F.coalesce("level", F.lit(2**31 - 1)))).drop("odd")
    at = write_table(global_row_index(placed.select(*KEY, "turn", "level", "cyclic"), ["conv_id", "level", "turn", "call_id"]), "ordered")
    first = write_table(at.groupBy("conv_id").agg(F.min("row_index").alias("first")), "first")
    drop_table(needs)
    return at.join(first, "conv_id").select(*KEY, (F.col("row_index") - F.col("first")).alias("seq"), "cyclic")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row an identified call: ``conv_id, call_id, seq, status, n_results, errors`` and ``json``.

    ``calls(conv_id, call_id, turn, name, arguments, depends_on)``, ``results(conv_id,
    call_id, turn, content)``, ``schemas`` as :data:`SCHEMA_COLUMNS`. Status: ``cycle``,
    ``invalid``, ``unanswered`` or ``ok``, the first that holds."""
    some = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one = calls.where(some).groupBy(*KEY).agg(F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("c")).select(*KEY, "c.*")
    one = write_table(one, "one-call")
    answer = results.where(some).groupBy(*KEY).agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results")) \
        .select(*KEY, F.col("r.content").alias("result"), "n_results")
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("field", "type", "required", "minimum", "maximum", "choices"))).alias("fields"))
    if schemas.select("name").distinct().count() <= BROADCAST_TOOLS:
        tools = F.broadcast(tools)
    order = topological_order(one)
    x = one.join(order, KEY).join(answer, KEY, "left").join(tools, "name", "left")
    x = x.withColumn("errors", argument_errors(F.col("arguments"), F.col("fields"))).withColumn("n_results", F.coalesce("n_results", F.lit(0)))
    status = F.when(F.col("cyclic"), "cycle").when(F.size("errors") > 0, "invalid").when(F.col("n_results") == 0, "unanswered").otherwise("ok")
    x = x.withColumn("status", status)
    parsed = F.try_parse_json("arguments")
    record = F.struct(parsed.alias("arguments"), "call_id", F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"),
                      "errors", "name", "result", F.lit("call").alias("role"), "seq", "status")
    return x.select(*KEY, "seq", "status", "n_results", "errors", F.to_json(record, {"ignoreNullFields": "false"}).alias("json"), "arguments")


# --- calls and results of plain conversations ---------------------------------------------

#: The two tools that plain conversations are read as.
SCHEMAS = [("search", "limit", "integer", True, 1.0, 25.0, None), ("search", "query", "string", True, None, None, None),
           ("search", "lang", "string", False, None, None, ["de", "en", "es", "fr"]),
           ("summarise", "max_words", "integer", True, 1.0, 100.0, None), ("summarise", "text", "string", True, None, None, None)]
SEARCH_WORDS = 40


def call_id(conv: Column, turn: Column) -> Column:
    return F.concat(F.lit("c"), conv.cast("string"), F.lit("_"), turn.cast("string"))


def format_conversations(turns: DataFrame, schemas: DataFrame) -> DataFrame:
    """One formatted row a turn: ``conv_id, turn, role, call_id, seq, status, errors, json``.

    Each user turn is a call (``search`` up to 40 words, ``summarise`` beyond) that depends on
    the call two turns before, and on the first call of the conversation's turn 0 or 1 if its
    text has an even number of characters; the assistant turn after it is its result. Other
    turns are plain messages. Of user rows that repeat a turn with different texts the linked
    call is one; the others have status ``repeated`` and their own text as ``content``."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    n = F.size(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    short = n <= SEARCH_WORDS
    args = F.when(short, F.to_json(F.struct(F.col("text").alias("query"), n.alias("limit")))) \
        .otherwise(F.to_json(F.struct(F.col("text").alias("text"), n.alias("max_words"))))
    first = F.when(F.length("text") % 2 == 0, F.array(*[F.when(F.col("turn") > k, call_id(F.col("conv_id"), F.lit(k))) for k in (0, 1)]))
    before = F.when(F.col("turn") >= 2, F.array(call_id(F.col("conv_id"), F.col("turn") - 2)))
    none = F.array().cast("array<string>")
    depends = F.array_sort(F.array_compact(F.array_union(F.coalesce(before, none), F.coalesce(first, none))))
    user = t.where("role = 'user'").select("conv_id", call_id(F.col("conv_id"), F.col("turn")).alias("call_id"), "turn",
                                           F.when(short, "search").otherwise("summarise").alias("name"), args.alias("arguments"), depends.alias("depends_on"))
    answers = t.where("role = 'assistant'").select("conv_id", call_id(F.col("conv_id"), F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    linked = write_table(link_tool_calls(user, answers, schemas), "linked")
    x = t.withColumn("_own", args).withColumn("call_id", F.when(F.col("role") == "user", call_id(F.col("conv_id"), F.col("turn")))
                     .when(F.col("role") == "assistant", call_id(F.col("conv_id"), F.col("turn") - 1)))
    # turns without an identifier are dealt out by a key that no call has
    x = x.withColumn("_key", F.coalesce("call_id", F.concat(F.lit("~"), F.xxhash64("conv_id", "turn", "text").cast("string"))))
    x = x.join(linked.select(F.col("call_id").alias("_key"), "seq", F.col("status").alias("call_status"), "errors", F.col("json").alias("call_json"), F.col("arguments").alias("_linked")), "_key", "left")
    is_call, is_result = F.coalesce(F.col("role") == "user", F.lit(False)), F.coalesce(F.col("role") == "assistant", F.lit(False))
    linked_call = is_call & F.col("_own").eqNullSafe(F.col("_linked"))
    status = F.when((is_call | is_result) & F.col("call_id").isNull(), "unidentified").when(linked_call, F.col("call_status")).when(is_call, "repeated") \
        .when(is_result, F.when(F.col("seq").isNull(), "orphan").otherwise("result")).otherwise("message")
    x = x.withColumn("status", status)
    plain = F.to_json(F.struct("call_id", F.col("text").alias("content"), "role", "status"), {"ignoreNullFields": "false"})
    return x.select("conv_id", "turn", "role", "call_id", F.when(is_call, F.col("seq")).alias("seq"), "status",
                    F.when(is_call, F.array_join("errors", ",")).alias("errors"),
                    F.when(linked_call, F.coalesce("call_json", plain)).otherwise(plain).alias("json"))
