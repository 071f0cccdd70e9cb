"""Chat formatting: tool-call linking, in DataFrame operations only.

A turn whose text is a JSON object with an array ``tool_calls`` makes calls: objects with ``id``, ``name``,
``arguments`` (an object) and optionally ``depends_on`` (ids of other calls). A turn whose text is a JSON
object with ``tool_call_id`` is a result, and makes its calls too if it has any. Every other turn is a message, with
empty ``tool_calls`` as well; a turn with calls, no result and other fields (text beside the calls) is a message besides,
with its whole text.

Results are hash-joined to calls by conversation and identifier. An identifier is used by the first call of a
conversation that bears it; later calls with it are ``duplicate_id``. A result answers its call from a later turn; one
that does not come after its call is ``early`` and answers nothing.

Calls are put in topological order: a call's level is 0 without dependencies, else one more than the highest level
among them, and its ``order_turn`` is the latest of its own turn and its dependencies' order_turns. A call that waits
for a cycle has level -1 and its own turn; a dependency that no call bears counts for nothing. A result stands right
after its call: it has its call's order_turn, and its level is one more (levels of calls are even). So sorting by
(conv_id, order_turn, level, turn) replays a conversation with every call after those it depends on and their results.

Levels come by rake and compress: each round folds settled dependencies into the calls that wait for them, and lets a
call that waits for one with a single open dependency wait for that one instead. A chain of n calls takes about
log2(n) rounds.

Arguments are validated against the tools' schemas (name, param, type, required). Types: string, integer,
number, boolean, object, array. Status of a call, the first that holds: duplicate_id, what is wrong with its arguments
(unknown_tool, not_an_object, missing_argument, unknown_argument, wrong_type), cyclic, unknown_dependency, unanswered, ok.
Absent or null arguments are an empty object. Of a result: linked, early or orphan. Of a message: message.

``message_json`` is canonical: keys sorted at every level, no white space, numbers in one form.

Output is one row per message, result and call, never a conversation gathered into one row, so a very long
conversation spreads over tasks. Null texts and roles count as empty strings; null ids never link. Repeated
turns give repeated rows. Empty tables are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import cut

#: Types that the schemas may name, with the variant types that satisfy them.
TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT", "INT", "SMALLINT", "TINYINT"],
    "number": ["BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL"],
    "boolean": ["BOOLEAN"],
    "object": ["OBJECT"],
    "array": ["ARRAY"],
}
SCHEMA_DDL = "name string, param string, type string, required boolean"


def _message(**fields: Column) -> Column:
    """Canonical JSON of an object of strings; the keys come sorted."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def _quoted(text: Column) -> Column:
    """A string as a JSON string."""
    boxed = F.to_json(F.array(text))
    return F.substr(boxed, F.lit(2), F.length(boxed) - 2)


def _type_of(value: Column) -> Column:
    """Variant type name without its details: ``DECIMAL(3,1)`` gives DECIMAL."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)


def parse_turns(turns: DataFrame) -> DataFrame:
    """The turns with ``body``: the text as a variant if it is a JSON object, else null."""
    base = turns.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    body = F.when(F.ltrim("text").startswith("{"), F.try_parse_json("text"))
    return base.withColumn("body", F.when(F.schema_of_variant(body).startswith("OBJECT"), body))


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, id, level, top) of (conv_id, id, turn, depends_on): level null where a cycle never settles; top: the latest turn."""
    key = ["conv_id", "id"]
    nodes = calls.select(*key, F.lit(0).cast("long").alias("level"), F.col("turn").alias("top"))
    asked = calls.select(*key, F.explode(F.array_distinct("depends_on")).alias("needs"), F.lit(1).cast("long").alias("hops"))
    known = calls.select("conv_id", F.col("id").alias("needs"))
    edges = cut(asked.join(known, ["conv_id", "needs"], "left_semi").select(*key, "needs", "hops"))
    if edges.limit(1).count() == 0:
        return nodes
    nodes = cut(nodes.join(edges.groupBy(*key).agg(F.count(F.lit(1)).alias("open")), key, "left").na.fill(0, ["open"]))
    settled = nodes.filter("open = 0").count()
    while settled:
        # what a call waits for: its level and latest turn so far, and what it waits for itself if that is one call
        single = edges.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first("needs").alias("next"), F.first("hops").alias("more")).filter("n = 1").drop("n")
        other = nodes.join(single, key, "left").select("conv_id", F.col("id").alias("needs"), F.col("level").alias("l"), F.col("top").alias("t"), "open", "next", "more")
        met = edges.join(other, ["conv_id", "needs"])
        folded = met.groupBy(*key).agg(F.max(F.col("l") + F.col("hops")).alias("l"), F.max("t").alias("t"))
        jump = met.filter("open > 0").select(*key, F.coalesce("next", "needs").alias("needs"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"))
        edges = cut(jump.groupBy(*key, "needs").agg(F.max("hops").alias("hops")))
        left = edges.groupBy(*key).agg(F.count(F.lit(1)).alias("open"))
        nodes = cut(
            nodes.drop("open").join(folded, key, "left").join(left, key, "left")
            .select(*key, F.greatest("level", "l").alias("level"), F.greatest("top", "t").alias("top"), F.coalesce("open", F.lit(0)).alias("open"))
        )
        now = nodes.filter("open = 0").count()
        if now == settled:  # who still waits does so for a cycle
            break
        settled = now
    return nodes.select(*key, F.when(F.col("open") == 0, F.col("level")).alias("level"), F.when(F.col("open") == 0, F.col("top")).alias("top"))


def _argument_faults(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, turn, at, fault) of calls whose arguments break their tool's schema; the first fault by name."""
    tools = schemas.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("param", F.struct("type", "required")))).alias("params"))
    met = calls.join(tools, "name", "left")
    given = F.coalesce(F.col("args"), F.create_map().cast("map<string,variant>"))
    missing = F.exists(F.map_entries("params"), lambda e: e["value"]["required"] & ~F.map_contains_key(given, e["key"]))
    unknown = F.exists(F.map_keys(given), lambda k: ~F.map_contains_key(F.col("params"), k))
    allowed = F.lit(None).cast("array<string>")
    accept = lambda t: F.coalesce(*[F.when(t == n, F.array(*map(F.lit, v))) for n, v in TYPES.items()], allowed)
    wrong = F.exists(F.map_entries(given), lambda e: ~F.coalesce(F.array_contains(accept(F.col("params")[e["key"]]["type"]), _type_of(e["value"])), F.lit(False)))
    fault = F.when(F.isnull("params"), "unknown_tool").when(F.col("bad_args"), "not_an_object").when(missing, "missing_argument").when(unknown, "unknown_argument").when(wrong, "wrong_type")
    return met.select("conv_id", "turn", "at", fault.alias("fault"))


def format_turns(turns: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """One row per message, call and result; see the module's text.

    Columns: conv_id, turn, kind (message, call, result), call_id, linked_turn (the turn of the result's call or
    of the call's first result), status, order_turn, level, message_json.
    """
    spark = turns.sparkSession
    schemas = schemas if schemas is not None else spark.createDataFrame([], SCHEMA_DDL)
    parsed = parse_turns(turns)
    calls_of = F.try_variant_get("body", "$.tool_calls", "array<variant>")
    result_of = F.try_variant_get("body", "$.tool_call_id", "string")
    kinds = parsed.withColumn("_calls", calls_of).withColumn("_result", result_of)
    fields = F.map_keys(F.try_variant_get("body", "$", "map<string,variant>"))
    beside = F.coalesce(F.size(F.array_remove(fields, "tool_calls")) > 0, F.lit(False))
    messages = kinds.filter(F.isnull("_result") & (F.isnull("_calls") | (F.size("_calls") == 0) | beside))
    nothing = [F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("long").alias("linked_turn")]
    plain = messages.select(
        "conv_id", "turn", F.lit("message").alias("kind"), *nothing, F.lit("message").alias("status"),
        F.col("turn").alias("order_turn"), F.lit(0).cast("long").alias("level"),
        _message(role=F.col("role"), content=F.col("text")).alias("message_json"),
    )
    tools = cut(kinds.filter(F.isnotnull("_calls") | F.isnotnull("_result")).select("conv_id", "turn", "role", F.to_json("body").alias("json"), "_result"))
    if tools.limit(1).count() == 0:  # nothing to link
        return plain
    again = tools.withColumn("body", F.parse_json("json"))
    each = again.select("conv_id", "turn", "role", F.posexplode(F.try_variant_get("body", "$.tool_calls", "array<variant>")).alias("at", "call"))
    calls = each.select(
        "conv_id", "turn", "at", "role",
        F.try_variant_get("call", "$.id", "string").alias("id"), F.try_variant_get("call", "$.name", "string").alias("name"),
        F.try_variant_get("call", "$.arguments", "map<string,variant>").alias("args"),
        (F.coalesce(_type_of(F.try_variant_get("call", "$.arguments", "variant")), F.lit("VOID")).isin("VOID", "OBJECT") == F.lit(False)).alias("bad_args"),
        F.coalesce(F.try_variant_get("call", "$.depends_on", "array<string>"), F.array().cast("array<string>")).alias("depends_on"),
        F.to_json("call").alias("json"),
    )
    owner = calls.filter(F.isnotnull("id")).groupBy("conv_id", "id").agg(F.min(F.struct("turn", "at")).alias("own"))
    results = again.filter(F.isnotnull("_result")).select("conv_id", "turn", "role", F.col("_result").alias("id"), "json")
    owned = owner.select("conv_id", "id", F.col("own.turn").alias("own_turn"), F.col("own.at").alias("own_at"))
    owned_results = results.join(owned, ["conv_id", "id"], "left")
    answers = owned_results.filter("turn > own_turn").groupBy("conv_id", "id").agg(F.min("turn").alias("answer"))
    first = calls.join(owner, ["conv_id", "id"]).filter((F.col("turn") == F.col("own.turn")) & (F.col("at") == F.col("own.at"))).select("conv_id", "id", "turn", "depends_on")
    first = cut(first.dropDuplicates(["conv_id", "id"]))
    levels = _levels(first)
    known = first.select("conv_id", F.col("id").alias("needs"))
    unknown = first.select("conv_id", "id", F.explode("depends_on").alias("needs")).join(known, ["conv_id", "needs"], "left_anti")
    lost = unknown.select("conv_id", "id").distinct().withColumn("lost", F.lit(True))
    faults = _argument_faults(calls.select("conv_id", "turn", "at", "name", "args", "bad_args"), schemas).groupBy("conv_id", "turn", "at").agg(F.min("fault").alias("fault"))
    call_rows = (
        calls.drop("args", "bad_args").join(owned, ["conv_id", "id"], "left").join(answers, ["conv_id", "id"], "left")
        .join(levels, ["conv_id", "id"], "left").join(lost, ["conv_id", "id"], "left").join(faults, ["conv_id", "turn", "at"], "left")
    )
    mine = (F.col("turn") == F.col("own_turn")) & (F.col("at") == F.col("own_at"))
    status = (
        F.when(F.isnotnull("id") & ~F.coalesce(mine, F.lit(False)), "duplicate_id").when(F.isnotnull("fault"), F.col("fault"))
        .when(F.isnotnull("id") & F.isnull("level"), "cyclic").when(F.col("lost"), "unknown_dependency").when(F.isnull("answer"), "unanswered").otherwise("ok")
    )
    own_call = F.coalesce(mine, F.lit(False))
    call_out = call_rows.select(
        "conv_id", "turn", F.lit("call").alias("kind"), F.col("id").alias("call_id"), F.when(own_call, F.col("answer")).alias("linked_turn"), status.alias("status"),
        F.coalesce(F.when(own_call, F.col("top")), F.col("turn")).alias("order_turn"),
        F.when(own_call, F.coalesce(F.col("level") * 2, F.lit(-1))).otherwise(0).cast("long").alias("level"),
        F.concat(F.lit('{"role":'), _quoted(F.col("role")), F.lit(',"tool_call":'), "json", F.lit("}")).alias("message_json"),
    )
    result_rows = owned_results.join(levels, ["conv_id", "id"], "left")
    linked = F.coalesce(F.col("turn") > F.col("own_turn"), F.lit(False))
    result_out = result_rows.select(
        "conv_id", "turn", F.lit("result").alias("kind"), F.col("id").alias("call_id"), F.when(linked, F.col("own_turn")).alias("linked_turn"),
        F.when(linked, "linked").when(F.isnotnull("own_turn"), "early").otherwise("orphan").alias("status"),
        F.when(linked, F.coalesce("top", "own_turn")).otherwise(F.col("turn")).alias("order_turn"),
        F.when(linked, F.coalesce(F.col("level") * 2 + 1, F.lit(0))).otherwise(0).cast("long").alias("level"),
        F.concat(F.lit('{"role":'), _quoted(F.col("role")), F.lit(',"tool_result":'), "json", F.lit("}")).alias("message_json"),
    )
    return plain.unionByName(call_out).unionByName(result_out)
