"""Chat formatting: tool calls linked with their results, ordered, validated and written as JSON.

Calls and results meet in a hash join on (conversation, identifier), never as one group per
conversation, so that a conversation with a third of all messages spreads like any other. Calls are
ordered by the length of their longest chain of dependencies, peeled off level by level; within a level
by turn. All of it is column expressions and joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.session import cut_lineage

#: Types of a parameter, and how the engine names the JSON values they take.
_TYPES = {
    "string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",),
}
Schema = Mapping[str, tuple[str, bool]]  # parameter to (type, required)
_KEY = ["conv_id", "call_id"]


def parse_messages(messages: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(calls, results) of messages (conv_id, turn, role, text) that hold them as JSON.

    An assistant's ``{"tool_calls": [{"id", "name", "arguments", "depends_on"}]}`` gives a call each; a
    tool's ``{"tool_call_id", "content"}`` a result. Any other text, malformed JSON included, gives none.
    """
    document = F.try_parse_json(F.col(text_col))
    one = "STRUCT<id: STRING, name: STRING, arguments: VARIANT, depends_on: ARRAY<STRING>>"
    calls = messages.where("role = 'assistant'").select(
        "conv_id", "turn", F.explode(F.try_variant_get(document, "$.tool_calls", f"ARRAY<{one}>")).alias("_call")
    ).select(
        "conv_id", "turn", F.col("_call.id").alias("call_id"), F.col("_call.name").alias("name"),
        F.to_json("_call.arguments").alias("arguments"),
        F.coalesce("_call.depends_on", F.array().cast("array<string>")).alias("depends_on"),
    )
    results = messages.where("role = 'tool'").select(
        "conv_id", "turn", F.try_variant_get(document, "$.tool_call_id", "string").alias("call_id"),
        F.try_variant_get(document, "$.content", "string").alias("content"),
    ).where("call_id IS NOT NULL")
    return calls, results


def schema_errors(name: Column, arguments: Column, tools: Mapping[str, Schema]) -> Column:
    """What is wrong with a call's arguments (JSON text), in alphabetical order; empty if nothing is."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    found = [F.when(~F.coalesce(name.isin(list(tools)), F.lit(False)), F.lit("unknown tool")), F.when(~is_object, F.lit("arguments are no object"))]
    allowed = F.array().cast("array<string>")
    for tool, schema in tools.items():
        allowed = F.when(name == tool, F.array(*map(F.lit, schema))).otherwise(allowed)
        for parameter, (kind, required) in schema.items():
            held = F.schema_of_variant(F.try_variant_get(value, f"$.{parameter}", "variant"))
            right = F.regexp_extract(held, r"^[A-Z]+", 0).isin(*_TYPES[kind])
            fault = F.when(held.isNotNull() & ~right, F.lit(f"{parameter} is no {kind}"))
            if required:
                fault = F.when(is_object & held.isNull(), F.lit(f"{parameter} is missing")).otherwise(fault)
            found.append(F.when(name == tool, fault))
    keys = F.when(is_object & name.isin(list(tools)), F.json_object_keys(arguments))
    unknown = F.transform(F.array_except(F.coalesce(keys, F.array().cast("array<string>")), allowed), lambda key: F.concat(key, F.lit(" is unknown")))
    return F.array_sort(F.concat(F.filter(F.array(*found), lambda one: one.isNotNull()), unknown))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): the length of the longest chain of dependencies below each call that
    has any; null on a cycle or behind one. Dependencies on calls that do not exist do not count.

    One round per level; what is left is written to the shared folder between rounds.
    """
    known = calls.select("conv_id", "call_id").distinct()
    edges = calls.select("conv_id", "call_id", F.explode("depends_on").alias("_on")).where("_on IS NOT NULL").distinct()
    edges = edges.join(known.withColumnRenamed("call_id", "_on"), ["conv_id", "_on"], "left_semi")
    open_ = cut_lineage(edges)
    done = open_.select("conv_id", "call_id", F.lit(0).alias("level")).limit(0)
    # A dependency that depends on nothing itself is settled at once.
    level = 0
    waiting = cut_lineage(open_.select("conv_id", "call_id").distinct())
    while not waiting.isEmpty():
        blocked = waiting.select("conv_id", F.col("call_id").alias("_on"))
        still = cut_lineage(open_.join(blocked, ["conv_id", "_on"], "left_semi"))
        left = cut_lineage(still.select("conv_id", "call_id").distinct())
        level += 1
        free = cut_lineage(waiting.join(left, _KEY, "left_anti"))
        if free.isEmpty():
            return done.unionByName(left.withColumn("level", F.lit(None).cast("int")))
        done = done.unionByName(free.withColumn("level", F.lit(level)))
        open_, waiting = still, left
    return done


def link(calls: DataFrame, results: DataFrame, tools: Mapping[str, Schema]) -> DataFrame:
    """A row per call and per result without a call: conv_id, turn, call_id, level, status, n_errors, json.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), depends_on; ``results``: conv_id,
    turn, call_id, content. In order of (conv_id, level, turn) every call follows what it depends on.
    ``status``: ``linked``, ``unanswered``, ``repeated`` (an earlier call has the identifier), ``nameless``
    (a null identifier, which never links) or ``orphan`` (a result without a call). Of several results
    the earliest, then the smallest text, counts; of calls that share identifier and turn, every one.
    Empty tables give no rows. Columns beyond those named are not carried.

    ``json`` is canonical: keys in order, no spaces, absent values left out, numbers as the engine's
    VARIANT writes them; arguments that are no JSON stand as text.
    """
    calls = calls.select("conv_id", F.col("turn").cast("long").alias("turn"), "call_id", "name", "arguments", F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    results = results.select("conv_id", F.col("turn").cast("long").alias("turn"), "call_id", "content")
    named = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    firsts = named.groupBy(*_KEY).agg(F.min("turn").alias("_first"))
    answers = results.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy(*_KEY).agg(
        F.min(F.struct("turn", "content")).alias("_answer")
    )
    depth = cut_lineage(levels(named))
    known = firsts.join(answers, _KEY, "left").join(depth.withColumn("_deep", F.lit(True)), _KEY, "left")
    joined = calls.join(known, _KEY, "left")
    first = F.col("_first").isNotNull() & F.col("turn").eqNullSafe(F.col("_first"))
    status = (
        F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), "nameless").when(~first, "repeated")
        .when(F.col("_answer").isNotNull(), "linked").otherwise("unanswered")
    )
    cyclic = F.col("_deep").isNotNull() & F.col("level").isNull()
    errors = F.concat(schema_errors(F.col("name"), F.col("arguments"), tools), F.when(cyclic, F.array(F.lit("depends on itself"))).otherwise(F.array().cast("array<string>")))
    answer = F.when(status == "linked", F.struct(F.col("_answer.content").alias("content"), F.col("_answer.turn").alias("turn")))
    shaped = joined.withColumns({"status": status, "errors": F.array_sort(errors), "_result": answer}).withColumns({
        "level": F.when(~cyclic, F.coalesce("level", F.lit(0))), "_parsed": F.try_parse_json("arguments"),
    })
    as_call = F.to_json(F.struct(
        F.col("_parsed").alias("arguments"),
        F.when(F.col("_parsed").isNull(), F.col("arguments")).alias("arguments_text"),
        F.when(F.size("errors") > 0, F.col("errors")).alias("errors"), F.col("call_id").alias("id"), "level", "name",
        F.col("_result").alias("result"), F.lit("assistant").alias("role"), "status", "turn",
    ))
    done = shaped.select("conv_id", "turn", "call_id", "level", "status", F.size("errors").cast("long").alias("n_errors"), as_call.alias("json"))
    lonely = results.join(firsts, _KEY, "left_anti").select(
        "conv_id", "turn", "call_id", F.lit(None).cast("int").alias("level"), F.lit("orphan").alias("status"),
        F.lit(0).cast("long").alias("n_errors"),
        F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("tool").alias("role"), F.lit("orphan").alias("status"), "turn")).alias("json"),
    )
    return done.unionByName(lonely)
