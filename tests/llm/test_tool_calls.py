import json

import pytest

from postlake.llm.tool_calls import levels, link, parse_messages

TOOLS = {"search": {"query": ("string", True), "limit": ("integer", False)}, "set": {"on": ("boolean", True), "at": ("number", False), "tags": ("array", False)}}
CALLS = "conv_id BIGINT, turn BIGINT, call_id STRING, name STRING, arguments STRING, depends_on ARRAY<STRING>"
RESULTS = "conv_id BIGINT, turn BIGINT, call_id STRING, content STRING"


def linked(spark, calls, results=()):
    out = link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(list(results), RESULTS), TOOLS)
    return [row.asDict() for row in out.collect()]


def test_parsing(spark):
    call = {"tool_calls": [{"id": "a", "name": "search", "arguments": {"query": "x", "limit": 3}}, {"id": "b", "name": "set", "depends_on": ["a"]}]}
    messages = spark.createDataFrame([
        (1, 1, "assistant", json.dumps(call)), (1, 2, "tool", '{"tool_call_id": "a", "content": "r"}'), (1, 3, "assistant", "{broken"),
        (1, 4, "tool", None), (1, 5, "assistant", "plain"), (1, 6, "user", json.dumps(call)), (1, 7, "tool", "[]"),
    ], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    calls, results = parse_messages(messages)
    assert [tuple(row) for row in calls.collect()] == [
        (1, 1, "a", "search", '{"limit":3,"query":"x"}', []), (1, 1, "b", "set", None, ["a"]),
    ]
    assert [tuple(row) for row in results.collect()] == [(1, 2, "a", "r")]


def test_order_of_a_chain_a_diamond_and_a_cycle(spark):
    depends = {"a": [], "b": ["a"], "c": ["b", "a"], "d": ["b", "c", "gone"], "x": ["y"], "y": ["x"], "z": ["y"], "s": ["s"], "f": ["gone"]}
    rows = [(1, i, key, "search", '{"query":"q"}', on) for i, (key, on) in enumerate(depends.items())]
    rows += [(2, 1, "b", "search", '{"query":"q"}', ["a"])]  # another conversation's identifiers are its own
    got = {(row["conv_id"], row["call_id"]): row["level"] for row in linked(spark, rows)}
    assert got == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "d"): 3, (1, "x"): None, (1, "y"): None, (1, "z"): None, (1, "s"): None, (1, "f"): 0, (2, "b"): 0}
    errors = {row["call_id"]: row["n_errors"] for row in linked(spark, rows) if row["conv_id"] == 1}
    assert {key for key, n in errors.items() if n} == {"x", "y", "z", "s"}
    deep = [(1, i, f"c{i}", "search", None, [f"c{i - 1}"] if i else []) for i in range(6)]
    assert {row["level"] for row in levels(spark.createDataFrame(deep, CALLS)).collect()} == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("name, arguments, errors", [
    ("search", '{"query":"é\\u0001/"}', None), ("search", '{"limit":"3","z":1}', ["limit is no integer", "query is missing", "z is unknown"]),
    ("search", "[1]", ["arguments are no object"]), ("search", "{oops", ["arguments are no object"]), ("search", None, ["arguments are no object"]),
    ("other", "{}", ["unknown tool"]), (None, "{}", ["unknown tool"]), ("set", '{"on":true,"at":1.5,"tags":["a"]}', None),
    ("set", '{"on":null,"at":"x","tags":{}}', ["at is no number", "on is no boolean", "tags is no array"]),
])
def test_validation(spark, name, arguments, errors):
    row = linked(spark, [(1, 1, "a", name, arguments, None)])[0]
    document = json.loads(row["json"])
    assert document.get("errors") == errors and row["n_errors"] == len(errors or [])
    assert row["json"] == json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    if errors is None:
        assert document["arguments"] == json.loads(arguments)


def test_links(spark):
    plain = ("search", '{"query":"q"}', [])
    calls = [(1, 1, "a", *plain), (1, 5, "a", *plain), (1, 2, None, *plain), (None, 3, "n", *plain), (1, 4, "b", *plain), (2, 1, "a", *plain), (1, 1, "a", *plain)]
    results = [(1, 9, "a", "late"), (1, 3, "a", "early"), (1, 3, "a", "earlier text"), (1, 6, "lost", "x"), (1, 7, None, "y"), (None, 1, "n", "z")]
    got = linked(spark, calls, results)
    assert sorted((str(r["conv_id"]), str(r["call_id"]), r["turn"], r["status"]) for r in got) == [
        ("1", "None", 2, "nameless"), ("1", "None", 7, "orphan"), ("1", "a", 1, "linked"), ("1", "a", 1, "linked"), ("1", "a", 5, "repeated"),
        ("1", "b", 4, "unanswered"), ("1", "lost", 6, "orphan"), ("2", "a", 1, "unanswered"), ("None", "n", 1, "orphan"), ("None", "n", 3, "nameless"),
    ]
    assert {json.loads(r["json"])["result"]["content"] for r in got if r["status"] == "linked"} == {"earlier text"}


def test_empty_tables_and_other_columns(spark):
    assert linked(spark, []) == []
    from pyspark.sql import functions as F

    calls = spark.createDataFrame([(1, 1, "a", "search", '{"query":"q"}', [])], CALLS).withColumns({c: F.lit("own") for c in ("level", "status", "json", "_first")})
    assert link(calls, spark.createDataFrame([], RESULTS), TOOLS).first()["status"] == "unanswered"
