"""Records as maps of paths, against a recursive flattening."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postlake.operators import paths
from postlake.plans.ingest import flat_records
from tests.conftest import plan_of


def flatten(value, prefix=""):
    if isinstance(value, dict):
        pairs = [pair for k, v in value.items() for pair in flatten(v, f"{prefix}.{k}" if prefix else k).items()]
        return dict(pairs)
    if isinstance(value, list):
        return flatten({str(i): v for i, v in enumerate(value)}, prefix)
    text = {True: "true", False: "false", None: None}.get(value, str(value)) if isinstance(value, bool) or value is None else str(value)
    return {prefix: text}


KEYS = st.text("ab.", min_size=1, max_size=3).filter(lambda key: key.strip("."))
SCALARS = st.one_of(st.none(), st.booleans(), st.integers(-10**30, 10**30), st.text('ab[]{}"\\: é😀', max_size=6))
DOCS = st.recursive(SCALARS, lambda inner: st.lists(inner, max_size=3) | st.dictionaries(KEYS, inner, max_size=3), max_leaves=14)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(KEYS, DOCS, max_size=5))
def test_maps_agree_with_a_recursion(document):
    got = paths.flat_map(paths._READ(json.dumps(document)))
    want = flatten(document)
    assert got == want


def maps(spark, *lines, strict=False):
    frame = spark.createDataFrame(list(enumerate(lines)), "n INT, line STRING")
    return [(row["n"], row["place"], row["fields"]) for row in paths.record_maps(frame, ["n"], strict).orderBy("n", "place").collect()]


def test_the_last_in_the_document_wins(spark):
    assert maps(spark, '{"a.b":2,"a":{"b":1}}', '{"a":{"b":1},"a.b":2}', '{"k":1,"k":2}', '{"l":[1,2],"l.1":"x"}') == [
        (0, 0, {"a.b": "1"}), (1, 0, {"a.b": "2"}), (2, 0, {"k": "2"}), (3, 0, {"l.0": "1", "l.1": "x"}),
    ]


def test_envelopes(spark):
    lines = ['{"post":[{"id":1},{},7],"x":1}', '{"post":{"id":3}}', '{"post":[],"id":4}', '{"post":null,"id":5}', '{"post":{},"id":6}']
    assert maps(spark, *lines) == [
        (0, 0, {"id": "1"}), (0, 1, {}), (0, 2, {"": "7"}), (1, 0, {"id": "3"}), (2, 0, {"id": "4"}), (3, 0, {"id": "5"}), (4, 0, {"id": "6"}),
    ]


def test_lines_that_hold_no_object(spark):
    odd = [None, "", "cut {", "[1]", "5", '{"a":NaN}', '{"a":1} x']
    assert maps(spark, *odd, '{"a":1.50,"b":1e3,"c":"\\ud800x"}') == [(7, 0, {"a": "1.50", "b": "1e3", "c": "?x"})]
    with pytest.raises(Exception, match="Expecting"):
        maps(spark, '{"a"', strict=True)


def test_depth_and_size(spark):
    deep = '{"a":' * 900 + "1" + "}" * 900
    wide = json.dumps({f"k{i}": i for i in range(50_000)})
    (_, _, first), (_, _, second) = maps(spark, deep, wide)
    assert first == {".".join("a" * 900): "1"} and len(second) == 50_000


def test_columns_clash_with_nothing_and_tables_may_be_empty(spark):
    frame = spark.createDataFrame([("own", "x", '{"place":1}')], "fields_own STRING, path STRING, line STRING")
    got = paths.path_rows(paths.record_maps(frame.withColumnRenamed("path", "file"), ["file"]))
    assert [tuple(row) for row in got.collect()] == [("x", 0, "place", "1")]
    assert paths.record_maps(frame.where("false"), ["path"]).collect() == []


def test_keep_all_shuffles_nothing(spark, folder):
    with open(f"{folder}/1_2.jsonl", "w") as out:
        out.write('{"id":1,"a":{"b":2},"a.b":3}\n{"id":1}\n{"id":2}\n')
    kept = flat_records(spark, folder, keep_all=True, deduplicate=False)
    assert "Exchange" not in plan_of(kept)
    once = flat_records(spark, folder, keep_all=True)
    assert {row["fields"]["id"]: row["fields"] for row in once.collect()} == {"1": {"id": "1", "a.b": "3"}, "2": {"id": "2"}}
