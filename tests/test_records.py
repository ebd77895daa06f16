"""Parsing, envelopes, flattening and schemas of JSON lines."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlake.operators import records
from postlake.operators.dedup import dedup_by_id
from postlake.operators.records import RECORD_ORDER
from postlake.plans.ingest import flat_records, jsonl_to_parquet
from postlake.schemas import POST_FIELDS
from postlake.sources import jsonl
from tests.conftest import plan_of, values


def write(folder, name, *lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write("".join(line + "\n" for line in lines))


def lines_of(spark, *lines):
    return spark.createDataFrame(list(enumerate(lines)), "n int, line string")


def flatten(spark, *lines):
    source = lines_of(spark, *lines)
    recs = records.unwrap_envelope(jsonl.parse_tolerant(source))
    depth, dotted = records.nesting(source)
    rows = records.flatten_paths(recs, ["n", "place"], depth, dotted)
    return {(r["n"], r["place"], r["path"]): r["value"] for r in rows.collect()}


def test_flatten_literal(spark):
    line = '{"a":{"b":[1,{"c":null}]},"e":{},"s":"x","l":[]}'
    assert flatten(spark, line) == {
        (0, 0, "a.b.0"): "1", (0, 0, "a.b.1.c"): None, (0, 0, "s"): "x",
    }


def test_flatten_brackets_in_strings_and_repeated_keys(spark):
    got = flatten(spark, r'{"a":"[{\"x\\","b":{"c":"]}"},"k":1,"k":2}', '{"x.y":1,"x":{"y":2}}')
    assert got == {
        (0, 0, "a"): '[{"x\\', (0, 0, "b.c"): "]}", (0, 0, "k"): "2", (1, 0, "x.y"): "1",
    }


def paths(value, trail=()):
    """Expected (path, scalar) pairs of a document."""
    if isinstance(value, dict):
        return [p for k, v in value.items() for p in paths(v, (*trail, k))]
    if isinstance(value, list):
        return [p for i, v in enumerate(value) for p in paths(v, (*trail, str(i)))]
    return [(".".join(trail), value)]


KEYS = st.text("abc[{\"\\", min_size=1, max_size=3)
SCALARS = st.one_of(st.none(), st.integers(-1000, 1000), st.text('ab[]{}"\\: ', max_size=6))
DOCS = st.recursive(
    SCALARS, lambda inner: st.lists(inner, max_size=3) | st.dictionaries(KEYS, inner, max_size=3),
    max_leaves=12,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(KEYS, DOCS, max_size=4), min_size=1, max_size=30))
def test_flatten_agrees(spark, documents):
    got = flatten(spark, *[json.dumps(d) for d in documents])
    want = {
        (n, 0, path): None if value is None else str(value)
        for n, document in enumerate(documents) for path, value in paths(document)
    }
    assert got == want


def test_unwrap_envelope(spark):
    got = lines_of(
        spark, '{"post":[{"id":1},{"id":2}]}', '{"post":{"id":3}}', '{"post":[],"id":4}',
        '{"id":5}', '{"post":null,"id":6}', "cut", "",
    )
    posts = records.schema_fixed(records.unwrap_envelope(jsonl.parse_tolerant(got)))
    assert sorted(r["id"] for r in posts.collect()) == [1, 2, 3, 4, 5, 6]
    assert flatten(spark, '{"post":null,"id":6}') == {(0, 0, "id"): "6"}
    assert flatten(spark, '{"post":[{"post":1}]}') == {(0, 0, "post"): "1"}


def test_schema_fixed_values(spark):
    line = json.dumps({
        "id": 1, "score": 3.5, "source": "[x", "rating": {"a": 1}, "is_deleted": True,
        "file_ext": ["y"], "fav_count": "7", "tag_string": "{", "pixiv_id": 2**60, "other": 1,
    })
    recs = records.unwrap_envelope(jsonl.parse_tolerant(lines_of(spark, line)))
    row = records.schema_fixed(recs).first()
    assert (row["id"], row["score"], row["source"], row["rating"]) == (1, None, "[x", None)
    assert (row["is_deleted"], row["file_ext"], row["fav_count"]) == (True, None, 7)
    assert (row["tag_string"], row["pixiv_id"], row["preview_file_url"]) == ("{", 2**60, None)
    assert set(POST_FIELDS) <= set(records.schema_fixed(recs).columns)


def test_keep_keys(spark):
    recs = records.unwrap_envelope(
        jsonl.parse_tolerant(lines_of(spark, '{"a":{"0":"p"},"b":["q",{"c":2.5}],"d":{"e":[1]}}'))
    )
    row = records.keep_keys(recs, ["a.0", "b.0", "b.1.c", "d", "d.e.0", "zz"]).first()
    assert tuple(row)[-6:] == ("p", "q", "2.5", None, "1", None)


def test_keep_all_columns(spark):
    source = lines_of(spark, '{"a":1}', '{"b":{"c":"x"}}', "{}", '{"e":{}}')
    recs = records.unwrap_envelope(jsonl.parse_tolerant(source))
    rows = records.flatten_paths(recs, ["n"], *records.nesting(source))
    kept = records.schema_keep_all(recs, rows, ["n"])
    assert {row["n"]: row["fields"] for row in kept.collect()} == {0: {"a": "1"}, 1: {"b.c": "x"}, 2: {}, 3: {}}
    wide = records.fields_as_columns(kept, ["a", "b.c"])
    assert wide.columns == ["n", "a", "b.c"]
    assert values(wide) == sorted([(0, "1", None), (1, None, "x"), (2, None, None), (3, None, None)], key=str)


def test_bad_lines(spark, folder):
    write(folder, "x/0_9.jsonl", '{"id":1}', "{cut", "", "[1]")
    parsed = jsonl.parse_tolerant(jsonl.read_lines(spark, folder))
    assert values(jsonl.bad_lines(parsed), "line") == [("",), ("[1]",), ("{cut",)]
    assert values(jsonl.good_lines(parsed), "line") == [('{"id":1}',)]
    with pytest.raises(Exception, match="MALFORMED"):
        jsonl.parse_strict(jsonl.read_lines(spark, folder)).select("doc").collect()


def names_read(spark, folder, keep=None, **options):
    return {r[0] for r in jsonl.read_lines(spark, folder, keep, **options).select("file_name").collect()}


def test_prune_files(spark, folder):
    for name in ("0_19", "20_39", "posts_40_59", "9_3", "notes", "5_x", "a_b_c"):
        write(folder, f"d/{name}.jsonl", '{"id":1}')
    write(folder, "other.txt", "no")
    assert names_read(spark, folder, lambda n: jsonl.from_min_id(n, 5)) == {
        "20_39.jsonl", "posts_40_59.jsonl", "9_3.jsonl", "notes.jsonl", "5_x.jsonl", "a_b_c.jsonl",
    }
    assert names_read(spark, folder, lambda n: jsonl.from_id_range(n, 25)) == {
        "20_39.jsonl", "posts_40_59.jsonl", "notes.jsonl", "5_x.jsonl", "a_b_c.jsonl",
    }


def test_prune_files_strict(spark, folder):
    for name in ("0_19.jsonl", "20_39.txt", "9_3.jsonl", "plain.jsonl"):
        write(folder, name, "{}")
    keep = lambda n: jsonl.from_id_range_strict(n, 5)
    assert names_read(spark, folder, keep, pattern=None) == {"0_19.jsonl", "20_39.txt"}
    write(folder, "posts_1_2.jsonl", "{}")
    with pytest.raises(Exception, match="file name is not A_B"):
        names_read(spark, folder, keep, pattern=None)


def test_pruned_files_are_not_opened(spark, folder):
    for low in range(0, 100, 20):
        write(folder, f"{low}_{low + 19}.jsonl", '{"id":1}')
    lines = jsonl.read_lines(spark, folder, lambda n: jsonl.from_min_id(n, 60))
    lines.collect()
    metrics = lines._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.apply("numFiles").value() == 2


def test_missing_files(spark, folder):
    assert jsonl.read_lines(spark, folder).count() == 0
    with pytest.raises(FileNotFoundError):
        jsonl.read_lines(spark, folder, must_exist=True)


def test_key_list(spark, folder):
    write(folder, "keys.txt", " id ", "", "score\t")
    path = f"{folder}/keys.txt"
    assert values(jsonl.load_key_list(spark, path)) == [("id",), ("score",)]
    assert len(values(jsonl.load_key_list(spark, path, keep_blank=True))) == 3
    assert jsonl.keep_list(spark, path) == ["id", "score"]
    write(folder, "none.txt", "", " ")
    with pytest.raises(ValueError):
        jsonl.keep_list(spark, f"{folder}/none.txt")


def test_dedup_keeps_first_line_and_all_without_id(spark, folder):
    write(folder, "0_9.jsonl", '{"id":1,"score":1}', '{"id":1,"score":2}', '{"score":3}', '{"score":3}')
    write(folder, "10_19.jsonl", '{"post":[{"id":1,"score":4},{"id":2,"score":5},{"id":2,"score":6}]}')
    flat = flat_records(spark, folder)
    got = sorted((r["id"] or 0, r["score"]) for r in flat.collect())
    assert got == [(0, 3), (0, 3), (1, 1), (2, 5)]
    assert flat_records(spark, folder, keys=["score"]).count() == 7  # no id, no dedup
    assert flat_records(spark, folder, deduplicate=False).count() == 7
    whole = flat_records(spark, folder, keep_all=True)
    assert sorted(r["fields"]["score"] for r in whole.collect()) == ["1", "3", "3", "5"]
    assert flat_records(spark, folder, min_id=10).count() == 2


def test_dedup_drops_copies_before_the_shuffle(spark):
    copies = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.col("id").alias("row")
    )
    once = dedup_by_id(copies, ["row"])
    plan = plan_of(once)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1
    assert once.count() == copies.select("id").distinct().count()
    assert once.where("id = 7").first()["row"] == 0


def test_jsonl_to_parquet(spark, folder):
    write(folder, "in/0_9.jsonl", '{"id":1}')
    assert jsonl_to_parquet(spark, f"{folder}/in", f"{folder}/out") is True
    assert list(spark.read.parquet(f"{folder}/out").columns) == list(POST_FIELDS)
    assert jsonl_to_parquet(spark, f"{folder}/in", f"{folder}/none", min_id=5) is False
    assert not os.path.exists(f"{folder}/none".removeprefix("file:"))


def test_align_schema(spark):
    df = spark.createDataFrame([("7", "x"), ("bad", "y")], "id string, extra string")
    rows = records.align_schema(df, {"id": "BIGINT", "score": "BIGINT"})
    assert values(rows) == [(7, None), (None, None)]


def test_line_order_follows_the_file(spark, folder):
    write(folder, "0_9.jsonl", *[json.dumps({"id": i}) for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = jsonl.read_lines(spark, folder)
        assert lines.rdd.getNumPartitions() > 2
        ordered = lines.orderBy(*RECORD_ORDER[:3]).select("line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [json.loads(r["line"])["id"] for r in ordered] == list(range(5000))
