"""What must not grow with the input: rows of a task, batches of a stream, what the driver gathers."""

import os

import pytest
from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.operators import normalize, skew
from postlake.operators.manifest import not_yet_written
from postlake.registry import QUERIES, inputs, streams
from postlake.sinks import tables
from postlake.sources import jsonl
from tests.conftest import plan_of, values


@pytest.fixture
def orders(spark, folder):
    """Orders with parts: one repeated in all columns, one that differs in its date, one without line items,
    a part without a name, one that is missing, one without a key."""
    spark.sql("""SELECT * FROM VALUES (1L, 'P', TIMESTAMP '1995-01-01', '1-URGENT'), (1L, 'P', TIMESTAMP '1995-01-01', '1-URGENT'),
      (2L, 'O', TIMESTAMP '1995-01-02', '5-LOW'), (2L, 'O', TIMESTAMP '1995-01-03', '5-LOW'), (3L, 'O', NULL, NULL),
      (NULL, 'O', NULL, NULL), (4L, 'F', TIMESTAMP '1995-01-04', '2-HIGH')
      o(o_orderkey, o_orderstatus, o_orderdate, o_orderpriority)""").write.parquet(f"{folder}/orders.parquet")
    spark.sql("""SELECT * FROM VALUES (1L, 11L, 5L, 2, 'N'), (1L, 10L, 6L, 1, 'A'), (2L, 12L, 5L, 1, NULL), (4L, 99L, 7L, 1, 'R'),
      (4L, NULL, NULL, NULL, NULL), (NULL, 10L, 5L, 1, 'A')
      l(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag)""").write.parquet(f"{folder}/lineitem.parquet")
    spark.sql("""SELECT * FROM VALUES (10L, 'red hat', 'Brand#1'), (11L, '', 'Brand#2'), (12L, NULL, 'Brand#3')
      p(p_partkey, p_name, p_brand)""").write.parquet(f"{folder}/part.parquet")
    return folder


def test_posts_of_awkward_orders(spark, orders):
    got = values(fx.post_src(spark, orders), "id", "tag_string_general", "tag_string_character", "tag_string_copyright", "tag_string_meta")
    assert got == sorted([
        (1, "red hat red hat  ", "part_10 part_10 part_11 part_11", "brand_1 brand_1 brand_2 brand_2", "flag_a flag_a flag_n flag_n"),
        (2, None, "part_12", "brand_3", None), (2, None, "part_12", "brand_3", None), (3, None, None, None, None),
        (None, None, None, None, None), (4, None, "part_99", None, "flag_r"),
    ], key=str)


def test_partitions_and_buckets_follow_the_rows(spark, orders, monkeypatch):
    monkeypatch.setattr(fx, "ITEM_ROWS", 1)
    monkeypatch.setattr(fx, "MIN_PARTS", 1)
    monkeypatch.setattr(fx, "BUCKET_POSTS", 2)
    plan = plan_of(fx.post_src(spark, orders))
    assert "hashpartitioning(l_orderkey" in plan and ", 6), REPARTITION_BY_NUM" in plan  # six line items
    assert fx.buckets(spark, orders) == 3  # six posts


def test_line_items_are_hashed_and_never_sorted(spark, orders, monkeypatch):
    monkeypatch.setattr(fx, "ITEM_ROWS", 1)
    plan = plan_of(fx.post_src(spark, orders))
    assert "ShuffledHashJoin [l_partkey" in plan and "hashpartitioning(l_partkey" in plan
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and " Sort [" not in plan


def test_facts_of_an_even_join_are_not_sorted(spark):
    facts = spark.range(300).selectExpr("id % 7 AS k", "id AS row")
    dimension = spark.range(9).selectExpr("id AS k", "id * 2 AS v")
    joined = skew.join_even(facts, dimension, ["k"], F.xxhash64("row"), limit=0)
    assert "ShuffledHashJoin [k" in plan_of(joined) and " Sort [" not in plan_of(joined)
    assert values(joined, "k", "row", "v") == values(facts.join(dimension, "k"), "k", "row", "v")


def test_a_small_kind_is_broadcast_whatever_the_others(spark, monkeypatch):
    flat = spark.range(200).selectExpr("id", "'red' AS tag_string_general", "'c' || id AS tag_string_character")
    numbered = normalize.numbered_tags(flat)
    monkeypatch.setattr(skew.join_even, "__defaults__", (None, "inner", 100))
    small = normalize.build_post_tag(flat, numbered, {"general": "tag_string_general"})
    large = normalize.build_post_tag(flat, numbered, {"character": "tag_string_character"})
    assert "_salt" not in plan_of(small) and "_salt" in plan_of(large)
    assert values(small) == [(i, 200) for i in sorted(range(200), key=lambda i: str((i, 200)))]
    assert large.count() == 200


def test_pairs_are_counted_by_tasks_of_few_rows(spark, sf_dir, monkeypatch):
    related = fx.post_tags_by_post(spark, sf_dir)
    monkeypatch.setattr(fx, "RELATION_ROWS", 1000)
    counted = fx.pair_counts(spark, sf_dir, related)
    plan = plan_of(counted)
    parts = -(-related.count() // 1000)
    assert "hashpartitioning(post_id#" in plan and f", {parts}), REPARTITION_BY_NUM" in plan
    assert "HashAggregate" not in plan[plan.index("Exchange"):]  # nothing is counted ahead of the shuffle
    assert values(counted) == values(related.groupBy("post_id", "tag_id").agg(F.count(F.lit(1)).alias("n")))
    repeated = spark.sql("SELECT * FROM VALUES (1L, 2L), (1L, 2L), (NULL, 2L), (NULL, 2L), (1L, NULL) r(post_id, tag_id)")
    assert values(fx.pair_counts(spark, sf_dir, repeated)) == [(1, 2, 2), (1, None, 1), (None, 2, 2)]


def test_files_of_a_relation_hold_few_rows(spark, folder, table_name, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 10)
    tables.append_relation([spark.range(0, 60, 1, 1), spark.range(60, 100, 1, 1)], table_name, f"{folder}/t")
    per_file = spark.table(table_name).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count"), F.sum("count")).first() == (10, 100)


def test_extending_ids_finds_the_tags_once(spark, sf_dir):
    plan = plan_of(QUERIES["extend_tag_ids"](spark, sf_dir))
    assert "tag_string" not in plan


def test_written_keys_are_never_broadcast(spark, folder):
    spark.range(1000).selectExpr("id", "id % 7 AS score").write.parquet(f"{folder}/written")
    posts = spark.range(500, 1500).selectExpr("IF(id % 50 = 0, NULL, id) AS id", "id % 9 AS score")
    left = not_yet_written(posts, spark.read.parquet(f"{folder}/written"))
    assert "Broadcast" not in plan_of(left)
    left.collect()
    assert "Broadcast" not in plan_of(left)
    assert left.where("id IS NOT NULL").agg(F.min("id")).first()[0] == 1001


def test_a_stream_has_few_batches_whatever_its_files(spark, folder):
    for at in range(40):
        with open(f"{folder}/{at}_{at}.jsonl", "w") as out:
            out.write("{}\n")
    assert streams._per_batch(spark, folder, 1, "*.jsonl") == 5
    assert streams._per_batch(spark, folder, 9, "*.jsonl") == 9


def test_line_files_are_compressed_and_keep_their_names(spark, sf_dir):
    root = inputs.line_tree(spark, sf_dir)
    names = [name for _, _, files in os.walk(root.removeprefix("file:")) for name in files if not name.startswith(".")]
    assert names and all(name.endswith(".jsonl.gz") for name in names)
    lines = jsonl.read_lines(spark, root, lambda name: ~name.endswith(".gz"), pattern=inputs.TREE_FILES)
    assert {row[0] for row in lines.select("file_name").distinct().collect()} == {name.removesuffix(".gz") for name in names}
    assert lines.count() == inputs.raw_lines(spark, sf_dir).count()
