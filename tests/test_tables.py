"""Normalised tables, statistics, numbering, searches, skew and the plans Spark picks."""

import collections
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.operators import normalize, numbering, search, skew, stats
from postlake.operators.dedup import dedup_rank, merge_bulk_windows
from postlake.plans import ingest, search_captions, tag_report
from postlake.registry import QUERIES
from postlake.schemas import ALL_TAG_COLUMNS
from postlake.sinks import files, tables
from tests.conftest import plan_of, values


@pytest.fixture(scope="module")
def small(spark):
    """Posts where one tag and one post hold a third of all tokens."""
    posts = []
    for i in range(200):
        general = " ".join(["hot"] * 3 + [f"g{i % 7}", "", f"g{i % 5}"])
        posts.append((i, f"2024-{1 + i % 12:02d}-01T00:00:00Z", i % 90, "g", general, f"c{i % 3}", "a_1"))
    posts.append((900, "bad", 5, "q", " ".join(["hot"] * 600 + ["only"]), None, ""))
    posts.append((None, "2020-01-01T00:00:00Z", 5, "q", "hot nameless", None, None))
    return spark.createDataFrame(
        posts,
        "id bigint, created_at string, score bigint, rating string, tag_string_general string, "
        "tag_string_character string, tag_string_artist string",
    )


@pytest.fixture(scope="module")
def built(spark, small):
    numbered = normalize.numbered_tags(small)
    return {
        "numbered": numbered,
        "tag": normalize.tag_table(numbered),
        "post_tag": normalize.build_post_tag(small, numbered),
        "post": normalize.post_table(small),
    }


def brute_tokens(small):
    kinds = {"general": "tag_string_general", "character": "tag_string_character", "artist": "tag_string_artist"}
    return [
        (row["id"], kind, name, row["created_at"])
        for row in small.collect() for kind, column in kinds.items()
        for name in (row[column] or "").split(" ") if name
    ]


def test_tables_against_brute_force(small, built):
    tokens = brute_tokens(small)
    names = sorted({(kind, name) for _, kind, name, _ in tokens})
    ids = {key: i for i, key in enumerate(names)}
    assert values(built["tag"]) == sorted(((i, n, k) for (k, n), i in ids.items()), key=str)
    wanted = sorted(((post, ids[kind, name]) for post, kind, name, _ in tokens), key=str)
    assert values(built["post_tag"]) == wanted


def test_stats_against_brute_force(small, built):
    first, count = {}, collections.Counter()
    for post, kind, name, created in brute_tokens(small):
        if post is None:
            continue
        count[kind, name] += 1
        first.setdefault((kind, name), None)
        if created != "bad":
            when = dt.datetime.fromisoformat(created.replace("Z", ""))
            first[kind, name] = min(first[kind, name] or when, when)
    wanted = {key: (first[key], n) for key, n in count.items()}
    for rows in (
        stats.tag_stats(built["tag"], built["post_tag"], built["post"]),
        stats.tag_stats_from_posts(small, built["tag"]),
    ):
        got = {(r["kind"], r["tag_name"]): (r["first_seen"], r["post_count"]) for r in rows.collect()}
        assert got == wanted
    assert got["general", "only"] == (None, 1)


def test_invariants(spark, sf_dir):
    tag, post_tag, post = fx.tags(spark, sf_dir), fx.post_tags(spark, sf_dir), fx.posts(spark, sf_dir)
    assert post_tag.join(tag, "tag_id", "left_anti").count() == 0
    assert post_tag.join(post, post_tag["post_id"] == post["id"], "left_anti").count() == 0
    n, low, high = tag.agg(F.count("*"), F.min("tag_id"), F.max("tag_id")).first()
    assert (low, high) == (0, n - 1)
    counted = fx.tag_stats(spark, sf_dir).agg(F.sum("post_count")).first()[0]
    assert counted == stats.tag_post_join(tag, post_tag, post).count()


def test_search_equals_chained_intersect(spark, sf_dir):
    tag, post_tag = fx.tags(spark, sf_dir), fx.post_tags(spark, sf_dir)
    named = post_tag.join(tag, "tag_id")
    names = ["red", "plate", "new", "red"]
    chained = None
    for name in names:
        ids = named.where(F.col("name") == name).select("post_id")
        chained = ids if chained is None else chained.intersect(ids)
    found = search.search_intersect(post_tag, tag, names)
    assert values(found) == values(chained) and found.count() > 0


def test_search_edges(spark, small, built):
    look = lambda *names: values(search.search_intersect(built["post_tag"], built["tag"], list(names)))
    assert look("hot", "only") == [(900,)]
    assert look("hot", "unknown") == []
    with pytest.raises(ValueError):
        look()
    many = [f"t{i}" for i in range(130)]
    flat = spark.createDataFrame(
        [(1, " ".join(many)), (2, " ".join(many[:-1]))], "id bigint, tag_string_general string"
    )
    kinds = {"general": "tag_string_general"}
    numbered = normalize.numbered_tags(flat, kinds)
    related = normalize.build_post_tag(flat, numbered, kinds)
    assert values(search.search_intersect(related, numbered, many)) == [(1,)]


def test_a_name_of_two_kinds_counts_once(spark):
    flat = spark.createDataFrame(
        [(1, "x y", "x"), (2, "x", "x"), (3, "y", "x")],
        "id bigint, tag_string_general string, tag_string_artist string",
    )
    kinds = {"general": "tag_string_general", "artist": "tag_string_artist"}
    numbered = normalize.numbered_tags(flat, kinds)
    related = normalize.build_post_tag(flat, numbered, kinds)
    assert values(search.search_intersect(related, numbered, ["x", "y"])) == [(1,), (3,)]


def test_pages_and_caps(spark):
    ids = spark.range(95).select((F.col("id") * 3).alias("post_id")).repartition(5)
    pages = [[r[0] for r in search.search_page(ids, p, 40).collect()] for p in (1, 2, 3, 4)]
    assert pages == [[3 * i for i in range(a, b)] for a, b in ((0, 40), (40, 80), (80, 95), (0, 0))]
    assert [r[0] for r in search.search_all_capped(ids, 50).collect()] == [3 * i for i in range(50)]


def test_large_caps_keep_their_order(spark):
    ids = spark.range(200_000).withColumnRenamed("id", "post_id").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [r[0] for r in search.search_all_capped(ids, 150_000).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == list(range(150_000))


def test_random_posts_repeat_with_their_seed(spark):
    ids = spark.range(1000).withColumnRenamed("id", "post_id")
    first, again, other = (values(search.random_posts(ids.repartition(n), 20, s)) for n, s in ((3, 1), (7, 1), (3, 2)))
    assert first == again != other and len(set(first)) == 20


def test_post_dict_against_brute_force(small, built):
    wanted = collections.defaultdict(lambda: collections.defaultdict(list))
    for post, kind, name, _ in brute_tokens(small):
        wanted[post][kind].append(name)
    rows = search.build_post_dict(built["post_tag"], built["tag"], built["post"].where("id IS NOT NULL"))
    records = rows.collect()
    assert len(records) == 201
    for row in records:
        kinds = wanted[row["id"]]
        for kind, column in ALL_TAG_COLUMNS.items():
            assert row[column] == " ".join(sorted(kinds[kind]))
        assert row["tag_string"] == " ".join(n for k in sorted(kinds) for n in sorted(kinds[k]))


def test_tags_of_some_posts(built):
    rows = stats.tags_grouped_by_kind(built["post_tag"], built["tag"], [3, 900])
    assert values(stats.kinds_ordered(rows)) == sorted([
        (3, "artist", "a_1"), (3, "character", "c0"), (3, "general", "g3 g3 hot hot hot"),
        (900, "general", " ".join(["hot"] * 600 + ["only"])),
    ], key=str)


def test_repeated_names_sort_as_names(spark):
    tag = spark.createDataFrame([(0, "a", "general"), (1, "a\tb", "general"), (2, "a!", "general")], "tag_id bigint, name string, kind string")
    related = spark.createDataFrame([(1, 0), (1, 1), (1, 0), (1, 2)], "post_id bigint, tag_id bigint")
    post = spark.createDataFrame([(1,)], "id bigint")
    assert search.build_post_dict(related, tag, post).first()["tag_string"] == "a a a\tb a!"


def test_id_window_coverage(spark):
    posts = spark.createDataFrame([(5,), (6,), (6,), (41,), (99,)], "id bigint")
    got = values(search.id_window_coverage(posts, 4, 43, 20))
    assert got == sorted([
        (0, 2, [4, *range(7, 20)]), (20, 0, list(range(20, 40))), (40, 1, [40, 42, 43]),
    ], key=str)


def test_merge_windows(spark):
    rows = spark.createDataFrame([(5, "a"), (6, "a"), (9, "b"), (6, "b")], "id bigint, source string")
    merged = merge_bulk_windows([rows, rows.where("id > 5")], 6, 8, ["source"])
    assert values(merged) == [(6, "a")]


def test_numbering_is_dense_over_partitions(spark):
    names = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("name")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = numbering.dense_positions(names, ["name"], "n", start=10)
        rows = placed.orderBy("name").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["n"] for r in rows] == list(range(10, 5010))


def test_extend_tag_ids(spark):
    known = spark.createDataFrame([(0, "general", "b")], "tag_id bigint, kind string, name string")
    tags = spark.createDataFrame([("general", "c"), ("general", "b"), ("artist", "z")], "kind string, name string")
    assert values(numbering.extend_tag_ids(known, tags)) == sorted(
        [(0, "general", "b"), (1, "artist", "z"), (2, "general", "c")], key=str
    )


def test_batches(spark):
    names = spark.range(250).select(F.format_string("t%03d", "id").alias("name"))
    rows = {r["batch"]: r for r in numbering.batch_lookups(names).collect()}
    assert {b: r["n"] for b, r in rows.items()} == {0: 99, 1: 99, 2: 52}
    assert rows[2]["names"].split(" ") == [f"t{i}" for i in range(198, 250)]


@pytest.mark.parametrize("weight", [None, "w"])
def test_even_join_of_a_hot_key(spark, weight):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("row")
    )
    dimension = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    wanted = values(facts.join(dimension, "k"))
    if weight:
        counted = facts.groupBy("k").agg(F.count("*").alias("w"))
        dimension = dimension.join(counted, "k")
    spread = skew.join_even(facts, dimension, ["k"], F.xxhash64("row"), weight, limit=0)
    assert values(spread, "k", "row", "v") == wanted
    assert "_salt" in spread._jdf.queryExecution().optimizedPlan().toString()
    hot = skew.hot_keys(facts.groupBy("k").agg(F.count("*").alias("w")), ["k"], "w")
    assert values(hot) == [(1, 3)]  # a third of the rows fill three of eight partitions
    direct = skew.join_even(facts, dimension, ["k"], F.xxhash64("row"), weight)
    assert "BroadcastHashJoin" in plan_of(direct) and values(direct, "k", "row", "v") == wanted


def test_salts_reach_several_partitions(spark):
    facts = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("row"))
    dimension = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    spread = skew.join_even(facts, dimension, ["k"], F.xxhash64("row"), limit=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        used = spread.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert used >= 4


def test_top_list_plan(spark, sf_dir):
    top = stats.top_new_tags(fx.tag_stats(spark, sf_dir), dt.datetime(1995, 1, 1), 5)
    plan = plan_of(top)
    assert "WindowGroupLimit" in plan
    assert "GreaterThan(post_count,5)" in plan and "GreaterThanOrEqual(first_seen" in plan


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(search.filter_id_window(fx.flat_posts(spark, sf_dir), 123).select("id", "score"))
    assert "GreaterThanOrEqual(id,100)" in plan and "LessThanOrEqual(id,199)" in plan
    assert "ReadSchema: struct<id:bigint,score:bigint>" in plan
    hits = search.search_intersect(fx.post_tags(spark, sf_dir), fx.tags(spark, sf_dir), ["red"])
    assert "PushedFilters: [EqualTo(tag_id," in plan_of(hits) or "PushedFilters: [IsNotNull(tag_id), EqualTo(tag_id," in plan_of(hits)


def test_bucketed_statistics_join_without_exchange(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check_bucketed_plans(spark, sf_dir)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check_bucketed_plans(spark, sf_dir):
    post, related = fx.posts(spark, sf_dir), fx.post_tags_by_post(spark, sf_dir)
    plan = plan_of(related.join(post, related["post_id"] == post["id"]))
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan
    gathered = plan_of(search.build_post_dict(related, fx.tags(spark, sf_dir), post))
    assert "Exchange hashpartitioning" not in gathered


NO_PYTHON = sorted(set(QUERIES) - {n for n in QUERIES if n.startswith(("stream_", "write_", "layout_", "save_", "append_", "compact_"))})


def test_plans_stay_in_the_jvm(spark, sf_dir):
    for name in NO_PYTHON:
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "EvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        for line in plan.splitlines():  # no window over everything
            if "+- Window [" in line:
                assert "], [" in line.replace("Window [", "", 1), (name, line)


def test_rank_survives_ties(spark):
    rows = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("l", 2, "c")], "key string, at int, v string")
    assert values(dedup_rank(rows, ["key"], ["at", "v"]).where("rank = 1"), "key", "v") == [("k", "a"), ("l", "c")]


def test_export_is_one_json_document(spark, sf_dir, folder):
    ranked = stats.filter_stats(fx.tag_stats(spark, sf_dir), dt.datetime(1990, 1, 1), 2)
    files.export_tag_lists(ranked, f"{folder}/tags")
    directory = f"{folder}/tags".removeprefix("file:")
    parts = sorted(n for n in os.listdir(directory) if n.startswith("part-"))
    text = "".join(open(os.path.join(directory, n), encoding="utf-8").read() for n in parts)
    document = json.loads(text)
    assert list(document) == ["characters", "general", "artist"]
    for title, kind in (("characters", "character"), ("general", "general"), ("artist", "artist")):
        names = ranked.where(F.col("kind") == kind).orderBy(F.desc("post_count"), "tag_name").select("tag_name")
        assert document[title] == [r[0] for r in names.collect()]


def test_export_without_tags(spark, sf_dir, folder):
    none = fx.tag_stats(spark, sf_dir).where("false")
    lines = files.tag_list_lines(none).orderBy("section", "position").collect()
    assert json.loads("".join(r["line"] for r in lines)) == {"characters": [], "general": [], "artist": []}


def test_whole_jobs(spark, sf_dir, folder, table_name):
    """Tables, report and search captions over saved tables."""
    prefix = f"{table_name}_"
    flat = fx.flat_posts(spark, sf_dir)
    ingest.build_tables(spark, flat, prefix, folder)
    ingest.build_tables(spark, flat.limit(0), prefix, folder)  # all tables exist: nothing changes
    assert values(spark.table(f"{prefix}tag")) == values(fx.tags(spark, sf_dir))
    assert values(spark.table(f"{prefix}post_tag_by_tag")) == values(fx.post_tags(spark, sf_dir))
    tag_report.refresh_stats(spark, prefix, folder)
    tag_report.refresh_stats(spark, prefix, folder)
    assert values(spark.table(f"{prefix}tag_general_stats")) == values(
        fx.tag_stats(spark, sf_dir).where("kind = 'general'").drop("kind")
    )
    ranked = tag_report.report(spark, dt.datetime(1995, 1, 1), 3, f"{folder}/report", prefix)
    assert ranked.count() > 0
    found = search_captions.matching_posts(spark, ["red", "new"], min_score=0, max_posts=30, prefix=prefix)
    full = search.build_post_dict(fx.post_tags(spark, sf_dir), fx.tags(spark, sf_dir), fx.posts(spark, sf_dir))
    words = F.split("tag_string", " ")
    wanted = full.where("score >= 0").where(F.array_contains(words, "red") & F.array_contains(words, "new"))
    wanted = wanted.orderBy("id").limit(30)
    assert values(found) == values(wanted) and found.count() == 30
    search_captions.save_matches(found, f"{folder}/captions", f"{folder}/json")
    assert spark.read.parquet(f"{folder}/captions").count() == 30
    assert spark.read.json(f"{folder}/json").count() == 30


def test_replace_and_append(spark, folder, table_name):
    tables.replace_table(spark.range(5), table_name, f"{folder}/t")
    tables.replace_table(spark.range(3), table_name, f"{folder}/t")
    tables.append_relation([spark.range(2), spark.range(1)], table_name, f"{folder}/t")
    assert spark.table(table_name).count() == 6


def test_months_prune_partitions(spark, sf_dir, folder, table_name):
    tables.save_by_month(fx.posts(spark, sf_dir), table_name, f"{folder}/t")
    plan = plan_of(spark.table(table_name).where("month = '1996-02'"))
    assert "PartitionFilters: [isnotnull(month" in plan
