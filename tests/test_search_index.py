"""The bitmap index of tags, saved searches, draws and coverage of id windows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from postlake.operators import saved_search, search, tag_index
from tests.conftest import plan_of

TAGS = [(1, "hot", "general"), (2, "rare", "general"), (3, "twin", "artist"), (4, "twin", "general"), (5, "alone", "meta")]


@pytest.fixture(scope="module")
def tag(spark):
    return spark.createDataFrame(TAGS, "tag_id BIGINT, name STRING, kind STRING")


@pytest.fixture(scope="module")
def relation(spark):
    """A tag on a third of 300,000 ids, one on a few, one in two kinds, repeats and posts without an id."""
    ids = spark.range(-40_000, 260_000).withColumnRenamed("id", "post_id")
    parts = [
        ids.where("pmod(post_id, 3) = 0").selectExpr("1L AS tag_id", "post_id"),
        ids.where("post_id IN (-33000, -32768, -3, 0, 3, 32768, 32769, 65536, 99999, 200001)").selectExpr("2L AS tag_id", "post_id"),
        ids.where("pmod(post_id, 5) = 0").selectExpr("3L AS tag_id", "post_id"),
        ids.where("pmod(post_id, 7) = 0").selectExpr("4L AS tag_id", "post_id"),
        spark.sql("SELECT explode(array(2L, 1L)) AS tag_id, CAST(NULL AS BIGINT) AS post_id"),
        spark.sql("SELECT 2L AS tag_id, 3L AS post_id FROM range(1000)"),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


@pytest.fixture(scope="module")
def index(spark, relation):
    tag_index.save_tag_index(relation, "tag_index_of_tests", buckets=5)
    return spark.table("tag_index_of_tests")


def expected(*tests):
    return [i for i in range(-40_000, 260_000) if all(test(i) for test in tests)]


HOT = lambda i: i % 3 == 0
RARE = lambda i: i in (-33000, -32768, -3, 0, 3, 32768, 32769, 65536, 99999, 200001)
TWIN = lambda i: i % 5 == 0 or i % 7 == 0


@pytest.mark.parametrize(("names", "tests"), [
    (["hot"], [HOT]), (["hot", "rare"], [HOT, RARE]), (["twin", "hot"], [TWIN, HOT]), (["rare", "twin", "hot", "rare"], [RARE, TWIN, HOT]),
    (["alone"], [lambda i: False]), (["hot", "unknown"], [lambda i: False]),
])
def test_search_of_hot_and_rare_tags(index, tag, relation, names, tests):
    got = [row[0] for row in tag_index.search_index(index, tag, names).collect()]
    assert sorted(got) == expected(*tests)
    if names != ["alone"]:
        old = search.search_intersect(relation.where("post_id IS NOT NULL"), tag, names)
        assert sorted(row[0] for row in old.collect()) == expected(*tests)
    used = tag.join(relation.groupBy("tag_id").agg(F.count(F.lit(1)).alias("n_uses")), "tag_id", "left").fillna(0)
    assert sorted(row[0] for row in tag_index.search_index(index, used, names).collect()) == sorted(got)


def test_a_rare_tag_costs_a_word_and_not_a_block(spark):
    once = spark.range(5000).selectExpr("id AS tag_id", "id * 40000 AS post_id")
    rows = tag_index.build_tag_index(once, 4)
    assert rows.count() == 5000 and {kind for _, kind in rows.dtypes} <= {"bigint", "int"}  # no bitmap of 4 KB each
    dense = spark.range(1, 32_769).selectExpr("7L AS tag_id", "id AS post_id")
    assert tag_index.build_tag_index(dense).count() == 32_768 // tag_index.WORD_IDS


def test_a_search_shuffles_nothing(index, tag):
    plan = plan_of(tag_index.search_index(index, tag, ["hot", "rare", "twin"]))
    assert "Exchange hashpartitioning(block" not in plan and "SelectedBucketsCount" in plan
    assert "In(tag_id" in plan


def test_searches_need_a_name(index, tag):
    with pytest.raises(ValueError, match="at least one"):
        tag_index.search_blocks(index, tag, [])


def test_min_score_takes_no_score_as_zero(spark, index, tag):
    post = spark.range(-10, 40).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("score"))
    got = tag_index.search_index_min_score(index, tag, post, ["hot"], 0)
    assert sorted(row[0] for row in got.collect()) == [i for i in range(-10, 40) if i % 3 == 0 and (i % 2 or i >= 0)]


def test_pages_of_a_saved_search(spark, index, tag, folder):
    saved_search.save_search(tag_index.search_blocks(index, tag, ["hot"]), f"{folder}/hot")
    saved = saved_search.saved_search(spark, f"{folder}/hot")
    want = expected(HOT)
    assert saved_search.match_count(saved) == len(want)
    for page, size in ((1, 20), (2, 20), (1000, 50), (1, 200_000), (1, 40_000), (2, 40_000), (99_999, 10)):
        got = [row[0] for row in saved_search.read_page(saved, page, size).collect()]
        assert got == want[(page - 1) * size: page * size]
    for last in (-50_000, -32_768, -1, 0, 1, 32_768, 65_535, 199_999, 259_999, 900_000):
        got = [row[0] for row in saved_search.page_after(saved, last, 30).collect()]
        assert got == [i for i in want if i > last][:30]
    page = saved_search.read_page(saved, 1000, 50)
    assert "LessThan(before,50000)" in plan_of(page)  # of the rows, only those of the page are read
    rows = saved.where("before < 50000 AND before + n > 49950").count()
    assert rows <= 2


def test_an_empty_search_has_no_pages(spark, index, tag, folder):
    saved_search.save_search(tag_index.search_blocks(index, tag, ["hot", "unknown"]), f"{folder}/none")
    saved = saved_search.saved_search(spark, f"{folder}/none")
    assert saved_search.match_count(saved) == 0
    assert saved_search.read_page(saved, 1, 10).collect() == [] and saved_search.page_after(saved, 3, 10).collect() == []


@pytest.mark.parametrize("n", [0, 1, 37, 2000, 5000])
def test_draws_follow_the_hash(spark, n):
    ids = spark.range(3, 2003).withColumnRenamed("id", "post_id")
    want = sorted(range(3, 2003), key=lambda i: (hashlib.md5(f"5:{i}".encode()).hexdigest(), i))[:n]
    assert [row[0] for row in search.random_posts(ids, n, 5).collect()] == want
    assert search.random_posts(ids.where("false"), n, 5).collect() == []


def test_a_bound_that_lets_too_few_pass_is_widened(spark, monkeypatch):
    monkeypatch.setattr(search.math, "isqrt", lambda n: -8)  # 20 - 40: fewer than asked for
    ids = spark.range(1000).withColumnRenamed("id", "post_id")
    want = sorted(range(1000), key=lambda i: hashlib.md5(f"1:{i}".encode()).hexdigest())[:60]
    assert [row[0] for row in search.random_posts(ids, 60, 1).collect()] == want


@pytest.mark.parametrize(("low", "high", "size"), [(7, 60, 20), (0, 0, 5), (13, 70_000, 1000), (5, 100_003, 40_000), (40_001, 99_999, 33_000), (1, 9, 1), (32_760, 32_780, 32_768)])
def test_coverage_of_windows(spark, low, high, size):
    have = [i for i in range(0, high + 50) if i % 11 and not 20 <= i < 45]
    ids = spark.createDataFrame([(i,) for i in have + [have[0]] * 50 + [None]], "id BIGINT")
    frame = search.id_window_coverage(ids, low, high, size)
    got = {row["window"]: (row["n_posts"], row["missing"]) for row in frame.collect()}
    want, present = {}, set(have)
    for window in range(low - low % size, high + 1, size):
        inside = range(max(window, low), min(window + size - 1, high) + 1)
        missing = [i for i in inside if i not in present]
        want[window] = (len(inside) - len(missing), missing)
    assert got == want
    assert plan_of(frame).split("Initial Plan")[0].count("Exchange hashpartitioning") <= 2
