"""Searches as jobs over saved tables, and lookups that skip row groups."""

import uuid

import pytest
from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.operators import search, stats
from postlake.plans import ingest, search_captions
from postlake.sinks.tables import save_bucketed, save_clustered
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def prefix(spark, sf_dir):
    name = f"jobs_{uuid.uuid4().hex[:8]}_"
    ingest.build_tables(spark, fx.flat_posts(spark, sf_dir), name, buckets=4)
    return name


def ids_of(frame):
    return sorted(row["id"] for row in frame.collect())


def test_pages_samples_and_caps(spark, prefix):
    every = ids_of(search_captions.matching_posts(spark, ["red", "new"], prefix=prefix))
    relation, tag = spark.table(f"{prefix}post_tag_by_tag"), spark.table(f"{prefix}tag")
    assert every == sorted(row[0] for row in search.search_intersect(relation, tag, ["red", "new"]).collect()) and len(every) > 12
    assert ids_of(search_captions.matching_posts(spark, ["red", "new"], page=2, page_size=5, prefix=prefix)) == every[5:10]
    assert ids_of(search_captions.matching_posts(spark, ["red", "new"], max_posts=7, prefix=prefix)) == every[:7]
    drawn = ids_of(search_captions.matching_posts(spark, ["red", "new"], sample=6, seed=3, prefix=prefix))
    assert len(drawn) == 6 and set(drawn) < set(every)
    assert drawn == ids_of(search_captions.matching_posts(spark, ["red", "new"], sample=6, seed=3, prefix=prefix))
    scored = ids_of(search_captions.matching_posts(spark, ["red", "new"], min_score=50, prefix=prefix))
    assert set(scored) < set(every)
    with pytest.raises(ValueError, match="not several"):
        search_captions.matching_posts(spark, ["red"], page=1, sample=2, prefix=prefix)


def test_records_of_an_id_window(spark, prefix):
    post = spark.table(f"{prefix}post")
    some = post.where("id > 700").agg(F.min("id")).first()[0]
    got = search_captions.window_posts(spark, some, 100, prefix)
    start = some - some % 100
    assert ids_of(got) == ids_of(post.where(F.col("id").between(start, start + 99)))
    assert got.where("tag_string <> ''").count() > 0


def rows_read(frame):
    frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_lookups_skip_row_groups_whose_ids_overlap(spark, table_name):
    """In tag order every row group spans nearly all post ids; a bloom filter tells which holds one."""
    relation = spark.range(400_000).select((F.col("id") * 7 % 100_003).alias("post_id"), (F.col("id") % 50).alias("tag_id"))
    before = spark.conf.get("parquet.block.size", None)
    spark.conf.set("parquet.block.size", str(64 << 10))
    try:
        save_clustered(relation, ["tag_id"], table_name, bloom=["post_id"])
        save_clustered(relation, ["tag_id"], f"{table_name}_plain")
    finally:
        spark.conf.set("parquet.block.size", before) if before else spark.conf.unset("parquet.block.size")
    wanted = 5 * 7
    with_bloom, plain = (spark.table(t).where(F.col("post_id") == wanted) for t in (table_name, f"{table_name}_plain"))
    assert sorted(map(tuple, with_bloom.collect())) == sorted(map(tuple, plain.collect())) != []
    assert rows_read(with_bloom) * 2 < rows_read(plain)


@pytest.mark.parametrize("kind", ["BIGINT", "INT", "STRING", "DOUBLE"])
def test_rows_without_a_key_are_written_by_all_tasks(spark, table_name, folder, kind):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).cast(kind.lower()).alias("key"), "id", F.create_map(F.lit("a"), "id").alias("m")
    )
    save_bucketed(rows, "key", table_name, f"{folder}/t", buckets=6)
    saved = spark.table(table_name)
    assert sorted(saved.select("id").toPandas()["id"]) == list(range(30_000))
    files = saved.where("key IS NULL").select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert kind == "DOUBLE" or len(files) == 6 and max(row["count"] for row in files) < 2500
    keyed = saved.where("key IS NOT NULL").select(F.input_file_name().alias("f")).distinct().count()
    assert keyed == 6  # a bucket is one file
    plan = plan_of(saved.groupBy("key").count())
    assert "Exchange" not in plan


def test_records_leave_out_tags_of_posts_without_an_id(spark):
    tag = spark.createDataFrame([(1, "a", "general", 3)], "tag_id BIGINT, name STRING, kind STRING, n_uses BIGINT")
    relation = spark.createDataFrame([(7, 1), (7, 1), (None, 1)], "post_id BIGINT, tag_id BIGINT")
    assert [tuple(row) for row in stats.tags_grouped_by_kind(relation, tag).collect()] == [(7, "general", "a a")]
