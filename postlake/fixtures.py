"""Inputs derived from the test tables, and the tables built from them.

Derived data is written once per application under the shared folder and read back, as a pipeline
would do it; every row of the source tables is used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators import normalize, stats
from postlake.operators.tag_index import build_tag_index
from postlake.session import configure, shared_dir
from postlake.sinks.tables import by_tag_range, save_bucketed

MIN_PARTS = 8

_EXT = (
    "CASE id % 7 WHEN 0 THEN 'webm' WHEN 1 THEN 'zip' WHEN 2 THEN 'png' ELSE 'jpg' END"
)

POST_SRC_COLUMNS = f"""
  id, created_at_text AS created_at,
  (id * 37) % 250 - 50 AS score,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'g' WHEN '2' THEN 's' WHEN '3' THEN 'q'
       WHEN '4' THEN 'e' ELSE 'x' END AS rating,
  100 + id % 4000 AS image_width, 100 + id % 3000 AS image_height,
  id % 300 AS fav_count, o_orderstatus = 'P' AS is_deleted,
  ({_EXT}) AS file_ext,
  'https://cdn.example.org/original/' || id || '.' || ({_EXT}) AS file_url,
  CASE WHEN id % 5 = 0 THEN NULL
       ELSE 'https://cdn.example.org/large/' || id || '.' || ({_EXT}) END AS large_file_url,
  concat_ws(' ', tag_string_artist, tag_string_character, tag_string_copyright,
            tag_string_general, tag_string_meta) AS tag_string,
  tag_string_general, tag_string_character, tag_string_artist, tag_string_copyright,
  tag_string_meta
"""

_TAG_PARTS = (
    ("p_name", "tag_string_general"),
    ("'part_' || l_partkey", "tag_string_character"),
    ("'supp_' || l_suppkey", "tag_string_artist"),
    ("lower(replace(p_brand, '#', '_'))", "tag_string_copyright"),
    ("'flag_' || lower(l_returnflag)", "tag_string_meta"),
)


def _post_src_sql(orders: str, lineitem: str, part: str, listagg: str, date_text: str) -> str:
    tags = ", ".join(f"{listagg.format(value)} AS {name}" for value, name in _TAG_PARTS)
    return f"""
SELECT {POST_SRC_COLUMNS} FROM (
  SELECT o_orderkey AS id, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderkey % 997 = 0 THEN 'bad' ELSE {date_text} END AS created_at_text, {tags}
  FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey
                LEFT JOIN {part} ON p_partkey = l_partkey
  GROUP BY o_orderkey, o_orderdate, o_orderstatus, o_orderpriority)"""


# Line items that a task gathers into posts.
ITEM_ROWS = 200_000


def post_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat post per order; the line items of the order give its tags.

    Line items meet their parts first, with the few columns that make tags, and move to their order once:
    one list per order, in partitions that grow in number with the line items, not in size. Both joins hash
    the smaller side, so that line items and lists stream past it and are never sorted. Orders equal in all
    columns of a post are one post with the items of each.
    """
    configure(spark)
    orders, lineitem, part = (table(spark, sf_dir, name) for name in ("orders", "lineitem", "part"))
    count = max(MIN_PARTS, -(-lineitem.count() // ITEM_ROWS))
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    named = lineitem.select("l_orderkey", *order, "l_returnflag").where("l_orderkey IS NOT NULL").repartition(count, "l_partkey").join(
        part.select("p_partkey", "p_name", "p_brand").repartition(count, "p_partkey").hint("shuffle_hash"),
        F.col("p_partkey") == F.col("l_partkey"), "left",
    )
    items = (
        named.repartition(count, "l_orderkey").groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct(*order, "p_name", "p_brand", "l_returnflag"))).alias("_items"))
    )
    keys = ["o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"]
    grouped = orders.select(*keys).repartition(count, "o_orderkey").groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    joined = grouped.hint("shuffle_hash").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    times = F.flatten(F.transform("_items", lambda item: F.array_repeat(item, F.col("_n"))))
    posts = joined.withColumn("_items", F.when(F.col("_n") == 1, F.col("_items")).otherwise(times))

    def tags(value: str) -> str:
        of_item = re.sub(r"\b(l_partkey|l_suppkey|l_returnflag|p_name|p_brand)\b", r"i.\1", value)
        named = f"exists(_items, i -> ({of_item}) IS NOT NULL)"  # no name at all is NULL, not empty
        return f"CASE WHEN {named} THEN array_join(transform(_items, i -> {of_item}), ' ') END"

    date_text = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'.000-05:00'\")"
    rows = posts.selectExpr(
        "o_orderkey AS id", "o_orderstatus", "o_orderpriority",
        f"CASE WHEN o_orderkey % 997 = 0 THEN 'bad' ELSE {date_text} END AS created_at_text",
        *[f"{tags(value)} AS {name}" for value, name in _TAG_PARTS],
    )
    return spark.sql(f"SELECT {POST_SRC_COLUMNS} FROM {{rows}}", rows=rows)


POST_SRC_DUCKDB = _post_src_sql(
    "orders", "lineitem", "part",
    "string_agg({}, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey)",
    "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000-05:00')",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder for derived data of one source folder."""
    source = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/{source}/{name}"


_written: set[str] = set()


def written(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """``build()`` written once as Parquet and read back."""
    path = folder(configure(spark), sf_dir, name)
    if path not in _written:
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        _written.add(path)
    return spark.read.parquet(path)


def flat_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir, "flat", lambda: post_src(spark, sf_dir))


def parts(spark: SparkSession, sf_dir: str) -> int:
    """State partitions for data derived from the posts: one per split of the flat posts, so that
    they grow in number, not in size."""
    return max(MIN_PARTS, flat_posts(spark, sf_dir).rdd.getNumPartitions())


# Posts of a bucket; with their tags about a million rows.
BUCKET_POSTS = 50_000


def buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets of tables keyed by the post. A task sorts or groups a whole bucket, so their number
    follows the posts; splits follow bytes, and some bytes hold many rows of a relation."""
    return max(MIN_PARTS, -(-flat_posts(spark, sf_dir).count() // BUCKET_POSTS))


_saved: set[str] = set()


def bucketed(
    spark: SparkSession, sf_dir: str, name: str, key: str, build: Callable[[], DataFrame], order: list[str] | None = None
) -> DataFrame:
    """``build()`` saved once as a table bucketed on ``key``."""
    path = folder(configure(spark), sf_dir, name)
    saved = f"{name}_{path.split('/')[-2]}"
    if path not in _saved:
        save_bucketed(build(), key, saved, path, buckets(spark, sf_dir), order)
        _saved.add(path)
    return spark.table(saved)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_posts(spark, sf_dir)
    return bucketed(spark, sf_dir, "post", "id", lambda: normalize.post_table(flat))


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_posts(spark, sf_dir)
    return written(spark, sf_dir, "tag", lambda: normalize.numbered_tags(flat))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.tag_table(numbered(spark, sf_dir))


def post_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relation sorted by tag, for searches."""

    def build() -> DataFrame:
        order = ["tag_id", "post_id"]
        related = post_tags_by_post(spark, sf_dir)
        return related.repartitionByRange(*order).sortWithinPartitions(*order)

    return written(spark, sf_dir, "post_tag_by_tag", build)


def post_tags_by_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relation bucketed on the post id, for joins with posts and records of posts."""
    flat, tag = flat_posts(spark, sf_dir), numbered(spark, sf_dir)
    return bucketed(
        spark, sf_dir, "post_tag", "post_id", lambda: normalize.build_post_tag(flat, tag)
    )


# Rows of a relation that a task counts.
RELATION_ROWS = 500_000


def pair_counts(spark: SparkSession, sf_dir: str, related: DataFrame) -> DataFrame:
    """How often each (post_id, tag_id) is in a relation of all tokens. Pairs hardly repeat, so they move as
    they are, in partitions that grow in number with the tokens; counted ahead, a split would hold all its pairs."""
    tokens = numbered(spark, sf_dir).agg(F.sum("n_uses")).first()[0] or 0
    count = max(MIN_PARTS, -(-tokens // RELATION_ROWS))
    return related.repartition(count, "post_id", "tag_id").groupBy("post_id", "tag_id").agg(F.count(F.lit(1)).alias("n"))


TAG_RANGES = 64


def post_tags_by_range(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The relation partitioned by ranges of tag ids, and how many ids a range holds."""
    width = max(1, tags(spark, sf_dir).count() // TAG_RANGES)
    path = folder(configure(spark), sf_dir, "post_tag_by_range")
    if path not in _written:
        by_tag_range(post_tags_by_post(spark, sf_dir), width).write.mode("overwrite").partitionBy("tag_range").parquet(path)
        _written.add(path)
    return spark.read.parquet(path), width


def tag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts of each tag as bits, bucketed on the block of ids, for searches."""
    related, count = post_tags_by_post(spark, sf_dir), buckets(spark, sf_dir)
    return bucketed(
        spark, sf_dir, "tag_index", "block", lambda: build_tag_index(related, count), ["tag_id", "block", "word"]
    )


def tag_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(
        spark, sf_dir, "tag_stats",
        lambda: stats.tag_stats(
            tags(spark, sf_dir), post_tags_by_post(spark, sf_dir), posts(spark, sf_dir)
        ),
    )
