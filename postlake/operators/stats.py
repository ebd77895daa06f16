"""Per-tag statistics and ranked lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions.times import parse_created_at
from postlake.operators.gather import joined_names, named_entries
from postlake.operators.normalize import tag_tokens
from postlake.operators.numbering import dense_positions
from postlake.operators.skew import join_even


def tag_post_join(tag: DataFrame, post_tag: DataFrame, post: DataFrame) -> DataFrame:
    """tag x post_tag x post. Tables bucketed on the post id join without an exchange. ``tag`` may carry
    ``n_uses``, which saves a pass over the facts when the tags are too many to broadcast; it is not
    returned."""
    related = post_tag.join(post, post_tag["post_id"] == post["id"])
    weight = "n_uses" if "n_uses" in tag.columns else None
    return join_even(related, tag, ["tag_id"], F.xxhash64("post_id"), weight)


def tag_stats(tag: DataFrame, post_tag: DataFrame, post: DataFrame) -> DataFrame:
    """first_seen and post_count of every tag, repeats counted.

    The relation is reduced to one row per tag before the names are joined, with a partial
    aggregate ahead of the shuffle, so a hot tag costs one row per task.
    """
    dated = post.select(F.col("id").alias("post_id"), "created_at_utc")
    per_tag = (
        post_tag.join(dated, "post_id")
        .groupBy("tag_id")
        .agg(F.min("created_at_utc").alias("first_seen"), F.count(F.lit(1)).alias("post_count"))
    )
    named = tag.select("tag_id", "kind", F.col("name").alias("tag_name"))
    return per_tag.join(named, "tag_id").select(
        "kind", "tag_id", "tag_name", "first_seen", "post_count"
    )


def tag_stats_by_name(flat: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """(kind, name, first_seen, post_count) from flat posts with unique ids: one scan, one shuffle.

    Equal to ``tag_stats`` over the tables built from the same posts, without the three-way join.
    """
    dated = flat.where(F.col("id").isNotNull()).withColumn(
        "created_at_utc", parse_created_at(F.col("created_at"))
    )
    return (
        tag_tokens(dated, ["created_at_utc"], kinds)
        .groupBy("kind", "name")
        .agg(F.min("created_at_utc").alias("first_seen"), F.count(F.lit(1)).alias("post_count"))
    )


def tag_stats_from_posts(
    flat: DataFrame, tag: DataFrame, kinds: dict[str, str] | None = None
) -> DataFrame:
    stats = tag_stats_by_name(flat, kinds)
    return stats.join(tag, ["kind", "name"]).select(
        "kind", "tag_id", F.col("name").alias("tag_name"), "first_seen", "post_count"
    )


def filter_kind(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("kind") == kind)


def filter_stats(stats: DataFrame, start: dt.datetime, min_count: int) -> DataFrame:
    """Tags first seen at or after ``start`` with more than ``min_count`` uses."""
    since = F.lit(start.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    return stats.where((F.col("first_seen") >= since) & (F.col("post_count") > min_count))


def rank_new_tags(stats: DataFrame, start: dt.datetime, min_count: int) -> DataFrame:
    """All kinds in one pass, each in rank order: most uses first, ties by name."""
    return filter_stats(stats, start, min_count).orderBy("kind", F.desc("post_count"), "tag_name")


def top_new_tags(stats: DataFrame, start: dt.datetime, min_count: int, n: int = 20) -> DataFrame:
    """The first ``n`` of each kind in rank order. Each task keeps ``n`` per kind ahead of the
    shuffle, so that a kind gathers no more than that from every task."""
    in_kind = Window.partitionBy("kind").orderBy(F.desc("post_count"), "tag_name")
    ranked = filter_stats(stats, start, min_count).withColumn("_rank", F.row_number().over(in_kind))
    return ranked.where(F.col("_rank") <= n).drop("_rank").orderBy("kind", F.desc("post_count"), "tag_name")


def collect_names(ranked: DataFrame) -> DataFrame:
    """(kind, position, tag_name): per kind the names in rank order, position from 0.

    The list stays rows: gathered into one array, all names of a kind would have to pass through
    one task.
    """
    order = ["kind", F.desc("post_count"), "tag_name"]
    placed = dense_positions(ranked.select("kind", "tag_name", "post_count"), order, "_at")
    first = placed.groupBy("kind").agg(F.min("_at").alias("_first"))
    return placed.join(F.broadcast(first), "kind").select(  # one row per kind
        "kind", (F.col("_at") - F.col("_first")).alias("position"), "tag_name"
    )


def tags_grouped_by_kind(
    post_tag: DataFrame, tag: DataFrame, post_ids: list[int] | None = None
) -> DataFrame:
    """(post_id, kind, tags) of all or some posts: names in order, joined by a space."""
    if post_ids is not None:
        post_tag = post_tag.where(F.col("post_id").isin(list(post_ids)))
    return named_entries(post_tag, tag).groupBy("post_id", "kind").agg(joined_names().alias("tags"))


def kinds_ordered(grouped: DataFrame) -> DataFrame:
    return grouped.orderBy("post_id", "kind")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows, n_columns) of each table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    merged = counted[0]
    for frame in counted[1:]:
        merged = merged.unionByName(frame)
    return merged
