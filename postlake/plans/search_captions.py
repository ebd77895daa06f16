"""Search by tags, build the records of the matches and write captions and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators import search, tag_index
from postlake.schemas import LOCAL_WINDOW
from postlake.session import cut_lineage
from postlake.sinks.files import write_captions, write_jsonl


def matching_posts(
    spark: SparkSession, names: list[str], *, min_score: int | None = None,
    max_posts: int | None = None, page: int | None = None, page_size: int = 20,
    sample: int | None = None, seed: int = 0, prefix: str = "",
) -> DataFrame:
    """Records of the posts that carry all of ``names``: all of them, the first ``max_posts`` in id
    order, a page (from 1) in id order, or ``sample`` of them drawn at random by ``seed``."""
    if sum(option is not None for option in (max_posts, page, sample)) > 1:
        raise ValueError("a search is capped, paged or sampled, not several of them")
    tag, index = _tags(spark, prefix), spark.table(f"{prefix}tag_index")
    if min_score is None:
        ids = tag_index.search_index(index, tag, names)
    else:
        ids = tag_index.search_index_min_score(index, tag, spark.table(f"{prefix}post"), names, min_score)
    if page is not None:
        ids = search.search_page(ids, page, page_size)
    elif max_posts is not None:
        ids = search.search_all_capped(ids, max_posts)
    elif sample is not None:
        ids = search.random_posts(ids, sample, seed)
    return _records(spark, ids, prefix)


def window_posts(spark: SparkSession, post_id: int, size: int = LOCAL_WINDOW, prefix: str = "") -> DataFrame:
    """Records of the aligned window of ``size`` ids that holds ``post_id``."""
    post = search.filter_id_window(spark.table(f"{prefix}post"), post_id, size)
    return _records(spark, post.select(F.col("id").alias("post_id")), prefix)


def _tags(spark: SparkSession, prefix: str) -> DataFrame:
    """The tags, with their uses where those were kept."""
    counted = f"{prefix}tag_usage"
    return spark.table(counted if spark.catalog.tableExists(counted) else f"{prefix}tag")


def _records(spark: SparkSession, ids: DataFrame, prefix: str) -> DataFrame:
    ids = cut_lineage(ids)  # joined twice
    related = spark.table(f"{prefix}post_tag").join(ids, "post_id", "left_semi")
    chosen = spark.table(f"{prefix}post").join(ids.withColumnRenamed("post_id", "id"), "id", "left_semi")
    return search.build_post_dict(related, _tags(spark, prefix), chosen)


def save_matches(posts: DataFrame, captions: str, metadata: str) -> None:
    write_captions(posts, captions)
    write_jsonl(search.trim_post(posts), metadata)
