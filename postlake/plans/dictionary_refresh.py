"""Compact the dictionary and gather the tags it lacks into batches to look up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlake.operators.tagging import missing_batches
from postlake.schemas import LOOKUP_BATCH
from postlake.sinks.files import compact_dictionary
from postlake.sources.dictionary import load_tag_dictionary


def refresh(
    spark: SparkSession, dictionary: str, compacted: str, posts: DataFrame,
    size: int = LOOKUP_BATCH, tags: str = "tags",
) -> DataFrame:
    compact_dictionary(spark, dictionary, compacted)
    return missing_batches(posts, load_tag_dictionary(spark, compacted), size, tags)
