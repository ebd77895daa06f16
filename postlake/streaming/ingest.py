"""Posts that arrive as JSON line files, kept once per id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.operators.records import schema_fixed, unwrap_envelope
from postlake.operators.search import filter_id_range
from postlake.schemas import POST_FIELDS, ddl
from postlake.sources.jsonl import parse_tolerant
from postlake.streaming.batches import state_partitions


def arriving_lines(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, pattern: str = "*.jsonl"
) -> DataFrame:
    reader = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).withColumnRenamed("value", "line")


def arriving_posts(
    spark: SparkSession, folder: str, low: int | None = None, high: int | None = None,
    files_per_batch: int | None = None, pattern: str = "*.jsonl",
) -> DataFrame:
    """Flat posts of the arriving lines, clipped to the id range; broken lines are left out."""
    parsed = parse_tolerant(arriving_lines(spark, folder, files_per_batch, pattern))
    posts = schema_fixed(unwrap_envelope(parsed)).drop("place")
    return filter_id_range(posts, low, high)


def arriving_parquet(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ddl(POST_FIELDS))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _append(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def ingest_dedup(
    posts: DataFrame, out: str, checkpoint: str, partitions: int | None = None
) -> StreamingQuery:
    """Append each id the first time it arrives. The state holds every id seen."""
    once = posts.where("id IS NOT NULL").dropDuplicates(["id"])
    with state_partitions(posts.sparkSession, partitions):
        return _append(once, out, checkpoint)


def ingest_without_id(posts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the posts without an id, all of which are kept."""
    return _append(posts.where("id IS NULL"), out, checkpoint)


def ingest_dedup_bounded(
    posts: DataFrame, out: str, checkpoint: str, delay: str, partitions: int | None = None,
    event_time: str | None = None,
) -> StreamingQuery:
    """Like ``ingest_dedup`` with ids forgotten ``delay`` after they arrived: an id that comes back
    later is appended again.

    ``event_time`` names a timestamp of the rows, such as when a post was fetched; rows more than
    ``delay`` older than the newest seen are left out, as their ids may be forgotten already, and NULL
    is the time of the batch. Without it the time of the batch counts, so that no post is ever late.
    """
    when = F.current_timestamp()
    when = F.coalesce(F.col(event_time), when) if event_time else when
    arrived = posts.where("id IS NOT NULL").withColumn("_arrived", when)
    once = arrived.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["id"])
    with state_partitions(posts.sparkSession, partitions):
        return _append(once.drop("_arrived"), out, checkpoint)
