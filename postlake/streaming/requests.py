"""Search requests that arrive as text, each answered once from the post tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.functions.text import normalize_query, sanitize_folder
from postlake.operators.skew import join_even
from postlake.session import cut_lineage
from postlake.sinks.tables import tag_range
from postlake.streaming.batches import prepare, read_batches, run_batches, write_batch

ANSWER = "request STRING, folder STRING, post_id BIGINT"


def arriving_requests(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """(request): normalised requests, each distinct one once. One request is one tag."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    request = normalize_query(F.col("value")).alias("request")
    return reader.load(folder).select(request).where("request <> ''").dropDuplicates(["request"])


def answer(requests: DataFrame, tag: DataFrame, post_tag: DataFrame, width: int | None = None) -> DataFrame:
    """(request, folder, post_id): the distinct posts that carry the requested tag.

    The requests become tag ids first. A relation saved by ranges of ``width`` tag ids (``tag_range``,
    see ``save_by_tag_range``) is read in the ranges that hold a requested tag and no others: the
    broadcast of the wanted ids prunes its partitions, whatever their number. A relation sorted by tag is
    held to the range of the wanted ids.
    """
    wanted = cut_lineage(requests.join(tag, requests["request"] == tag["name"]).select("request", "tag_id"))
    low, high = wanted.agg(F.min("tag_id"), F.max("tag_id")).first()
    on = ["tag_id"]
    if width:
        on = ["tag_range", "tag_id"]
        # The comparison is what lets the planner take the ids for selective.
        wanted = wanted.withColumn("tag_range", tag_range("tag_id", width)).where(F.col("tag_range") >= F.lit((low or 0) // width))
    else:
        post_tag = post_tag.where(F.col("tag_id").between(low, high))
    found = join_even(post_tag, wanted, on, F.xxhash64("post_id"))
    hits = found.select("request", "post_id").distinct()
    return hits.select("request", sanitize_folder(F.col("request")).alias("folder"), "post_id")


def answer_requests(
    requests: DataFrame, tag: DataFrame, post_tag: DataFrame, out: str, checkpoint: str,
    partitions: int | None = None, width: int | None = None,
) -> StreamingQuery:
    prepare(requests.sparkSession, out, ANSWER)

    def handle(batch: DataFrame, number: int) -> None:
        write_batch(answer(batch, tag, post_tag, width), out, number)

    return run_batches(requests, checkpoint, handle, partitions)


def answers(spark: SparkSession, out: str) -> DataFrame:
    return read_batches(spark, out, ANSWER).drop("batch")
