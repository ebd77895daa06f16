"""Unknown tags gathered from arriving posts into batches to look up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.functions.text import contains_any
from postlake.operators.numbering import dense_positions
from postlake.operators.tagging import distinct_tagset, missing_tags
from postlake.schemas import DICTIONARY_BATCH
from postlake.session import cut_lineage
from postlake.streaming.batches import prepare, read_batches, run_batches, write_batch

QUEUE = "name STRING, position BIGINT"
_ENDS = "_ends"  # a folder that readers of the queue pass over


def _end_of(spark: SparkSession, out: str, batch: int) -> int:
    """How many tags were queued once ``batch`` had run: one row that the batch left."""
    return spark.read.schema("n BIGINT").parquet(f"{out}/{_ENDS}/{batch}").first()[0]


def _set_end(spark: SparkSession, out: str, batch: int, n: int) -> None:
    spark.createDataFrame([(n,)], "n BIGINT").write.mode("overwrite").parquet(f"{out}/{_ENDS}/{batch}")


def queue_missing_tags(
    posts: DataFrame, words: list[str], dictionary: DataFrame, out: str, checkpoint: str,
    tags: str = "tags", partitions: int | None = None,
) -> StreamingQuery:
    """Queue every unknown tag once, numbered on from the tags queued before.

    The tags met so far are state of the stream, so a tag is looked up in the dictionary once and a
    batch reads neither the queue nor the tags of earlier batches: only the number at which the batch
    before ended. A batch that runs again finds the state as it was and replaces its own files.
    """
    spark = posts.sparkSession
    prepare(spark, out, QUEUE)
    dictionary = cut_lineage(dictionary)  # read from its lines once, not in every batch
    met = distinct_tagset(posts.where(contains_any(F.col(tags), words)), tags)

    def handle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        start = _end_of(session, out, number - 1) if number else 0
        new = missing_tags(batch, dictionary).withColumnRenamed("token", "name")
        placed = dense_positions(new, ["name"], "position", start)
        write_batch(placed.select("name", "position"), out, number)
        written = session.read.schema(QUEUE).parquet(f"{out}/batch={number}").count()
        _set_end(session, out, number, start + written)

    return run_batches(met, checkpoint, handle, partitions)


def lookup_batches(
    spark: SparkSession, out: str, size: int = DICTIONARY_BATCH, finished: bool = False
) -> DataFrame:
    """(lookup, names, n): the full batches, and once ``finished`` the last partial one too."""
    queued = read_batches(spark, out, QUEUE)
    grouped = (
        queued.withColumn("lookup", F.floor(F.col("position") / size))
        .groupBy("lookup")
        .agg(
            F.sort_array(F.collect_list(F.struct("position", "name"))).alias("_names"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    names = F.array_join(F.col("_names.name"), " ").alias("names")
    rows = grouped.select("lookup", names, "n")
    return rows if finished else rows.where(F.col("n") == size)
