"""Tag statistics kept current from arriving posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.operators.stats import tag_stats_by_name
from postlake.streaming.batches import (
    prepare, read_batches, run_batches, start_from, write_batch,
)

DELTA = "kind STRING, name STRING, first_seen TIMESTAMP, post_count BIGINT"


def refresh_tag_stats(
    posts: DataFrame, out: str, checkpoint: str, kinds: dict[str, str] | None = None
) -> StreamingQuery:
    """Reduce each batch to one row per tag and store it beside the earlier ones.

    A batch that runs again replaces its own rows, so nothing is counted twice.
    """
    prepare(posts.sparkSession, out, DELTA)

    def handle(batch: DataFrame, number: int) -> None:
        write_batch(tag_stats_by_name(batch, kinds), out, number)

    return run_batches(posts, checkpoint, handle)


def current_tag_stats(spark: SparkSession, out: str) -> DataFrame:
    """(kind, name, first_seen, post_count) over all batches so far."""
    deltas = read_batches(spark, out, DELTA)
    return deltas.groupBy("kind", "name").agg(
        F.min("first_seen").alias("first_seen"), F.sum("post_count").alias("post_count")
    )


def compact_tag_stats(spark: SparkSession, out: str, new_out: str) -> None:
    """Fold all finished batches into the first batch of ``new_out``; go on with ``new_out`` and the
    same checkpoint."""
    start_from(current_tag_stats(spark, out), new_out)


# ---- snapshots ----------------------------------------------------------------------------------
# Batches write into the folder of their generation, ``fold_every`` of them each. The last batch of a
# generation folds it and the snapshot before into the next snapshot, and a pointer is then set: two
# slots take turns, so that one whole pointer stands while the other is written.


def _pointed(spark: SparkSession, out: str) -> int:
    slots = spark.read.schema("generation BIGINT, slot INT").parquet(f"{out}/_current")
    return slots.agg(F.max("generation")).first()[0]


def _point(spark: SparkSession, out: str, generation: int, mode: str = "overwrite") -> None:
    row = spark.createDataFrame([(generation,)], "generation BIGINT")
    row.write.mode(mode).parquet(f"{out}/_current/slot={generation % 2}")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kind", "name").agg(F.min("first_seen").alias("first_seen"), F.sum("post_count").alias("post_count"))


def _as_of(spark: SparkSession, out: str, generation: int) -> DataFrame:
    """The snapshot a generation began with and its own batches."""
    snapshot = spark.read.schema(DELTA).parquet(f"{out}/_snapshots/{generation}")
    return _summed(snapshot.unionByName(read_batches(spark, f"{out}/gen={generation}", DELTA).drop("batch")))


def refresh_tag_snapshots(
    posts: DataFrame, out: str, checkpoint: str, kinds: dict[str, str] | None = None, fold_every: int = 16
) -> StreamingQuery:
    """Like ``refresh_tag_stats``, folded by the stream itself every ``fold_every`` batches: however many
    batches have run, a reader opens one snapshot and fewer than ``fold_every`` + 2 folders.

    A batch that runs again replaces its own rows, its snapshot and its pointer. ``fold_every`` belongs
    to the checkpoint and stays as it was chosen.
    """
    spark = posts.sparkSession
    prepare(spark, f"{out}/gen=0", DELTA)
    spark.createDataFrame([], DELTA).write.mode("ignore").parquet(f"{out}/_snapshots/0")
    _point(spark, out, 0, "ignore")

    def handle(batch: DataFrame, number: int) -> None:
        session, generation = batch.sparkSession, number // fold_every
        write_batch(tag_stats_by_name(batch, kinds), f"{out}/gen={generation}", number)
        if (number + 1) % fold_every:
            return
        following = generation + 1
        _as_of(session, out, generation).write.mode("overwrite").parquet(f"{out}/_snapshots/{following}")
        prepare(session, f"{out}/gen={following}", DELTA)
        _point(session, out, following)

    return run_batches(posts, checkpoint, handle)


def current_tag_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """(kind, name, first_seen, post_count) over all batches so far."""
    return _as_of(spark, out, _pointed(spark, out))
