"""Output folders of ``foreachBatch`` jobs: one per batch, replaced when the batch runs again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def prepare(spark: SparkSession, out: str, schema: str) -> None:
    """An empty first batch, so that the output can be read before any batch has run. An output
    that has one keeps it."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{out}/batch=-1")


def write_batch(df: DataFrame, out: str, batch: int) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={batch}")


def read_batches(spark: SparkSession, out: str, schema: str, before: int | None = None) -> DataFrame:
    rows = spark.read.schema(f"{schema}, batch BIGINT").parquet(out)
    return rows if before is None else rows.where(rows["batch"] < before)


def start_from(df: DataFrame, out: str) -> None:
    """Make ``df`` the first batch of a new output, to go on from a compacted state."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{out}/batch=-1")


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Start streams with ``count`` state partitions. A checkpoint keeps the number of its first
    start for good, so it is chosen for the data to come, not left to the session."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(count or before))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def run_batches(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None],
    partitions: int | None = None,
) -> StreamingQuery:
    with state_partitions(stream.sparkSession, partitions):
        return (
            stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
