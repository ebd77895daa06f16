"""Matches of a search kept as bitmaps by block, in id order with the number of matches before each
block: any page reads its own blocks and nothing is sorted or numbered again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.operators.tag_index import block_ids
from postlake.session import cut_lineage

SAVED = "block BIGINT, ids BINARY, n BIGINT, before BIGINT"


def save_search(blocks: DataFrame, path: str) -> None:
    """Write (block, ids, n, before) of the matches ``blocks``, sorted by block.

    One row per 32,768 ids is range partitioned; ``before`` is the place in its partition plus the sums
    of the partitions before, of which one number each reaches the driver.
    """
    spark = blocks.sparkSession
    placed = blocks.select("block", "ids", "n").repartitionByRange("block").withColumn("_part", F.spark_partition_id())
    placed = cut_lineage(placed)
    total, offsets = 0, []
    for row in placed.groupBy("_part").agg(F.sum("n").alias("n")).orderBy("_part").toLocalIterator():
        offsets.append((row["_part"], total))
        total += row["n"]
    offset_rows = spark.createDataFrame(offsets, "_part INT, _offset BIGINT")
    earlier = Window.partitionBy("_part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("_in_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    numbered = numbered.join(F.broadcast(offset_rows), "_part")  # one row per partition
    rows = numbered.select("block", "ids", "n", (F.col("_offset") + F.col("_in_part")).alias("before"))
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def saved_search(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SAVED).parquet(path)


def rows_between(saved: DataFrame, start: int, end: int) -> DataFrame:
    """(post_id): matches ``start`` to ``end`` in id order. Only blocks that hold some of them are read."""
    here = saved.where((F.col("before") < end) & (F.col("before") + F.col("n") > start))
    ids = here.select("before", F.posexplode(block_ids(F.col("block"), F.col("ids"))).alias("_at", "post_id"))
    return ids.where((F.col("before") + F.col("_at")).between(start, end - 1)).select("post_id").orderBy("post_id")


def read_page(saved: DataFrame, page: int, size: int) -> DataFrame:
    """Page ``page`` (from 1) of a saved search."""
    return rows_between(saved, (page - 1) * size, page * size)


def page_after(saved: DataFrame, last_id: int, size: int) -> DataFrame:
    """The ``size`` matches after ``last_id``, wherever that was read from: a cursor that stays right
    when the sizes of pages change, and needs ``last_id`` itself to be no match."""
    block = saved.sparkSession.range(1).select(F.bitmap_bucket_number(F.lit(last_id))).first()[0]
    ids = block_ids(F.col("block"), F.col("ids"))
    seen = saved.where(F.col("block") == block).select(F.col("before") + F.size(F.filter(ids, lambda i: i <= last_id))).first()
    if seen is None:  # no match in its block: the first one after it
        seen = saved.where(F.col("block") > block).agg(F.min("before")).first()
    if seen[0] is None:
        return rows_between(saved, 0, 0)
    return rows_between(saved, seen[0], seen[0] + size)


def match_count(saved: DataFrame) -> int:
    return saved.agg(F.sum("n")).first()[0] or 0
