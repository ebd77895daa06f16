"""Dense row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.schemas import LOOKUP_BATCH
from postlake.session import cut_lineage

_ROW_BITS = (1 << 33) - 1


def dense_positions(df: DataFrame, order: list, name: str, start: int = 0) -> DataFrame:
    """Add ``name``: 0-based position of the row in the order of ``order``.

    Rows are range partitioned and sorted; a row's position is its place in its partition plus the
    rows of the partitions before. The sorted rows are written down between the two passes: a
    second range sample could move rows. Only one count per partition reaches the driver.
    """
    spark = df.sparkSession
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    placed = cut_lineage(placed)
    before, offsets = start, []
    for row in placed.groupBy("_part").count().orderBy("_part").toLocalIterator():
        offsets.append((row["_part"], before))
        before += row["count"]
    offset_rows = spark.createDataFrame(offsets, "_part INT, _before BIGINT")
    return (
        placed.join(F.broadcast(offset_rows), "_part")  # one row per partition
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_part", "_place", "_before")
    )


def assign_tag_ids(tags: DataFrame, start: int = 0) -> DataFrame:
    """Dense ``tag_id`` over unique (kind, name) rows, in that order."""
    return dense_positions(tags, ["kind", "name"], "tag_id", start)


def extend_tag_ids(known: DataFrame, tags: DataFrame) -> DataFrame:
    """Keep the ids of ``known`` tags and number the tags new to it after the highest id."""
    new = tags.join(known.select("kind", "name"), ["kind", "name"], "left_anti")
    highest = known.agg(F.max("tag_id")).first()[0]
    start = 0 if highest is None else highest + 1
    numbered = assign_tag_ids(new, start)
    return known.unionByName(numbered.select(*known.columns))


def batch_lookups(names: DataFrame, size: int = LOOKUP_BATCH, start: int = 0) -> DataFrame:
    """(batch, names, n): distinct ``name`` rows in order, ``size`` to a batch, space-joined."""
    placed = dense_positions(names.select("name"), ["name"], "position", start)
    return (
        placed.withColumn("batch", F.floor(F.col("position") / size))
        .groupBy("batch")
        .agg(
            F.array_join(F.sort_array(F.collect_list("name")), " ").alias("names"),
            F.count(F.lit(1)).alias("n"),
        )
    )
