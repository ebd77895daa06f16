"""Catalog tables and their layouts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.times import month_of
from postlake.session import shuffle_partitions


def _save(writer, name: str, path: str | None) -> None:
    if path:
        writer = writer.option("path", path)
    writer.format("parquet").option("compression", "zstd").saveAsTable(name)


def with_bloom(writer, columns: list[str] | None):
    """Bloom filters on ``columns``: a lookup of one value skips row groups whose smallest and largest
    value enclose it, which is all of them where rows lie in another order. Their size follows the
    distinct values of a row group, up to 1 MB each."""
    for column in columns or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true") if columns else writer


def save_if_missing(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], path: str | None = None
) -> bool:
    """Build and save ``name`` unless it exists; says whether it was built."""
    if spark.catalog.tableExists(name):
        return False
    _save(build().write.mode("errorifexists"), name, path)
    return True


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    _save(df.write.mode("overwrite"), name, path)


# Rows of a file of a relation: they take a byte or two each, so the bytes of a split do not bound its rows;
# the bytes that opening a file counts as do.
FILE_ROWS = 250_000


def append_relation(frames: list[DataFrame], name: str, path: str | None = None) -> None:
    """All kinds of a relation in one write, appended, in files of at most ``FILE_ROWS`` rows."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    _save(merged.write.mode("append").option("maxRecordsPerFile", FILE_ROWS), name, path)


def save_by_month(post: DataFrame, name: str, path: str | None = None) -> None:
    """Posts partitioned by the month of their date; a large month is split over files."""
    dated = post.withColumn("month", F.date_format(month_of(F.col("created_at_utc")), "yyyy-MM"))
    _save(dated.hint("rebalance", "month").write.mode("overwrite").partitionBy("month"), name, path)


def save_bucketed(
    df: DataFrame, key: str, name: str, path: str | None = None, buckets: int | None = None,
    order: list[str] | None = None,
) -> None:
    """Bucketed on ``key``, so that joins and groupings on it need no exchange, and sorted by it or by
    ``order``.

    For keys that spread evenly, such as post ids. A tag may hold a third of a relation and would
    fill one bucket: ``save_clustered`` is the layout for tags. Rows without a key belong to one bucket as
    well; they are written by all tasks, each into a file of its own.
    """
    count = buckets or shuffle_partitions(df.sparkSession)
    hashed = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    row = F.xxhash64(*hashed)
    # Of the key's own type, so that rows with a key land in the task of their bucket: a bucket is one file.
    spread = {"bigint": row, "int": F.hash(*hashed), "string": row.cast("string")}.get(dict(df.dtypes)[key])
    placed = df.repartition(count, F.col(key) if spread is None else F.coalesce(F.col(key), spread))
    _save(placed.write.mode("overwrite").bucketBy(count, key).sortBy(*(order or [key])), name, path)


def save_clustered(
    df: DataFrame, keys: list[str], name: str, path: str | None = None, bloom: list[str] | None = None
) -> None:
    """Range partitioned and sorted by ``keys``, so that filters on the first key skip files and
    row groups; the later keys split a first key that is too large for one file. Lookups by a column of
    ``bloom`` skip row groups as well, whatever the order."""
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    _save(with_bloom(placed.write.mode("overwrite"), bloom), name, path)


def tag_range(tag_id: str, width: int) -> Column:
    """The range of ``width`` tag ids that holds ``tag_id``."""
    return F.floor(F.col(tag_id) / width)


def by_tag_range(post_tag: DataFrame, width: int) -> DataFrame:
    """The relation with ``tag_range``, laid out so that a range is a few files of even size: a range
    with a hot tag is split by ``rebalance``."""
    ranged = post_tag.withColumn("tag_range", tag_range("tag_id", width))
    return ranged.hint("rebalance", "tag_range").sortWithinPartitions("tag_range", "tag_id", "post_id")


def save_by_tag_range(post_tag: DataFrame, width: int, name: str, path: str | None = None) -> None:
    """The relation partitioned by ranges of ``width`` tag ids. Choose ``width`` so that there are some
    hundreds of ranges; ids are dense, so their number is known."""
    _save(by_tag_range(post_tag, width).write.mode("overwrite").partitionBy("tag_range"), name, path)
