"""Line files: recursive scans, file pruning by name, and parsing of JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.text import strip

# Columns that order lines as they lie in their files; unique per line.
LINE_ORDER = ["file", "block", "row"]


def _number(text: Column) -> Column:
    return F.when(text.rlike(r"^\d+$"), text.try_cast("bigint"))


def _stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"\.[^.]*$", "")


def _before_dot(file_name: Column) -> Column:
    return F.substring_index(file_name, ".", 1)


def from_min_id(file_name: Column, min_id: int) -> Column:
    """Keep a file whose leading number is at least ``min_id`` or which has none."""
    first = _number(F.substring_index(_stem(file_name), "_", 1))
    return F.coalesce(first >= min_id, F.lit(True))


def from_id_range(file_name: Column, from_id: int) -> Column:
    """Keep ``A_B`` and ``posts_A_B`` with A <= B and B >= ``from_id``, and any other shape."""
    shape = r"^(?:posts_(?=\d+_\d+$))?(\d+)_(\d+)$"
    name = _before_dot(file_name)
    low = _number(F.regexp_extract(name, shape, 1))
    high = _number(F.regexp_extract(name, shape, 2))
    return F.coalesce((low <= high) & (high >= from_id), F.lit(True))


def from_id_range_strict(file_name: Column, from_id: int) -> Column:
    """Like ``from_id_range`` for names with an underscore; another shape fails the job."""
    shape = r"^(\d+)_(\d+)$"
    name = _before_dot(file_name)
    low = F.regexp_extract(name, shape, 1).try_cast("bigint")
    high = F.regexp_extract(name, shape, 2).try_cast("bigint")
    broken = F.raise_error(F.concat(F.lit("file name is not A_B: "), file_name)).cast("boolean")
    return F.when(~file_name.contains("_"), F.lit(False)).when(
        low.isNull() | high.isNull(), broken
    ).otherwise((low <= high) & (high >= from_id))


def read_lines(
    spark: SparkSession, paths: str | list[str], keep=None, pattern: str | None = "*.jsonl",
    must_exist: bool = False,
) -> DataFrame:
    """(file, modified, file_name, block, row, line) of all files below ``paths``.

    ``keep`` maps the file name column to a condition. It touches only file metadata, so files
    that fail it are never opened. ``file``, ``block`` and ``row`` order the lines as they lie in
    their files without a shuffle: a split is read by one task from its start to its end. Files whose
    names end in ``.gz`` are read as what they hold, and ``file_name`` is the name without that ending.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(paths)
    if must_exist and lines.isEmpty() and not lines.inputFiles():
        raise FileNotFoundError(f"no {pattern or ''} files below {paths}")
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.gz$", "")
    if keep is not None:
        lines = lines.where(keep(name))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        name.alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )


def parse_strict(lines: DataFrame) -> DataFrame:
    """Add ``doc``; a line that is no JSON fails the job."""
    return lines.withColumn("doc", F.parse_json("line"))


def parse_tolerant(lines: DataFrame) -> DataFrame:
    """Add ``doc``, NULL for a line that holds no JSON object."""
    doc = F.when(F.col("line").rlike(r"^\s*\{"), F.try_parse_json("line"))
    return lines.withColumn("doc", doc)


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where("doc IS NOT NULL")


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where("doc IS NULL").drop("doc")


def load_key_list(spark: SparkSession, path: str, keep_blank: bool = False) -> DataFrame:
    """(key): the stripped lines of a text file."""
    keys = spark.read.text(path).select(strip(F.col("value")).alias("key"))
    return keys if keep_blank else keys.where("key <> ''")


def keep_list(spark: SparkSession, path: str) -> list[str]:
    """Column names to keep. They become columns of a DataFrame, so they belong on the driver."""
    names = sorted({row["key"] for row in load_key_list(spark, path).toLocalIterator()})
    if not names:
        raise ValueError(f"no keys in {path}")
    return names
