"""JSON lines to flat Parquet, and flat Parquet to the post, tag and post_tag tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators import normalize
from postlake.operators.dedup import dedup_by_id
from postlake.operators.paths import record_maps
from postlake.operators.records import RECORD_ORDER, schema_all_string, schema_fixed, unwrap_envelope
from postlake.operators.tag_index import save_tag_index
from postlake.schemas import POST_FIELDS
from postlake.sinks.files import write_parquet_zstd
from postlake.sinks.tables import save_bucketed, save_clustered, save_if_missing
from postlake.sources.jsonl import from_min_id, parse_strict, parse_tolerant, read_lines


def _lines(spark: SparkSession, paths: str | list[str], min_id: int | None, must_exist: bool) -> DataFrame:
    keep = None if min_id is None else (lambda name: from_min_id(name, min_id))
    return read_lines(spark, paths, keep, must_exist=must_exist)


def _parsed(lines: DataFrame, strict: bool) -> DataFrame:
    return parse_strict(lines) if strict else parse_tolerant(lines)


def _flat(lines: DataFrame, keys: list[str] | None, keep_all: bool, strict: bool) -> DataFrame:
    if keep_all:
        return record_maps(lines, [c for c in RECORD_ORDER if c != "place"], strict)
    records = unwrap_envelope(_parsed(lines, strict))
    if keys is None or set(keys) == set(POST_FIELDS):
        return schema_fixed(records)
    return schema_all_string(records, keys)


def flat_records(
    spark: SparkSession, paths: str | list[str], *, min_id: int | None = None,
    keys: list[str] | None = None, keep_all: bool = False, strict: bool = True,
    deduplicate: bool = True, must_exist: bool = True,
) -> DataFrame:
    """Flat records of all lines: the fixed schema, the listed keys as text, or every path in a map
    ``fields``. Records kept whole are de-duplicated by the path ``id``."""
    flat = _flat(_lines(spark, paths, min_id, must_exist), keys, keep_all, strict)
    if deduplicate:
        named = flat.withColumn("id", F.try_element_at("fields", F.lit("id"))) if keep_all else flat
        flat = dedup_by_id(named, RECORD_ORDER).select(*flat.columns)
    return flat.drop(*RECORD_ORDER)


def jsonl_to_parquet(
    spark: SparkSession, paths: str | list[str], out: str, *, min_id: int | None = None,
    strict: bool = True, must_exist: bool = True, **options,
) -> bool:
    """Flat records as zstd Parquet; says whether anything was written."""
    source = unwrap_envelope(_parsed(_lines(spark, paths, min_id, must_exist), strict))
    flat = flat_records(
        spark, paths, min_id=min_id, strict=strict, must_exist=False, **options
    )
    return write_parquet_zstd(flat, out, source=source)


def build_tables(
    spark: SparkSession, flat: DataFrame, prefix: str = "", path: str | None = None,
    kinds: dict[str, str] | None = None, buckets: int | None = None,
) -> None:
    """Save ``post``, ``tag`` and ``post_tag``, each only if missing.

    ``buckets`` should grow with the input: a bucket is one task's work in later joins. By default
    there are as many as shuffle partitions.

    Posts are bucketed on their id. The relation is kept twice: ``post_tag`` bucketed on the post
    id for joins with posts, ``post_tag_by_tag`` sorted by tag; ``tag_index`` holds its bitmaps for
    searches.
    """

    def at(name: str) -> str | None:
        return f"{path}/{name}" if path else None

    exists = spark.catalog.tableExists
    if not exists(f"{prefix}post"):
        save_bucketed(normalize.post_table(flat), "id", f"{prefix}post", at("post"), buckets)
    usage = f"{prefix}tag_usage"
    save_if_missing(spark, usage, lambda: normalize.numbered_tags(flat, kinds), at("tag_usage"))
    numbered = spark.table(usage)
    save_if_missing(
        spark, f"{prefix}tag", lambda: normalize.tag_table(numbered), at("tag")
    )
    if not exists(f"{prefix}post_tag"):
        related = normalize.build_post_tag(flat, numbered, kinds)
        save_bucketed(related, "post_id", f"{prefix}post_tag", at("post_tag"), buckets)
    if not exists(f"{prefix}post_tag_by_tag"):
        save_clustered(
            spark.table(f"{prefix}post_tag"), ["tag_id", "post_id"],
            f"{prefix}post_tag_by_tag", at("post_tag_by_tag"), bloom=["post_id"],
        )
    if not exists(f"{prefix}tag_index"):
        save_tag_index(spark.table(f"{prefix}post_tag"), f"{prefix}tag_index", at("tag_index"), buckets)
