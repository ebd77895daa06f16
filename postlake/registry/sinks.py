"""Sinks: write, then read back what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.operators import normalize, search, stats
from postlake.registry import inputs
from postlake.registry.base import CLOCK, clock, fresh_folder, query, same_result
from postlake.registry.tables import MIN_COUNT, START
from postlake.schemas import DICTIONARY_FIELDS, TAG_COLUMNS, ddl
from postlake.sinks import files, tables
from postlake.sources.dictionary import load_tag_dictionary


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


@query("write_parquet_zstd", "SELECT id, score, rating, tag_string FROM post_src", "post_src")
def write_parquet_zstd(spark, sf_dir):
    path = fresh_folder(spark, sf_dir, "parquet")
    files.write_parquet_zstd(fx.flat_posts(spark, sf_dir), path)
    return spark.read.parquet(path).select("id", "score", "rating", "tag_string")


@query("write_jsonl", "SELECT id, score, rating, coalesce(large_file_url, '') AS large FROM post_src", "post_src")
def write_jsonl(spark, sf_dir):
    path = fresh_folder(spark, sf_dir, "jsonl")
    posts = fx.flat_posts(spark, sf_dir).select("id", "score", "rating", "large_file_url")
    files.write_jsonl(posts, path)
    read = spark.read.schema("id BIGINT, score BIGINT, rating STRING, large_file_url STRING").json(path)
    return read.select("id", "score", "rating", F.coalesce("large_file_url", F.lit("")).alias("large"))


@query(
    "save_if_missing",
    f"SELECT id, score, rating, {CLOCK.format('created_at_utc')} AS created_at_utc FROM post",
    "post",
)
def save_if_missing(spark, sf_dir):
    name, path = _name("post"), fresh_folder(spark, sf_dir, "saved")
    built = tables.save_if_missing(spark, name, lambda: fx.posts(spark, sf_dir), path)
    again = tables.save_if_missing(spark, name, lambda: fx.posts(spark, sf_dir).limit(0), path)
    assert built and not again
    return spark.table(name).select("id", "score", "rating", clock("created_at_utc").alias("created_at_utc"))


@query(
    "replace_stats_table",
    f"SELECT kind, tag_id, tag_name, {CLOCK.format('first_seen')} AS first_seen, post_count FROM stats "
    "WHERE kind IN ('general', 'character', 'artist')",
    "stats",
)
def replace_stats_table(spark, sf_dir):
    saved = []
    for kind in ("general", "character", "artist"):
        name, path = _name(f"tag_{kind}_stats"), fresh_folder(spark, sf_dir, f"{kind}_stats")
        of_kind = stats.filter_kind(fx.tag_stats(spark, sf_dir), kind).drop("kind")
        tables.replace_table(of_kind, name, path)
        tables.replace_table(of_kind, name, path)
        saved.append(spark.table(name).select(F.lit(kind).alias("kind"), "*"))
    return saved[0].unionByName(saved[1]).unionByName(saved[2]).withColumn("first_seen", clock("first_seen"))


@query("append_relation", "SELECT post_id, tag_id, count(*) AS n FROM post_tag GROUP BY ALL", "post_tag")
def append_relation(spark, sf_dir):
    name, path = _name("post_tag"), fresh_folder(spark, sf_dir, "relation")
    flat, numbered = fx.flat_posts(spark, sf_dir), fx.numbered(spark, sf_dir)
    relations = [
        normalize.build_post_tag(flat, numbered, {kind: column})
        for kind, column in TAG_COLUMNS.items()
    ]
    tables.append_relation(relations[:2], name, path)
    tables.append_relation(relations[2:], name, path)
    return fx.pair_counts(spark, sf_dir, spark.table(name))


@same_result("layout_by_key", "tag_stats")
def layout_by_key(spark, sf_dir):
    """Statistics over tables bucketed on the post id, which join without an exchange."""
    root = fresh_folder(spark, sf_dir, "layout")
    post, related = _name("post"), _name("post_tag")
    buckets = fx.buckets(spark, sf_dir)
    tables.save_bucketed(fx.posts(spark, sf_dir), "id", post, f"{root}/post", buckets)
    tables.save_bucketed(
        fx.post_tags(spark, sf_dir), "post_id", related, f"{root}/post_tag", buckets
    )
    rows = stats.tag_stats(fx.tags(spark, sf_dir), spark.table(related), spark.table(post))
    return rows.withColumn("first_seen", clock("first_seen"))


@query(
    "layout_by_month",
    "SELECT strftime(created_at_utc, '%Y-%m') AS month, id, score FROM post WHERE created_at_utc >= TIMESTAMP '1996-01-01'",
    "post",
)
def layout_by_month(spark, sf_dir):
    name = _name("post_by_month")
    tables.save_by_month(fx.posts(spark, sf_dir), name, fresh_folder(spark, sf_dir, "months"))
    return spark.table(name).where("month >= '1996-01'").select("month", "id", "score")


@same_result("layout_by_tag", "search_intersect")
def layout_by_tag(spark, sf_dir):
    name = _name("post_tag_by_tag")
    tables.save_clustered(
        fx.post_tags(spark, sf_dir), ["tag_id", "post_id"], name, fresh_folder(spark, sf_dir, "by_tag")
    )
    return search.search_intersect(
        spark.table(name), fx.tags(spark, sf_dir), ["red", "plate", "new"]
    )


_TITLES = "CASE kind WHEN 'character' THEN 0 WHEN 'general' THEN 1 ELSE 2 END"


@query(
    "export_tag_lists",
    f"""SELECT {_TITLES} AS section, place AS position,
  CASE WHEN place = 0 THEN '' ELSE ',' END || '"' || tag_name || '"' AS line
FROM (SELECT kind, tag_name, CAST(row_number() OVER (PARTITION BY kind ORDER BY post_count DESC, tag_name) - 1 AS BIGINT) AS place
  FROM stats WHERE first_seen >= TIMESTAMP '1995-01-01 00:00:00' AND post_count > {MIN_COUNT}
  AND kind IN ('character', 'general', 'artist'))
UNION ALL SELECT * FROM (VALUES (0, -1, '{{"characters":['), (0, 4611686018427387904, '],'),
  (1, -1, '"general":['), (1, 4611686018427387904, '],'),
  (2, -1, '"artist":['), (2, 4611686018427387904, ']}}')) v""",
    "stats",
)
def export_tag_lists(spark, sf_dir):
    ranked = stats.filter_stats(fx.tag_stats(spark, sf_dir), START, MIN_COUNT)
    return files.tag_list_lines(ranked)


@query(
    "write_sharded_metadata",
    """SELECT coalesce(id, -1) AS id, coalesce(id % 100, -1) AS shard, score, rating FROM (
  SELECT CASE WHEN id % 50 = 3 THEN NULL ELSE id END AS id, score, rating FROM post_src)""",
    "post_src",
)
def write_sharded_metadata(spark, sf_dir):
    """Written in two runs and once more; records without an id are not written again either."""
    path = fresh_folder(spark, sf_dir, "metadata")
    records = fx.flat_posts(spark, sf_dir).select(
        F.when(F.col("id") % 50 != 3, F.col("id")).alias("id"), "score", "rating"
    )
    files.write_sharded_metadata(records.where("score >= 0"), path)
    for _ in range(2):
        files.write_sharded_metadata(records, path, existing=spark.read.parquet(path))
    return spark.read.parquet(path).select(
        F.coalesce("id", F.lit(-1)).alias("id"), F.coalesce(F.col("shard").cast("bigint"), F.lit(-1)).alias("shard"), "score", "rating"
    )


def write_captions(spark, sf_dir):
    path = fresh_folder(spark, sf_dir, "captions")
    dated = fx.flat_posts(spark, sf_dir).withColumn("year", F.year(F.try_to_timestamp("created_at")))
    files.write_captions(dated, path)
    return spark.read.parquet(path).select("id", "caption")


same_result("write_captions", "caption")(write_captions)


@query("compact_dictionary", "SELECT id, name, count, type, ambiguous FROM dict_names", "dict_names")
def compact_dictionary(spark, sf_dir):
    path = fresh_folder(spark, sf_dir, "compacted")
    files.compact_dictionary(spark, inputs.dictionary_folder(spark, sf_dir), path)
    return spark.read.schema(ddl(DICTIONARY_FIELDS)).json(path)


@query(
    "append_dictionary",
    "SELECT id, name AS key, count, type FROM dict_names WHERE name NOT IN (SELECT name FROM tag) "
    "UNION ALL SELECT tag_id, name, 1, 0 FROM tag",
    ("dict_names", "tag"),
)
def append_dictionary(spark, sf_dir):
    path = fresh_folder(spark, sf_dir, "appended")
    files.compact_dictionary(spark, inputs.dictionary_folder(spark, sf_dir), path)
    fetched = fx.tags(spark, sf_dir).select(
        F.col("tag_id").alias("id"), "name", F.lit(1).alias("count"), F.lit(0).alias("type"),
        F.lit(0).alias("ambiguous"),
    )
    files.append_dictionary(fetched, path)
    rows = load_tag_dictionary(spark, path).where("key = name")
    return rows.select("id", "key", "count", "type")

