"""Scans and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.operators.records import schema_fixed, unwrap_envelope
from postlake.registry import inputs
from postlake.registry.base import fresh_folder, query
from postlake.sources import dictionary, jsonl, tables

_PER_FILE = "SELECT {name} AS file_name, count(*) AS n_lines FROM lines WHERE {keep} GROUP BY {name}"


def _per_file(lines):
    return lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_lines"))


@query("scan_jsonl_tree", _PER_FILE.format(name="file_name", keep="true"), "lines")
def scan_jsonl_tree(spark, sf_dir):
    return _per_file(jsonl.read_lines(spark, inputs.line_tree(spark, sf_dir), pattern=inputs.TREE_FILES, must_exist=True))


@query(
    "parse_strict",
    "SELECT s.id, s.rating, s.score FROM recs r JOIN post_src s ON s.id = r.src WHERE r.id IS NOT NULL "
    "UNION ALL SELECT -1, s.rating, s.score FROM recs r JOIN post_src s ON s.id = r.src WHERE r.id IS NULL",
    ("recs", "post_src"),
)
def parse_strict(spark, sf_dir):
    tree = inputs.line_tree(spark, sf_dir, whole=True)
    parsed = jsonl.parse_strict(jsonl.read_lines(spark, tree, pattern=inputs.TREE_FILES))
    posts = schema_fixed(unwrap_envelope(parsed))
    return posts.select(F.coalesce("id", F.lit(-1)).alias("id"), "rating", "score")


@query(
    "parse_tolerant",
    "SELECT file_name, count(CASE WHEN shape <> 'cut' THEN 1 END) AS good, "
    "count(CASE WHEN shape = 'cut' THEN 1 END) AS bad FROM lines GROUP BY file_name",
    "lines",
)
def parse_tolerant(spark, sf_dir):
    parsed = jsonl.parse_tolerant(jsonl.read_lines(spark, inputs.line_tree(spark, sf_dir), pattern=inputs.TREE_FILES))
    return parsed.groupBy("file_name").agg(
        F.count("doc").alias("good"), F.count_if(F.col("doc").isNull()).alias("bad")
    )


@query(
    "prune_min_id",
    _PER_FILE.format(
        name="file_name",
        keep="file_name LIKE 'posts%' OR CAST(string_split(file_name, '_')[1] AS BIGINT) >= 4000",
    ),
    "lines",
)
def prune_min_id(spark, sf_dir):
    tree = inputs.line_tree(spark, sf_dir)
    return _per_file(jsonl.read_lines(spark, tree, lambda name: jsonl.from_min_id(name, 4000), inputs.TREE_FILES))


_RANGE = "CAST(string_split(string_split(strict_name, '.')[1], '_')[2] AS BIGINT) >= 6000"


@query("prune_id_range", _PER_FILE.format(name="file_name", keep=_RANGE), "lines")
def prune_id_range(spark, sf_dir):
    tree = inputs.line_tree(spark, sf_dir)
    return _per_file(jsonl.read_lines(spark, tree, lambda name: jsonl.from_id_range(name, 6000), inputs.TREE_FILES))


@query("prune_id_range_strict", _PER_FILE.format(name="strict_name", keep=_RANGE), "lines")
def prune_id_range_strict(spark, sf_dir):
    tree = inputs.line_tree(spark, sf_dir, "strict_name")
    keep = lambda name: jsonl.from_id_range_strict(name, 6000)
    return _per_file(jsonl.read_lines(spark, tree, keep, pattern=None))


@query(
    "unwrap_envelope",
    "SELECT coalesce(id, -1) AS id, CAST(place AS BIGINT) AS place, count(*) AS n FROM recs GROUP BY ALL",
    "recs",
)
def unwrap(spark, sf_dir):
    lines = inputs.raw_lines(spark, sf_dir).select("line")
    posts = schema_fixed(unwrap_envelope(jsonl.parse_tolerant(lines)))
    return posts.groupBy(
        F.coalesce("id", F.lit(-1)).alias("id"), F.col("place").cast("bigint").alias("place")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("scan_parquet_project", "SELECT id, rating, score FROM post_src", "post_src")
def scan_parquet_project(spark, sf_dir):
    fx.flat_posts(spark, sf_dir)
    return tables.scan_parquet(spark, fx.folder(spark, sf_dir, "flat"), ["id", "rating", "score"])


@query("load_tag_dictionary", "SELECT key, id, name, count, type, ambiguous FROM dict", "dict")
def load_tag_dictionary(spark, sf_dir):
    return dictionary.load_tag_dictionary(spark, inputs.dictionary_folder(spark, sf_dir))


@query(
    "load_key_list",
    "SELECT trim(p_name) AS key, count(*) AS n FROM part WHERE trim(p_name) <> '' GROUP BY 1",
)
def load_key_list(spark, sf_dir):
    path = fresh_folder(spark, sf_dir, "keys")
    names = fx.table(spark, sf_dir, "part").select(
        F.explode(F.array(F.concat(F.lit("  "), "p_name", F.lit("\t")), F.lit("  "))).alias("value")
    )
    names.write.text(path)
    return jsonl.load_key_list(spark, path).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query(
    "load_tagset_cache",
    "SELECT DISTINCT unnest(string_split(text, ' ')) AS token FROM documents",
)
def load_tagset_cache(spark, sf_dir):
    from postlake.operators.tagging import distinct_tagset

    documents = fx.table(spark, sf_dir, "documents").withColumnRenamed("text", "tags")
    path = fx.folder(spark, sf_dir, "tagset")
    name = "tagset_" + path.split("/")[-2]
    return tables.load_or_build(spark, name, lambda: distinct_tagset(documents), path)


@query("read_catalog_table", "SELECT tag_id, name, kind FROM tag", "tag")
def read_catalog_table(spark, sf_dir):
    path = fx.folder(spark, sf_dir, "tag_table")
    name = "tag_" + path.split("/")[-2]
    tables.load_or_build(spark, name, lambda: fx.tags(spark, sf_dir), path)
    return tables.read_catalog_table(spark, name)
