"""Flattening and schemas of raw records."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.functions.media import window_start
from postlake.operators import dedup, paths, records
from postlake.operators.records import RECORD_ORDER
from postlake.registry import inputs
from postlake.registry.base import query
from postlake.schemas import POST_FIELDS
from postlake.sources import jsonl

_NESTED = """'{"id":' || event_id || ',"ev":{"props":' || props || ',"type":"' || event_type
  || '","l":[' || user_id || ',{"c":null,"d":[]}]},"e":{},"k":[]}'"""


def _event_records(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("event_id", F.expr(_NESTED).alias("line"))
    return events, records.unwrap_envelope(jsonl.parse_strict(events))


_PATHS = """
SELECT event_id, 'id' AS path, '' || event_id AS value FROM events
UNION ALL SELECT event_id, 'ev.props.k', json_extract_string(props, '$.k') FROM events
UNION ALL SELECT event_id, 'ev.type', event_type FROM events
UNION ALL SELECT event_id, 'ev.l.0', '' || user_id FROM events
UNION ALL SELECT event_id, 'ev.l.1.c', NULL FROM events"""


def _event_lines(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select("event_id", F.expr(_NESTED).alias("line"))


@query("flatten_paths", _PATHS)
def flatten_paths(spark, sf_dir):
    return paths.path_rows(paths.record_maps(_event_lines(spark, sf_dir), ["event_id"], strict=True)).drop("place")


@query("flatten_variants", _PATHS)
def flatten_variants(spark, sf_dir):
    """The same rows from parsed records, where no two values share a path."""
    lines, recs = _event_records(spark, sf_dir)
    depth, dotted = records.nesting(lines)
    return records.flatten_paths(recs, ["event_id"], depth, dotted)


_COLLIDING = """CASE event_id % 4 WHEN 0 THEN '{"a.b":"first","a":{"b":"' || event_type || '"}}'
  WHEN 1 THEN '{"a":{"b":"first"},"a.b":"' || event_type || '"}'
  WHEN 2 THEN '{"post":[{"a":{"b":{"c":1},"b.c":"' || event_type || '"}},{"l":["first"],"l.0":"' || event_type || '"}]}'
  ELSE '{"a.b":"first","a":{"c":2},"x":{},"a":{"b":"' || event_type || '"}}' END"""


@query(
    "flatten_paths_colliding",
    """SELECT event_id, CASE event_id % 4 WHEN 2 THEN 'a.b.c' ELSE 'a.b' END AS path, event_type AS value FROM events
UNION ALL SELECT event_id, 'l.0', event_type FROM events WHERE event_id % 4 = 2""",
)
def flatten_paths_colliding(spark, sf_dir):
    """Two values on one path, in both orders: the last in the document stays."""
    lines = fx.table(spark, sf_dir, "events").select("event_id", F.expr(_COLLIDING).alias("line"))
    return paths.path_rows(paths.record_maps(lines, ["event_id"])).drop("place")


@query(
    "schema_keep_all",
    """SELECT event_id, '' || event_id AS id, json_extract_string(props, '$.k') AS ev_props_k,
  event_type AS ev_type, '' || user_id AS ev_l_0, CAST(NULL AS VARCHAR) AS ev_l_1_c FROM events""",
)
def schema_keep_all(spark, sf_dir):
    kept = paths.record_maps(_event_lines(spark, sf_dir), ["event_id"], strict=True).drop("place")
    wide = records.fields_as_columns(kept, ["id", "ev.props.k", "ev.type", "ev.l.0", "ev.l.1.c"])
    return wide.toDF(*[c.replace(".", "_") for c in wide.columns])


_SPARSE = """CASE event_id % 3 WHEN 0 THEN '{}' WHEN 1 THEN '{"e":{},"k":[]}'
  ELSE '{"id":' || event_id || ',"n":null,"t":"' || event_type || '"}' END"""


@query(
    "schema_keep_all_empty",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'id=' || event_id || ';n=;t=' || event_type ELSE '' END AS fields
FROM events""",
)
def schema_keep_all_empty(spark, sf_dir):
    """Records of which two thirds hold no value."""
    events = fx.table(spark, sf_dir, "events").select("event_id", F.expr(_SPARSE).alias("line"))
    kept = paths.record_maps(events, ["event_id"], strict=True)
    pairs = F.transform(
        F.array_sort(F.map_entries("fields")),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))),
    )
    return kept.select("event_id", F.array_join(pairs, ";").alias("fields"))


@query(
    "keep_keys",
    """SELECT event_id, '' || event_id AS id, '' || user_id AS first,
  json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def keep_keys(spark, sf_dir):
    _, recs = _event_records(spark, sf_dir)
    keys = ["id", "ev.l.0", "ev.props.k", "absent"]
    named = recs.withColumnRenamed("event_id", "row")
    return records.keep_keys(named, keys).select(
        F.col("row").alias("event_id"), "id", F.col("`ev.l.0`").alias("first"),
        F.col("`ev.props.k`").alias("k"), "absent",
    )


_FIXED = ("id", "created_at", "score", "rating", "image_width", "is_deleted", "tag_string", "file_url")


@query(
    "schema_fixed",
    "SELECT coalesce(r.id, -1) AS id, " + ", ".join(f"s.{c}" for c in _FIXED[1:])
    + ", coalesce(s.large_file_url, '') AS large, '' AS source "
    "FROM recs r JOIN post_src s ON s.id = r.src",
    ("recs", "post_src"),
)
def schema_fixed(spark, sf_dir):
    lines = inputs.raw_lines(spark, sf_dir).select("line")
    posts = records.schema_fixed(records.unwrap_envelope(jsonl.parse_tolerant(lines)))
    assert set(POST_FIELDS) <= set(posts.columns)
    return posts.select(
        F.coalesce("id", F.lit(-1)).alias("id"), *_FIXED[1:],
        F.coalesce("large_file_url", F.lit("")).alias("large"),
        F.coalesce("source", F.lit("")).alias("source"),
    )


@query(
    "schema_all_string",
    "SELECT s.created_at, coalesce('' || r.id, '') AS id, CASE WHEN s.is_deleted THEN 'true' ELSE 'false' END "
    "AS is_deleted, '' || s.score AS score FROM recs r JOIN post_src s ON s.id = r.src",
    ("recs", "post_src"),
)
def schema_all_string(spark, sf_dir):
    lines = inputs.raw_lines(spark, sf_dir).select("line")
    recs = records.unwrap_envelope(jsonl.parse_tolerant(lines)).drop("place")
    rows = records.schema_all_string(recs, ["score", "id", "created_at", "is_deleted"])
    return rows.withColumn("id", F.coalesce("id", F.lit("")))


@query(
    "align_schema",
    """SELECT id, score, rating, '' AS title FROM post_src
UNION ALL SELECT id, score, '' AS rating, coalesce(title, '') FROM plain""",
    ("post_src", "plain"),
)
def align_schema(spark, sf_dir):
    fields = {"id": "BIGINT", "score": "BIGINT", "rating": "STRING", "title": "STRING"}
    first = fx.flat_posts(spark, sf_dir).select("score", F.col("id").cast("string"), "rating")
    second = inputs.plain_posts(spark, sf_dir).select("title", "id", "score", "owner")
    merged = records.union_aligned([first, second], fields)
    return merged.select("id", "score", *[F.coalesce(c, F.lit("")).alias(c) for c in ("rating", "title")])


_DEDUP = """
SELECT id, score, rating FROM post_src
UNION ALL SELECT -1, s.score, s.rating FROM recs r JOIN post_src s ON s.id = r.src WHERE r.id IS NULL"""


@query("dedup_by_id", _DEDUP, ("recs", "post_src"))
def dedup_by_id(spark, sf_dir):
    lines = jsonl.read_lines(spark, inputs.line_tree(spark, sf_dir), pattern=inputs.TREE_FILES)
    posts = records.schema_fixed(records.unwrap_envelope(jsonl.parse_tolerant(lines)))
    once = dedup.dedup_by_id(posts, RECORD_ORDER)
    return once.select(F.coalesce("id", F.lit(-1)).alias("id"), "score", "rating")


@query(
    "dedup_rank",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS INT) AS place
FROM lineitem QUALIFY place <= 3""",
)
def dedup_rank(spark, sf_dir):
    items = fx.table(spark, sf_dir, "lineitem")
    order = [F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
    ranked = dedup.dedup_rank(items, ["l_partkey"], order, "place").where("place <= 3")
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", "place")


@query(
    "merge_bulk_windows",
    "SELECT id, CASE WHEN id % 3 = 0 THEN score + 1000 ELSE score END AS score, rating FROM post_src WHERE id >= 105",
    "post_src",
)
def merge_bulk_windows(spark, sf_dir):
    """Two fetches that overlap in a third of the ids, with other scores: the earlier window counts."""
    flat = fx.flat_posts(spark, sf_dir)
    first = flat.where("id % 3 <> 0").withColumn("window", window_start(F.col("id"), 20))
    second = flat.where("id % 3 <> 1").withColumn("window", window_start(F.col("id"), 20) + 20)
    fetched = [first, second.withColumn("score", F.col("score") + 1000)]
    merged = dedup.merge_bulk_windows(fetched, 105, None, ["window"])
    return merged.select("id", "score", "rating")
