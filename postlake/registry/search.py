"""Searches, lookups and records of posts."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.operators import saved_search, search, tag_index
from postlake.registry import inputs
from postlake.registry.base import CLOCK, clock, define, fresh_folder, query
from postlake.schemas import TRIMMED_POST

NAMES = ["red", "plate", "new"]
_MATCH = " INTERSECT ".join(
    f"SELECT post_id FROM post_tag JOIN tag USING (tag_id) WHERE name = '{n}'" for n in NAMES
)


def _matches(spark, sf_dir):
    return tag_index.search_index(fx.tag_index(spark, sf_dir), fx.numbered(spark, sf_dir), NAMES)


@query("search_intersect", _MATCH, "post_tag")
def search_intersect(spark, sf_dir):
    return _matches(spark, sf_dir)


@query("search_by_relation", _MATCH, "post_tag")
def search_by_relation(spark, sf_dir):
    """The same search over the relation itself, where no index is kept."""
    return search.search_intersect(fx.post_tags(spark, sf_dir), fx.tags(spark, sf_dir), NAMES)


@query(
    "search_min_score",
    f"SELECT post_id FROM ({_MATCH}) JOIN post ON id = post_id WHERE coalesce(score, 0) >= 51",
    ("post_tag", "post"),
)
def search_min_score(spark, sf_dir):
    return tag_index.search_index_min_score(
        fx.tag_index(spark, sf_dir), fx.numbered(spark, sf_dir), fx.posts(spark, sf_dir), NAMES, 51
    )


@query("search_page", f"SELECT post_id FROM ({_MATCH}) ORDER BY post_id LIMIT 20 OFFSET 20", "post_tag")
def search_page(spark, sf_dir):
    """Saved once as bitmaps; a page reads its own blocks."""
    path = fresh_folder(spark, sf_dir, "search")
    blocks = tag_index.search_blocks(fx.tag_index(spark, sf_dir), fx.numbered(spark, sf_dir), NAMES)
    saved_search.save_search(blocks, path)
    return saved_search.read_page(saved_search.saved_search(spark, path), page=2, size=20)


@query("search_page_after", f"SELECT post_id FROM ({_MATCH}) WHERE post_id > 5000 ORDER BY post_id LIMIT 30", "post_tag")
def search_page_after(spark, sf_dir):
    """The page behind a cursor."""
    path = fresh_folder(spark, sf_dir, "search")
    blocks = tag_index.search_blocks(fx.tag_index(spark, sf_dir), fx.numbered(spark, sf_dir), NAMES)
    saved_search.save_search(blocks, path)
    return saved_search.page_after(saved_search.saved_search(spark, path), 5000, 30)


@query("search_all_capped", f"SELECT post_id FROM ({_MATCH}) ORDER BY post_id LIMIT 500", "post_tag")
def search_all_capped(spark, sf_dir):
    return search.search_all_capped(_matches(spark, sf_dir), max_posts=500)


@query(
    "random_posts",
    f"SELECT post_id FROM ({_MATCH}) ORDER BY md5('7:' || post_id), post_id LIMIT 100",
    "post_tag",
)
def random_posts(spark, sf_dir):
    return search.random_posts(_matches(spark, sf_dir), 100, seed=7)


@query("post_tags_by_id", "SELECT kind, name FROM post_tag JOIN tag USING (tag_id) WHERE post_id = 9", "post_tag")
def post_tags_by_id(spark, sf_dir):
    return search.post_tags_by_id(fx.post_tags(spark, sf_dir), fx.tags(spark, sf_dir), 9)


@query(
    "post_point_lookup",
    f"SELECT id, score, rating, {CLOCK.format('created_at_utc')} AS created_at_utc FROM post WHERE id = 9",
    "post",
)
def post_point_lookup(spark, sf_dir):
    found = search.post_point_lookup(fx.posts(spark, sf_dir), 9)
    return found.select("id", "score", "rating", clock("created_at_utc").alias("created_at_utc"))


_PER_KIND = ", ".join(
    f"coalesce(string_agg(name, ' ' ORDER BY name) FILTER (WHERE kind = '{k}'), '') AS tag_string_{k}"
    for k in ("artist", "character", "copyright", "general", "meta")
)
_POST_DICT = f"""
SELECT p.id, p.created_at, {CLOCK.format('p.created_at_utc')} AS created_at_utc, p.file_url, p.score, p.rating, {_PER_KIND.replace('name', 't.name').replace('kind', 't.kind')},
  coalesce(string_agg(t.name, ' ' ORDER BY t.kind, t.name), '') AS tag_string
FROM post p LEFT JOIN post_tag pt ON pt.post_id = p.id LEFT JOIN tag t ON t.tag_id = pt.tag_id
GROUP BY p.id, p.created_at, p.created_at_utc, p.file_url, p.score, p.rating"""


@query("build_post_dict", _POST_DICT, ("post", "post_tag"))
def build_post_dict(spark, sf_dir):
    records = search.build_post_dict(
        fx.post_tags_by_post(spark, sf_dir), fx.tags(spark, sf_dir), fx.posts(spark, sf_dir)
    )
    return records.withColumn("created_at_utc", clock("created_at_utc"))


_TRIMMED = [f"coalesce({c}, '') AS {c}" for c in TRIMMED_POST if c not in ("id", "score")]


@query(
    "trim_post",
    f"SELECT id, {', '.join(_TRIMMED)}, score FROM post_src",
    "post_src",
)
def trim_post(spark, sf_dir):
    trimmed = search.trim_post(fx.flat_posts(spark, sf_dir))
    texts = [c for c in TRIMMED_POST if c not in ("id", "score")]
    return trimmed.withColumns({c: F.coalesce(c, F.lit("")) for c in texts})


@query(
    "trim_post_plain",
    "SELECT id, coalesce(created_at, '') AS created_at, file_url, rating, score, coalesce(tags, '') AS tags FROM plain",
    "plain",
)
def trim_post_plain(spark, sf_dir):
    trimmed = search.trim_post(inputs.plain_posts(spark, sf_dir))
    return trimmed.select(
        "id", F.coalesce("created_at", F.lit("")).alias("created_at"), "file_url", "rating", "score",
        F.coalesce("tags", F.lit("")).alias("tags"),
    )


@query("filter_id_range", "SELECT id, score FROM post_src WHERE id >= 100", "post_src")
def filter_id_range(spark, sf_dir):
    return search.filter_id_range(fx.flat_posts(spark, sf_dir), 100, 0).select("id", "score")


@query("filter_id_window", "SELECT id, rating FROM post_src WHERE id BETWEEN 1200 AND 1299", "post_src")
def filter_id_window(spark, sf_dir):
    return search.filter_id_window(fx.posts(spark, sf_dir), 1234).select("id", "rating")


@query("filter_min_score", "SELECT id, score FROM post_src WHERE coalesce(score, 0) >= 40", "post_src")
def filter_min_score(spark, sf_dir):
    return search.filter_min_score(fx.flat_posts(spark, sf_dir), 40).select("id", "score")


define(
    "every_id",
    "SELECT i, i - i % 20 AS w FROM (SELECT unnest(range(7, max(doc_id) + 1)) AS i FROM labels)",
)


@query(
    "id_window_coverage",
    """SELECT CAST(w AS BIGINT) AS "window", count(DISTINCT doc_id) AS n_posts,
  coalesce(string_agg('' || i, ',' ORDER BY i) FILTER (WHERE doc_id IS NULL), '') AS missing
FROM every_id LEFT JOIN labels ON doc_id = i GROUP BY w""",
    "every_id",
)
def id_window_coverage(spark, sf_dir):
    # Labels cover some of the documents: ids with gaps.
    ids = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    high = ids.agg(F.max("id")).first()[0]
    windows = search.id_window_coverage(ids, 7, high, 20)
    return windows.withColumn("missing", F.array_join("missing", ","))
