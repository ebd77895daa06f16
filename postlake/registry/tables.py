"""Post, tag and relation tables, statistics and ranked lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.functions.times import month_of
from postlake.operators import normalize, numbering, stats
from postlake.operators.tagging import distinct_tagset
from postlake.registry import inputs  # noqa: F401  (defines the shared expressions)
from postlake.registry.base import CLOCK, clock, query, same_result
from postlake.session import cut_lineage

START = dt.datetime(1995, 1, 1, tzinfo=dt.timezone.utc)
MIN_COUNT = 25
_NEW = f"first_seen >= TIMESTAMP '1995-01-01 00:00:00' AND post_count > {MIN_COUNT}"
_STATS = f"SELECT kind, tag_id, tag_name, {CLOCK.format('first_seen')} AS first_seen, post_count FROM stats"


def _readable(rows):
    return rows.withColumn("first_seen", clock("first_seen"))


@query(
    "post_table",
    f"SELECT id, created_at, score, rating, file_url, {CLOCK.format('created_at_utc')} AS created_at_utc FROM post",
    "post",
)
def post_table(spark, sf_dir):
    return normalize.post_table(fx.flat_posts(spark, sf_dir)).withColumn(
        "created_at_utc", clock("created_at_utc")
    )


@query("distinct_tags_by_kind", "SELECT DISTINCT kind, name FROM tok", "tok")
def distinct_tags_by_kind(spark, sf_dir):
    return normalize.distinct_tags_by_kind(fx.flat_posts(spark, sf_dir))


@query(
    "distinct_tags_all_kinds",
    "SELECT kind, name, count(*) AS n_uses FROM tok GROUP BY kind, name",
    "tok",
)
def distinct_tags_all_kinds(spark, sf_dir):
    from postlake.schemas import ALL_TAG_COLUMNS

    return normalize.tag_usage(fx.flat_posts(spark, sf_dir), ALL_TAG_COLUMNS)


@query(
    "union_tag_frames",
    "SELECT name, kind FROM tag",
    "tag",
)
def union_tag_frames(spark, sf_dir):
    flat = fx.flat_posts(spark, sf_dir)
    frames = [
        normalize.tag_tokens(flat, [], {kind: column}).select("name", "kind")
        for kind, column in normalize.TAG_COLUMNS.items()
    ]
    return normalize.union_tag_frames(frames)


@query("assign_tag_ids", "SELECT tag_id, name, kind FROM tag", "tag")
def assign_tag_ids(spark, sf_dir):
    return normalize.tag_table(normalize.numbered_tags(fx.flat_posts(spark, sf_dir)))


@query(
    "assign_tag_ids_words",
    "SELECT CAST(row_number() OVER (ORDER BY kind, name) - 1 AS BIGINT) AS tag_id, kind, name FROM words",
    "words",
)
def assign_tag_ids_words(spark, sf_dir):
    tokens = fx.table(spark, sf_dir, "documents").select(
        F.col("lang").alias("kind"), F.explode(F.split("text", " ")).alias("name")
    ).where("name <> ''")
    return numbering.assign_tag_ids(tokens.distinct())


@query(
    "extend_tag_ids",
    """SELECT kind, name, CASE WHEN kind = 'artist' THEN k ELSE (SELECT count(*) FROM tag WHERE kind = 'artist') + k END AS tag_id
FROM (SELECT kind, name, CAST(row_number() OVER (PARTITION BY kind = 'artist' ORDER BY kind, name) - 1 AS BIGINT) AS k FROM tag)""",
    "tag",
)
def extend_tag_ids(spark, sf_dir):
    every = cut_lineage(normalize.distinct_tags_by_kind(fx.flat_posts(spark, sf_dir)))  # read three times
    known = numbering.assign_tag_ids(every.where("kind = 'artist'"))
    return numbering.extend_tag_ids(known, every).select("kind", "name", "tag_id")


@query("build_post_tag", "SELECT post_id, tag_id, count(*) AS n FROM post_tag GROUP BY ALL", "post_tag")
def build_post_tag(spark, sf_dir):
    related = normalize.build_post_tag(fx.flat_posts(spark, sf_dir), fx.numbered(spark, sf_dir))
    return fx.pair_counts(spark, sf_dir, related)


@query(
    "tag_post_join",
    f"""SELECT t.kind, t.name, p.rating, count(*) AS n, CAST(sum(p.score) AS BIGINT) AS score,
  min({CLOCK.format('p.created_at_utc')}) AS first
FROM tag t JOIN post_tag pt ON t.tag_id = pt.tag_id JOIN post p ON p.id = pt.post_id GROUP BY ALL""",
    ("tag", "post_tag", "post"),
)
def tag_post_join(spark, sf_dir):
    joined = stats.tag_post_join(
        fx.tags(spark, sf_dir), fx.post_tags_by_post(spark, sf_dir), fx.posts(spark, sf_dir)
    )
    return joined.groupBy("kind", "name", "rating").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"),
        F.min(clock("created_at_utc")).alias("first"),
    )


@query("tag_stats", _STATS, "stats")
def tag_stats(spark, sf_dir):
    return _readable(
        stats.tag_stats(
            fx.tags(spark, sf_dir), fx.post_tags_by_post(spark, sf_dir), fx.posts(spark, sf_dir)
        )
    )


@same_result("tag_stats_from_posts", "tag_stats")
def tag_stats_from_posts(spark, sf_dir):
    return _readable(
        stats.tag_stats_from_posts(fx.flat_posts(spark, sf_dir), fx.tags(spark, sf_dir))
    )


@query("filter_stats", f"{_STATS} WHERE {_NEW}", "stats")
def filter_stats(spark, sf_dir):
    return _readable(stats.filter_stats(fx.tag_stats(spark, sf_dir), START, MIN_COUNT))


@query("filter_kind", "SELECT tag_id, name, kind FROM tag WHERE kind = 'character'", "tag")
def filter_kind(spark, sf_dir):
    return stats.filter_kind(fx.tags(spark, sf_dir), "character")


@query("rank_new_tags", f"{_STATS} WHERE {_NEW}", "stats")
def rank_new_tags(spark, sf_dir):
    return _readable(stats.rank_new_tags(fx.tag_stats(spark, sf_dir), START, MIN_COUNT))


@query(
    "top20_new_tags",
    f"{_STATS} WHERE {_NEW} QUALIFY row_number() OVER (PARTITION BY kind ORDER BY post_count DESC, tag_name) <= 20",
    "stats",
)
def top20_new_tags(spark, sf_dir):
    return _readable(stats.top_new_tags(fx.tag_stats(spark, sf_dir), START, MIN_COUNT, 20))


@query(
    "collect_names",
    f"""SELECT kind, tag_name, CAST(row_number() OVER (PARTITION BY kind ORDER BY post_count DESC,
  tag_name) - 1 AS BIGINT) AS position FROM stats WHERE {_NEW}""",
    "stats",
)
def collect_names(spark, sf_dir):
    return stats.collect_names(stats.filter_stats(fx.tag_stats(spark, sf_dir), START, MIN_COUNT))


_GROUPED = """SELECT post_id, kind, string_agg(name, ' ' ORDER BY name) AS tags
FROM post_tag JOIN tag USING (tag_id) GROUP BY post_id, kind"""


@query("tags_grouped_by_kind", _GROUPED, "post_tag")
def tags_grouped_by_kind(spark, sf_dir):
    return stats.tags_grouped_by_kind(fx.post_tags_by_post(spark, sf_dir), fx.tags(spark, sf_dir))


@same_result("kinds_ordered", "tags_grouped_by_kind")
def kinds_ordered(spark, sf_dir):
    return stats.kinds_ordered(tags_grouped_by_kind(spark, sf_dir))


@query(
    "distinct_tagset",
    "SELECT DISTINCT unnest(string_split(text, ' ')) AS token FROM documents",
)
def tagset(spark, sf_dir):
    return distinct_tagset(fx.table(spark, sf_dir, "documents"), "text")


@query(
    "table_counts",
    """SELECT 'post' AS name, count(*) AS n_rows, 6 AS n_columns FROM post
UNION ALL SELECT 'tag', count(*), 3 FROM tag UNION ALL SELECT 'post_tag', count(*), 2 FROM post_tag""",
    ("post", "tag", "post_tag"),
)
def table_counts(spark, sf_dir):
    return stats.table_counts({
        "post": fx.posts(spark, sf_dir), "tag": fx.tags(spark, sf_dir),
        "post_tag": fx.post_tags(spark, sf_dir),
    })


@query("tags_per_kind", "SELECT kind, count(*) AS n FROM tag GROUP BY kind", "tag")
def tags_per_kind(spark, sf_dir):
    return fx.tags(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_empty_token",
    """SELECT kind, count(*) AS n, count(DISTINCT name) AS distinct_names FROM (
  SELECT lang AS kind, unnest(string_split(text, ' ')) AS name FROM documents) WHERE name <> '' GROUP BY kind""",
)
def filter_empty_token(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    per_lang = documents.select(
        F.col("lang").alias("kind"), F.explode(F.split("text", " ")).alias("name")
    ).where("name <> ''")
    counted = per_lang.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_names")
    )


@query(
    "month_of",
    """SELECT strftime(date_trunc('month', created_at_utc), '%Y-%m') AS month, count(*) AS n FROM post
WHERE created_at_utc IS NOT NULL GROUP BY 1""",
    "post",
)
def posts_by_month(spark, sf_dir):
    dated = fx.posts(spark, sf_dir).where("created_at_utc IS NOT NULL")
    month = F.date_format(month_of(F.col("created_at_utc")), "yyyy-MM").alias("month")
    return dated.groupBy(month).agg(F.count(F.lit(1)).alias("n"))
