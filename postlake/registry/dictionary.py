"""Typing tags against the dictionary."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.operators import metadata, numbering, tagging
from postlake.registry import inputs
from postlake.registry.base import CLOCK, define, query
from postlake.sources.dictionary import expand_aliases, load_tag_dictionary, read_tags

WORDS = ["red", "gizmo"]

_UNESCAPED = "replace(replace(bare, '&#39;', chr(39)), '&amp;', '&')"
define(
    "tries",
    f"""SELECT token, priority, key FROM (
  SELECT token, unnest([token, replace(bare, chr(39), '&#039;'), lower(bare), upper(bare), bare,
                        replace({_UNESCAPED}, chr(39), '&#039;')]) AS key,
         unnest([0, 1, 2, 3, 4, 5]) AS priority
  FROM (SELECT DISTINCT token, CASE WHEN token[1] = chr(92) THEN token[2:] ELSE token END AS bare
        FROM plain_tok))""",
    "plain_tok",
)
define(
    "resolved",
    """SELECT token, type, id, name FROM tries JOIN dict USING (key)
QUALIFY row_number() OVER (PARTITION BY token ORDER BY priority) = 1""",
    "tries", "dict",
)
define(
    "by_alias",
    """SELECT token, type, id, name FROM (SELECT * FROM tries WHERE priority > 0) JOIN dict USING (key)
QUALIFY row_number() OVER (PARTITION BY token ORDER BY priority) = 1""",
    "tries", "dict",
)
define(
    "placed",
    """SELECT id, token, pos FROM (SELECT id, unnest(string_split(tags, ' ')) AS token,
  generate_subscripts(string_split(tags, ' '), 1) AS pos FROM plain)""",
    "plain",
)
define(
    "typed",
    "SELECT p.id, p.pos, p.token, coalesce(r.type, 0) AS type FROM placed p LEFT JOIN resolved r USING (token)",
    "placed", "resolved",
)
_NAME = """CASE type WHEN 0 THEN 'general' WHEN 1 THEN 'artist' WHEN 3 THEN 'copyright' WHEN 4 THEN 'character'
  WHEN 5 THEN 'meta' WHEN 6 THEN 'deprecated' END"""


def _dictionary(spark, sf_dir):
    return load_tag_dictionary(spark, inputs.dictionary_folder(spark, sf_dir))


def _plain(spark, sf_dir):
    return inputs.plain_posts(spark, sf_dir)


@query(
    "expand_aliases",
    "SELECT key, name, count(*) AS n FROM (SELECT name AS key, part, tag_id, name FROM dict_lines "
    f"UNION SELECT {inputs._ESCAPED}, part, tag_id, name FROM dict_lines "
    "UNION SELECT lower(name), part, tag_id, name FROM dict_lines) GROUP BY ALL",
    "dict_lines",
)
def aliases(spark, sf_dir):
    tags = read_tags(spark, inputs.dictionary_folder(spark, sf_dir))
    expanded = expand_aliases(tags, lower=True)
    return expanded.groupBy("key", "name").agg(F.count(F.lit(1)).alias("n"))


@query("tag_exists", "SELECT DISTINCT token FROM plain_tok WHERE token IN (SELECT key FROM dict)", ("plain_tok", "dict"))
def tag_exists(spark, sf_dir):
    tokens = tagging.distinct_tagset(_plain(spark, sf_dir))
    return tagging.tag_exists(tokens, _dictionary(spark, sf_dir))


@query("posts_without_tags", "SELECT id FROM plain WHERE tags IS NULL", "plain")
def posts_without_tags(spark, sf_dir):
    return tagging.posts_without_tags(_plain(spark, sf_dir))


@query("resolve_tag_alias", "SELECT token, id, name, type FROM resolved", "resolved")
def resolve_tag_alias(spark, sf_dir):
    tokens = tagging.distinct_tagset(_plain(spark, sf_dir))
    found = tagging.resolve_tag_alias(tokens, _dictionary(spark, sf_dir))
    return found.select("token", "id", "name", "type")


@query(
    "missing_tags",
    "SELECT DISTINCT token FROM plain_tok WHERE token NOT IN (SELECT token FROM by_alias)",
    ("plain_tok", "by_alias"),
)
def missing_tags(spark, sf_dir):
    tokens = tagging.distinct_tagset(_plain(spark, sf_dir))
    return tagging.missing_tags(tokens, _dictionary(spark, sf_dir))


@query(
    "missing_tags_exact",
    "SELECT DISTINCT token FROM plain_tok WHERE token NOT IN (SELECT key FROM dict)",
    ("plain_tok", "dict"),
)
def missing_tags_exact(spark, sf_dir):
    tokens = tagging.distinct_tagset(_plain(spark, sf_dir))
    return tagging.missing_exact(tokens, _dictionary(spark, sf_dir))


@query(
    "tag_types",
    "SELECT id, string_agg('' || type, ' ' ORDER BY pos) AS types FROM typed GROUP BY id",
    "typed",
)
def tag_types(spark, sf_dir):
    types = tagging.tag_types(_plain(spark, sf_dir), _dictionary(spark, sf_dir), default=0)
    return types.select("id", F.array_join(F.col("types").cast("array<string>"), " ").alias("types"))


@query(
    "tag_types_verbose",
    f"SELECT id, string_agg({_NAME}, ' ' ORDER BY pos) AS types FROM typed GROUP BY id",
    "typed",
)
def tag_types_verbose(spark, sf_dir):
    types = tagging.tag_types_verbose(_plain(spark, sf_dir), _dictionary(spark, sf_dir), default=0)
    return types.select("id", F.array_join("types", " ").alias("types"))


@query(
    "structured_tags",
    f"SELECT id, {_NAME} AS type, string_agg(token, ' ' ORDER BY pos) AS tags FROM typed GROUP BY id, type",
    "typed",
)
def structured_tags(spark, sf_dir):
    rows = tagging.structured_tags(_plain(spark, sf_dir), _dictionary(spark, sf_dir), default=0)
    return rows.withColumn("tags", F.array_join("tags", " "))


@query(
    "parse_tags",
    "SELECT p.id AS post_id, CAST(p.pos - 1 AS INT) AS pos, p.token, r.id, r.name, r.type FROM placed p JOIN by_alias r USING (token)",
    ("placed", "by_alias"),
)
def parse_tags(spark, sf_dir):
    rows = tagging.parse_tags(_plain(spark, sf_dir), _dictionary(spark, sf_dir))
    return rows.select("post_id", "pos", "token", "id", "name", "type")


_META = f"""id, coalesce({CLOCK.format('created_at_utc')}, '') AS created_at, score, width, height, md5,
  file_ext AS image_ext, p.rating, coalesce(source, '') AS source, coalesce(title, '') AS title, file_url,
  coalesce(has_children, 'false') AS has_children, coalesce(parent_id, 0) AS parent_id"""
_DATED = "plain p JOIN (SELECT id, created_at_utc FROM post) USING (id)"


@query(
    "normalize_metadata",
    f"SELECT {_META}, coalesce(tags, '') AS tags FROM {_DATED}",
    ("plain", "post"),
)
def normalize_metadata(spark, sf_dir):
    rows = metadata.normalize_metadata(_plain(spark, sf_dir))
    return rows.withColumns({
        "created_at": F.coalesce("created_at", F.lit("")), "tags": F.coalesce("tags", F.lit(""))
    })


_LISTS = ", ".join(
    f"coalesce(string_agg(token, ' ' ORDER BY pos) FILTER (WHERE type = {code}), '') AS {name}"
    for name, code in metadata.LISTS.items()
)


@query(
    "structured_metadata",
    f"SELECT {_META}, {', '.join(f'coalesce({c}, {chr(39)}{chr(39)}) AS {c}' for c in metadata.LISTS)} "
    f"FROM {_DATED} LEFT JOIN (SELECT id, {_LISTS} FROM typed GROUP BY id) USING (id)",
    ("plain", "post", "typed"),
)
def structured_metadata(spark, sf_dir):
    rows = metadata.structured_metadata(_plain(spark, sf_dir), _dictionary(spark, sf_dir), default=0)
    return rows.withColumns({
        "created_at": F.coalesce("created_at", F.lit("")),
        **{c: F.array_join(c, " ") for c in metadata.LISTS},
    })


_BATCHES = """SELECT CAST(floor(pos / {size}) AS BIGINT) AS batch, string_agg(token, ' ' ORDER BY token) AS names, count(*) AS n
FROM (SELECT token, row_number() OVER (ORDER BY token) - 1 AS pos FROM ({tokens})) GROUP BY 1"""


@query(
    "lookup_batches_for_posts",
    _BATCHES.format(
        size=100,
        tokens="""SELECT DISTINCT token FROM plain_tok WHERE id IN (SELECT id FROM plain
  WHERE contains(tags, 'red') OR contains(tags, 'gizmo')) AND token NOT IN (SELECT token FROM by_alias)""",
    ),
    ("plain", "plain_tok", "by_alias"),
)
def lookup_batches_for_posts(spark, sf_dir):
    return tagging.lookup_batches_for_posts(_plain(spark, sf_dir), WORDS, _dictionary(spark, sf_dir))


@query(
    "batch_lookups",
    _BATCHES.format(size=99, tokens="SELECT DISTINCT name AS token FROM words"),
    "words",
)
def batch_lookups(spark, sf_dir):
    from postlake import fixtures as fx

    documents = fx.table(spark, sf_dir, "documents")
    tokens = documents.select(F.explode(F.split("text", " ")).alias("name")).where("name <> ''")
    return numbering.batch_lookups(tokens.distinct())
