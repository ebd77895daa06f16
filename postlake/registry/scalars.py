"""Scalar functions over whole columns of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.functions import labels, media, text, times
from postlake.operators.normalize import tag_tokens
from postlake.registry import inputs
from postlake.registry.base import CLOCK, clock, query
from postlake.sinks.files import caption_rows


def _flat(spark, sf_dir):
    return fx.flat_posts(spark, sf_dir)


@query(
    "parse_created_at",
    f"SELECT id, {CLOCK.format('created_at_utc')} AS instant FROM post",
    "post",
)
def parse_created_at(spark, sf_dir):
    return _flat(spark, sf_dir).select(
        "id", clock(times.parse_created_at(F.col("created_at"))).alias("instant")
    )


@query(
    "parse_rfc_wallclock",
    f"SELECT p.id, {CLOCK.format('created_at_utc')} AS clock FROM plain p JOIN post USING (id)",
    ("plain", "post"),
)
def parse_rfc_wallclock(spark, sf_dir):
    return inputs.plain_posts(spark, sf_dir).select(
        "id", times.parse_rfc_wallclock(F.col("created_at")).alias("clock")
    )


@query(
    "split_tags",
    "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INT) AS n, array_to_string(string_split(text, ' '), '|') AS parts FROM documents",
)
def split_tags(spark, sf_dir):
    parts = text.split_tags(F.col("text"))
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.size(parts).alias("n"), F.array_join(parts, "|").alias("parts")
    )


@query("explode_tags", "SELECT id, kind, name, count(*) AS n FROM tok GROUP BY ALL", "tok")
def explode_tags(spark, sf_dir):
    tokens = tag_tokens(_flat(spark, sf_dir), ["id"])
    return tokens.groupBy("id", "kind", "name").agg(F.count(F.lit(1)).alias("n"))


_RATING = """'rating:' || CASE lower(rating) WHEN 'g' THEN 'general' WHEN 's' THEN 'sensitive'
  WHEN 'q' THEN 'questionable' WHEN 'e' THEN 'explicit' ELSE lower(rating) END"""
_QUALITY = "CASE WHEN score > 100 THEN 'masterpiece' WHEN score > 50 THEN 'best quality' WHEN score < 0 THEN 'worst quality' ELSE '' END"


@query("rating_label", f"SELECT id, {_RATING} AS label FROM post_src", "post_src")
def rating_label(spark, sf_dir):
    return _flat(spark, sf_dir).select("id", labels.rating_label(F.upper("rating")).alias("label"))


@query("score_quality", f"SELECT id, {_QUALITY} AS quality FROM post_src", "post_src")
def score_quality(spark, sf_dir):
    return _flat(spark, sf_dir).select("id", labels.score_quality(F.col("score")).alias("quality"))


@query(
    "year_label",
    "SELECT id, coalesce('year:' || year(created_at_utc), '') AS label FROM post",
    "post",
)
def year_label(spark, sf_dir):
    label = labels.year_label(F.year("created_at_utc"))
    return fx.posts(spark, sf_dir).select("id", F.coalesce(label, F.lit("")).alias("label"))


@query(
    "label_tags",
    """SELECT id, coalesce(array_to_string(list_transform(string_split(tag_string_character, ' '),
  lambda t: 'character: ' || replace(t, '_', ' ')), '|'), '') AS pieces FROM post_src""",
    "post_src",
)
def label_tags(spark, sf_dir):
    pieces = labels.label_tags(F.col("tag_string_character"), "character: ")
    return _flat(spark, sf_dir).select(
        "id", F.coalesce(F.array_join(pieces, "|"), F.lit("")).alias("pieces")
    )


@query(
    "plain_tags_piece",
    "SELECT id, coalesce(replace(replace(tags, ' ', ', '), '_', ' '), '') AS piece FROM plain",
    "plain",
)
def plain_tags_piece(spark, sf_dir):
    piece = labels.plain_tags_piece(F.col("tags"))
    return inputs.plain_posts(spark, sf_dir).select(
        "id", F.coalesce(piece, F.lit("")).alias("piece")
    )


def _labelled(column: str, label: str) -> str:
    spaced = f"replace(replace({column}, '_', chr(1)), ' ', ', {label}')"
    return f"'{label}' || replace({spaced}, chr(1), ' ')"


_PIECES = ", ".join(
    _labelled(f"tag_string_{kind}", label)
    for kind, label in (
        ("artist", "artist: "), ("character", "character: "), ("copyright", "copyright: "),
        ("meta", "meta: "), ("general", ""),
    )
)


@query(
    "caption",
    f"""SELECT id, replace(concat_ws(', ', {_PIECES}, {_RATING},
  CASE WHEN {_QUALITY} <> '' THEN 'score:' || {_QUALITY} END,
  'year:' || year(created_at_utc)), ', ,', ', ') AS caption
FROM post_src JOIN (SELECT id, created_at_utc FROM post) USING (id)""",
    ("post_src", "post"),
)
def caption(spark, sf_dir):
    dated = _flat(spark, sf_dir).withColumn(
        "year", F.year(times.parse_created_at(F.col("created_at")))
    )
    return caption_rows(dated)


@query(
    "caption_plain",
    f"""SELECT id, replace(concat_ws(', ', replace(replace(tags, ' ', ', '), '_', ' '), {_RATING},
  CASE WHEN {_QUALITY} <> '' THEN 'score:' || {_QUALITY} END), ', ,', ', ') AS caption FROM plain""",
    "plain",
)
def caption_plain(spark, sf_dir):
    return caption_rows(inputs.plain_posts(spark, sf_dir))


@query(
    "sanitize_folder",
    "SELECT page_id, regexp_replace(url, '[<>:\"/|?* ,]', '_', 'g') AS folder FROM pages",
)
def sanitize_folder(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select(
        "page_id", text.sanitize_folder(F.col("url")).alias("folder")
    )


@query(
    "normalize_query",
    "SELECT p_partkey, replace(trim('  ' || p_name || ' '), ' ', '_') AS request FROM part",
)
def normalize_query(spark, sf_dir):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return fx.table(spark, sf_dir, "part").select(
        "p_partkey", text.normalize_query(padded).alias("request")
    )


@query(
    "tokenize_query",
    "SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''), '|') AS words FROM documents",
)
def tokenize_query(spark, sf_dir):
    tokens = text.tokenize_query(F.col("text"))
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(tokens, "|").alias("words")
    )


_ESCAPE = (
    "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
    "'\"', '&quot;'), chr(39), '&#x27;')"
)


@query("html_escape", f"SELECT page_id, md5({_ESCAPE.format('html')}) AS escaped FROM pages")
def html_escape(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select(
        "page_id", F.md5(text.html_escape(F.col("html"))).alias("escaped")
    )


# References of every form and what they stand for.
_REFERENCES = (
    ("&amp;", "&"), ("&lt", "<"), ("&notin;", "\u2209"), ("&notit;", "\u00acit;"), ("&#x41;", "A"), ("&#65", "A"), ("&#0;", "\ufffd"),
    ("&#150;", "\u2013"), ("&unknownreference;", "&unknownreference;"), ("& ", "& "), ("&CounterClockwiseContourIntegral;", "\u2233"),
    ("&#X1F600;", "\U0001f600"), ("&#99999999999;", "\ufffd"), ("&&amp;amp;", "&&amp;"),
)


def _cases(column: int) -> str:
    cases = " ".join(f"WHEN {at} THEN '{pair[column]}'" for at, pair in enumerate(_REFERENCES))
    return f"CASE p_partkey % {len(_REFERENCES)} {cases} END"


@query("html_unescape_references", f"SELECT p_partkey, p_name || ({_cases(1)}) || '_' || p_brand AS plain FROM part")
def html_unescape_references(spark, sf_dir):
    """Named, decimal and hex references, some without a semicolon, some unknown or invalid."""
    typed = fx.table(spark, sf_dir, "part").select("p_partkey", F.expr(f"p_name || ({_cases(0)}) || '_' || p_brand").alias("text"))
    return typed.select("p_partkey", text.html_unescape(F.col("text")).alias("plain"))


@query(
    "html_unescape",
    "SELECT DISTINCT token, replace(replace(token, '&#39;', chr(39)), '&amp;', '&') AS plain FROM plain_tok",
    "plain_tok",
)
def html_unescape(spark, sf_dir):
    from postlake.operators.tagging import distinct_tagset

    tokens = distinct_tagset(inputs.plain_posts(spark, sf_dir))
    return tokens.select("token", text.html_unescape(F.col("token")).alias("plain"))


@query("quote_names", "SELECT doc_id, md5(url_encode(text)) AS quoted FROM documents")
def quote_names(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(text.quote_names(F.col("text"))).alias("quoted")
    )


@query(
    "tag_case_keys",
    """SELECT token, replace(bare, chr(39), '&#039;') || '|' || lower(bare) || '|' || upper(bare) || '|' || bare AS keys
FROM (SELECT DISTINCT token, CASE WHEN token[1] = chr(92) THEN token[2:] ELSE token END AS bare FROM plain_tok)""",
    "plain_tok",
)
def tag_case_keys(spark, sf_dir):
    from postlake.operators.tagging import distinct_tagset

    tokens = distinct_tagset(inputs.plain_posts(spark, sf_dir))
    return tokens.select("token", F.array_join(text.tag_case_keys(F.col("token")), "|").alias("keys"))


@query(
    "tag_type_name",
    """SELECT key, CASE type WHEN 0 THEN 'general' WHEN 1 THEN 'artist' WHEN 3 THEN 'copyright'
  WHEN 4 THEN 'character' WHEN 5 THEN 'meta' WHEN 6 THEN 'deprecated' END AS type FROM dict""",
    "dict",
)
def tag_type_name(spark, sf_dir):
    from postlake.sources.dictionary import load_tag_dictionary

    rows = load_tag_dictionary(spark, inputs.dictionary_folder(spark, sf_dir))
    return rows.select("key", labels.tag_type_name(F.col("type")).alias("type"))


@query(
    "url_suffix",
    "SELECT page_id, regexp_extract(url, '[^/](\\.[^./]+)/*$', 1) AS suffix FROM pages",
)
def url_suffix(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select(
        "page_id", media.url_suffix(F.col("url")).alias("suffix")
    )


@query("window_start", "SELECT id, id - id % 20 AS start FROM post_src", "post_src")
def window_start(spark, sf_dir):
    return _flat(spark, sf_dir).select("id", media.window_start(F.col("id"), 20).alias("start"))


@query("image_ext", "SELECT id, string_split(image, '.')[-1] AS ext FROM plain", "plain")
def image_ext(spark, sf_dir):
    return inputs.plain_posts(spark, sf_dir).select(
        "id", media.after_last_dot(F.col("image")).alias("ext")
    )


@query(
    "variant_lookup",
    "SELECT id, coalesce(list_filter(variants, lambda v: v.type = 'original')[1].url, '') AS url FROM variant_posts",
    "variant_posts",
)
def variant_lookup(spark, sf_dir):
    found = media.variant_lookup(F.col("variants"), lambda v: v["type"] == "original")
    return inputs.variant_posts(spark, sf_dir).select(
        "id", F.coalesce(found["url"], F.lit("")).alias("url")
    )


@query(
    "to_json_doc",
    """SELECT l_orderkey, l_linenumber, '{"part":' || l_partkey || ',"flag":"' || l_returnflag || '"}' AS doc,
  l_partkey AS part FROM lineitem""",
)
def to_json_doc(spark, sf_dir):
    doc = F.to_json(F.struct(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag")))
    made = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", doc.alias("doc"))
    part = F.try_variant_get(F.try_parse_json("doc"), "$.part", "bigint")
    return made.withColumn("part", part)


@query(
    "from_json_line",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def from_json_line(spark, sf_dir):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return fx.table(spark, sf_dir, "events").select("event_id", k.alias("k"))
