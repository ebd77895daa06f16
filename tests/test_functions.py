"""Literal edge cases of the scalar functions."""

import html
import urllib.parse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlake.functions import labels, media, text, times


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def many(spark, column, inputs, kind="string"):
    rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, v {kind}")
    found = rows.select("i", column(F.col("v")).alias("r")).collect()
    return [row["r"] for row in sorted(found, key=lambda row: row["i"])]


def as_text(column):
    return lambda v: F.date_format(column(v), "yyyy-MM-dd HH:mm:ss")


@pytest.mark.parametrize("value, expected", [
    ("2023-11-05T12:31:09.000-05:00", "2023-11-05 17:31:09"),
    ("2023-11-05T12:31:09Z", "2023-11-05 12:31:09"),
    ("bad", None), ("", None), (None, None),
])
def test_parse_created_at(spark, value, expected):
    assert one(spark, as_text(times.parse_created_at), value) == expected


@pytest.mark.parametrize("value, expected", [
    ("Sun Nov 05 11:30:58 -0600 2023", "2023-11-05 11:30:58"),
    ("Sat Mar 26 02:30:00 +0100 2022", "2022-03-26 02:30:00"),
    ("Nov 05 2023", None), (None, None),
])
def test_parse_rfc_wallclock(spark, value, expected):
    assert one(spark, times.parse_rfc_wallclock, value) == expected


def test_month_of(spark):
    column = lambda v: as_text(times.month_of)(v.cast("timestamp"))
    assert one(spark, column, "2024-02-29 23:59:59") == "2024-02-01 00:00:00"


@pytest.mark.parametrize("value, expected", [
    ("a b  a ", ["a", "b", "", "a", ""]), ("", [""]), (None, None),
])
def test_split_tags(spark, value, expected):
    assert one(spark, text.split_tags, value) == expected


@pytest.mark.parametrize("value, expected", [
    (101, "masterpiece"), (100, "best quality"), (51, "best quality"), (50, ""), (0, ""),
    (-1, "worst quality"),
])
def test_score_quality(spark, value, expected):
    assert one(spark, labels.score_quality, value, "bigint") == expected


@pytest.mark.parametrize("value, expected", [
    ("g", "rating:general"), ("S", "rating:sensitive"), ("x", "rating:x"), ("", None), (None, None),
])
def test_rating_label(spark, value, expected):
    assert one(spark, labels.rating_label, value) == expected


@pytest.mark.parametrize("value, expected", [(2023, "year:2023"), (0, None), (None, None)])
def test_year_label(spark, value, expected):
    assert one(spark, labels.year_label, value, "int") == expected


def test_label_tags(spark):
    made = one(spark, lambda v: labels.label_tags(v, "artist: "), "  a_b\tc ")
    assert made == ["artist: a b", "artist: c"]
    assert one(spark, labels.label_tags, " ") == []


def test_sanitize_folder(spark):
    assert one(spark, text.sanitize_folder, 'a<b>:"/|?* ,') == "a_b_________"
    assert one(spark, text.sanitize_folder, "a\\b") == "a\\b"


def test_normalize_query(spark):
    assert one(spark, text.normalize_query, "  long hair  ") == "long_hair"


def test_html_escape(spark):
    assert one(spark, text.html_escape, "a'b&") == "a&#x27;b&amp;"


@pytest.mark.parametrize("value, expected", [
    ("http://x/y.jpg?z", ".jpg?z"), ("http://x/y", ""), ("http://x.com/.hid", ""),
    ("http://x/a.tar.gz", ".gz"), ("http://x/y.", ""),
])
def test_url_suffix(spark, value, expected):
    assert one(spark, media.url_suffix, value) == expected


def test_tag_type_name(spark):
    names = many(spark, labels.tag_type_name, [0, 1, 3, 4, 5, 6, None], "int")
    assert names == ["general", "artist", "copyright", "character", "meta", "deprecated", None]
    with pytest.raises(Exception, match="unknown tag type 2"):
        one(spark, labels.tag_type_name, 2, "int")


def test_tag_case_keys(spark):
    assert one(spark, text.tag_case_keys, "\\It's") == ["It&#039;s", "it's", "IT'S", "It's"]


def test_safe_filename(spark):
    rows = spark.createDataFrame([(7, "http://x/y.gif"), (8, "http://x/y.png")], "id bigint, u string")
    names = rows.select(media.safe_filename(F.col("u"), F.col("id"), (".gif",)).alias("n")).collect()
    assert [row["n"] for row in names] == [None, "8.png"]


def test_shard_path_of_negative_id(spark):
    path = lambda v: media.shard_path(v, F.lit("jpg"))
    assert one(spark, path, 1234, "bigint") == "34/1234.jpg"


def test_target_ext(spark):
    ext = lambda v: media.target_ext(v, F.lit("own"))
    assert many(spark, ext, ["http://a.b/c.png", "nodot", None]) == ["png", "own", "own"]


def test_substring_and_token_matching_differ(spark):
    assert one(spark, lambda v: text.contains_any(v, ["3d"]), "x_3dcg y") is True
    assert one(spark, lambda v: text.has_any_token(v, ["3d"]), "x_3dcg y") is False
    assert one(spark, lambda v: text.contains_any(v, []), "a") is False


WORDS = st.text(st.characters(codec="utf-8", exclude_characters="\0"), max_size=20)
RELAXED = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


ENTITIES = st.lists(st.one_of(
    st.sampled_from(["&amp;", "&lt", "&notit;", "&notin;", "&", "&#", "&#x", "&;", "&amp", "&Aacute", "&NotEqualTilde;", "x", " ", ";", "&frac12x"]),
    st.integers(0, 0x120000).map(lambda n: f"&#{n};"), st.integers(0, 0x120000).map(lambda n: f"&#X{n:x}"),
    st.sampled_from([f"&#{n};" for n in (0, 1, 8, 11, 12, 13, 31, 127, 128, 129, 159, 160, 0xD800, 0xFDD0, 0xFFFE, 0x1FFFF, 10**30)]),
    st.text("abcdn&;#x1 ", max_size=6),
), max_size=8).map("".join)


@RELAXED
@given(st.lists(ENTITIES, min_size=40, max_size=80))
def test_entities_agree(spark, inputs):
    assert many(spark, text.html_unescape, inputs) == [html.unescape(v) for v in inputs]


@RELAXED
@given(st.lists(WORDS, min_size=1, max_size=40))
def test_python_functions_agree(spark, inputs):
    assert many(spark, text.html_unescape, inputs) == [html.unescape(v) for v in inputs]
    assert many(spark, text.html_escape, inputs) == [html.escape(v) for v in inputs]
    assert many(spark, text.quote_names, inputs) == [urllib.parse.quote(v, safe="") for v in inputs]
    assert many(spark, text.words, inputs) == [v.split() for v in inputs]
    assert many(spark, text.strip, inputs) == [v.strip() for v in inputs]
    assert many(spark, text.split_tags, inputs) == [v.split(" ") for v in inputs]


@pytest.mark.parametrize("artist, general, expected", [
    ("a_b", "x_y z", "artist: a b, x y, z"), ("a b", "x", "artist: a, artist: b, x"), (None, None, ""), ("", "  ", ""),
    ("a", None, "artist: a"), (None, "x\ty", "x, y"), (None, "é_è", "é è"), ("_", "_ x", "artist:  , x"),
    (None, "x, y", "x,, y"),
])
def test_captions(spark, artist, general, expected):
    posts = spark.createDataFrame([(artist, general)], "tag_string_artist string, tag_string_general string")
    assert posts.select(labels.caption(posts.columns)).first()[0] == expected


def test_caption_order_and_plain_tags(spark):
    row = ("a_b", "c", "d", "m", "g_h", "Q", 60, 2020)
    posts = spark.createDataFrame(
        [row],
        "tag_string_artist string, tag_string_character string, tag_string_copyright string, "
        "tag_string_meta string, tag_string_general string, rating string, score bigint, year int",
    )
    assert posts.select(labels.caption(posts.columns)).first()[0] == (
        "artist: a b, character: c, copyright: d, meta: m, g h, rating:questionable, "
        "score:best quality, year:2020"
    )
    plain = spark.createDataFrame([("x_y z", "g")], "tags string, rating string")
    assert plain.select(labels.caption(plain.columns)).first()[0] == "x y, z, rating:general"
