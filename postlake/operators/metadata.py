"""Normalised metadata of posts that carry one plain tag string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.media import after_last_dot
from postlake.functions.times import parse_rfc_wallclock
from postlake.operators.tagging import tag_lists

# The fields of a metadata record in order, and the dictionary type of each list.
FIELDS = (
    "id", "created_at", "score", "width", "height", "md5", "image_ext", "rating", "source",
    "tags", "title", "file_url", "has_children", "parent_id",
)
LISTS = {
    "tag_list_general": 0,
    "tag_list_artist": 1,
    "tag_list_character": 4,
    "tag_list_meta": 5,
    "tag_list_copyright": 3,
}


def normalize_metadata(posts: DataFrame) -> DataFrame:
    """The 14 fields of a record; a table cannot tell an absent key from NULL, so both default."""

    def field(name: str, default=None) -> Column:
        if name not in posts.columns:
            return F.lit(default)
        return F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default))

    special = {
        "created_at": parse_rfc_wallclock(field("created_at")),
        "image_ext": after_last_dot(field("image")),
        "source": field("source", ""),
        "title": field("title", ""),
        "has_children": field("has_children", "false"),
        "parent_id": field("parent_id", 0),
    }
    return posts.select(*[special.get(name, field(name)).alias(name) for name in FIELDS])


def structured_metadata(
    posts: DataFrame, dictionary: DataFrame, default: int | None = None
) -> DataFrame:
    """The record with one tag list per type instead of ``tags``; deprecated tags are dropped."""
    kept = tuple(c for c in FIELDS if c != "tags")
    return tag_lists(normalize_metadata(posts), dictionary, LISTS, default, carry=kept)
