"""Caption pieces and the caption of a post."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import joined_words, strip, words
from postlake.schemas import RATING_NAMES, TAG_TYPE_NAMES

# The order of the tag pieces in a caption and their labels.
_LABELLED = (
    ("tag_string_artist", "artist: "),
    ("tag_string_character", "character: "),
    ("tag_string_copyright", "copyright: "),
    ("tag_string_meta", "meta: "),
    ("tag_string_general", ""),
)

_ONLY_UNDERSCORES = r"(?<![^\s])_+(?![^\s])"


def _lookup(names: dict) -> Column:
    return F.create_map(*[F.lit(item) for pair in names.items() for item in pair])


def rating_label(rating: Column) -> Column:
    """``g`` to ``rating:general`` and so on; other text as it is; empty or NULL to NULL."""
    code = F.lower(rating)
    named = F.coalesce(F.try_element_at(_lookup(RATING_NAMES), code), code)
    return F.when(code != "", F.concat(F.lit("rating:"), named))


def score_quality(score: Column) -> Column:
    return (
        F.when(score > 100, "masterpiece")
        .when(score > 50, "best quality")
        .when(score < 0, "worst quality")
        .otherwise("")
    )


def score_label(score: Column) -> Column:
    quality = score_quality(score)
    return F.when(score.isNotNull() & (quality != ""), F.concat(F.lit("score:"), quality))


def year_label(year: Column) -> Column:
    set_year = year.isNotNull() & ~year.cast("string").isin("", "0")
    return F.when(set_year, F.concat(F.lit("year:"), year.cast("string")))


def label_tags(tags: Column, label: str = "") -> Column:
    """One labelled piece per tag, underscores shown as spaces."""
    return F.transform(
        words(tags),
        lambda tag: F.concat(F.lit(label), F.replace(tag, F.lit("_"), F.lit(" "))),
    )


def plain_tags_piece(tags: Column) -> Column:
    """All tags as one piece, for posts whose tags are not split by category."""
    return F.replace(F.replace(tags, F.lit(" "), F.lit(", ")), F.lit("_"), F.lit(" "))


def _tags_piece(tags: Column, label: str) -> Column:
    """All labelled tags of a category in one string; NULL if there are none."""
    if not label:  # a tag of nothing but underscores would be shown as a blank, which is no piece
        tags = F.when(tags.rlike(_ONLY_UNDERSCORES), F.regexp_replace(tags, _ONLY_UNDERSCORES, "")
                      ).otherwise(tags)
    shown = F.replace(joined_words(tags, f", {label}"), F.lit("_"), F.lit(" "))
    return F.concat(F.lit(label), shown) if label else shown


def caption(columns: Collection[str]) -> Column:
    """The caption of a post that has ``columns``; columns it lacks add no piece."""
    pieces = []
    if "tag_string_character" not in columns and "tags" in columns:
        plain = plain_tags_piece(F.col("tags"))
        pieces.append(F.when(strip(plain) != "", plain))
    for name, label in _LABELLED:
        if name in columns:
            pieces.append(_tags_piece(F.col(name), label))
    for name, piece in (("rating", rating_label), ("score", score_label), ("year", year_label)):
        if name in columns:
            pieces.append(piece(F.col(name)))
    return F.replace(F.concat_ws(", ", *pieces), F.lit(", ,"), F.lit(", "))


def tag_type_name(code: Column) -> Column:
    """Name of a dictionary tag type; an unknown type fails the job."""
    unknown = F.raise_error(F.concat(F.lit("unknown tag type "), code.cast("string")))
    named = F.try_element_at(_lookup(TAG_TYPE_NAMES), code)
    return F.when(code.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(named, unknown.cast("string"))
    )
