"""Where the media of a post lies and where it is to be stored."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.schemas import SHARDS


def after_last_dot(text: Column) -> Column:
    """Text after the last dot; text without a dot as it is."""
    return F.substring_index(text, ".", -1)


def url_suffix(url: Column) -> Column:
    """Suffix of the last path segment with its dot, or the empty string."""
    return F.regexp_extract(url, r"[^/](\.[^./]+)/*$", 1)


def safe_filename(url: Column, post_id: Column, excluded: Iterable[str] = ()) -> Column:
    """``<id><suffix>``, or NULL when the suffix is excluded."""
    suffix = url_suffix(url)
    name = F.concat(post_id.cast("string"), suffix)
    banned = list(excluded)
    return F.when(~suffix.isin(*banned), name) if banned else name


def shard_of(post_id: Column, shards: int = SHARDS) -> Column:
    return F.pmod(post_id, F.lit(shards).cast("bigint"))


def shard_path(post_id: Column, ext: Column, shards: int = SHARDS) -> Column:
    return F.concat(
        shard_of(post_id, shards).cast("string"), F.lit("/"),
        post_id.cast("string"), F.lit("."), ext,
    )


def window_start(post_id: Column, size: int) -> Column:
    return post_id - F.pmod(post_id, F.lit(size).cast("bigint"))


def media_target(large_url: Column, url: Column) -> Column:
    return F.coalesce(large_url, url)


def post_target(columns: Iterable[str]) -> Column:
    """The target of a post with these columns: the large URL where there is one, else the plain one."""
    return media_target(F.col("large_file_url"), F.col("file_url")) if "large_file_url" in columns else F.col("file_url")


def post_ext(columns: Iterable[str]) -> Column:
    """The extension of a post with these columns: its own, else that of the stored image's name."""
    own = [F.col("file_ext")] if "file_ext" in columns else []
    image = [after_last_dot(F.col("image"))] if "image" in columns else []
    return F.coalesce(*own, *image, F.lit(None).cast("string"))


def target_ext(target: Column, own_ext: Column) -> Column:
    """Extension the target ends in; a target without a dot leaves the post's own extension."""
    return F.when(target.contains("."), after_last_dot(target)).otherwise(own_ext)


def variant_lookup(variants: Column, matches) -> Column:
    """First variant for which ``matches`` holds, or NULL."""
    return F.get(F.filter(variants, matches), 0)


def original_variant(variants: Column, target: Column, ext: Column) -> Column:
    """``struct(url, ext, reason)`` of the media to take when only originals are wanted.

    Without variants the target stays. A post whose variants hold no original is rejected, as is
    one whose original is narrower or shorter than the variant the target names.
    """
    named = variant_lookup(variants, lambda v: v["url"] == target)
    original = variant_lookup(variants, lambda v: v["type"] == "original")
    smaller = (original["width"] < named["width"]) | (original["height"] < named["height"])
    reason = (
        F.when(original.isNull(), "no_original")
        .when(named.isNotNull() & smaller, "original_smaller")
    )
    has_variants = F.coalesce(F.size(variants) > 0, F.lit(False))
    return F.struct(
        F.when(has_variants, original["url"]).otherwise(target).alias("url"),
        F.when(has_variants, original["file_ext"]).otherwise(ext).alias("ext"),
        F.when(has_variants, reason).alias("reason"),
    )
