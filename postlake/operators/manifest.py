"""Which media to fetch, where it goes, why a post is skipped, and what is already stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.media import (
    original_variant, post_ext, post_target, safe_filename, shard_path, target_ext,
)
from postlake.functions.text import contains_any, has_any_token
from postlake.schemas import (
    ARCHIVE_EXTENSIONS, BANNED_WORDS, EXCLUDED_SUFFIXES, MAX_FILE_SIZE, VIDEO_EXTENSIONS,
)


def filter_extensions(
    df: DataFrame, url: str = "file_url", excluded: Sequence[str] = EXCLUDED_SUFFIXES
) -> DataFrame:
    """Drop posts whose URL ends in an excluded suffix; others get their file name."""
    name = safe_filename(F.col(url), F.col("id"), excluded)
    return df.withColumn("file_name", name).where("file_name IS NOT NULL")


def filter_video(df: DataFrame, ext: str = "ext", archives: bool = True) -> DataFrame:
    banned = VIDEO_EXTENSIONS + (ARCHIVE_EXTENSIONS if archives else ())
    return df.where(~F.coalesce(F.col(ext).isin(*banned), F.lit(False)))


def filter_banned_substring(
    df: DataFrame, tags: str = "tags", words: Sequence[str] = BANNED_WORDS
) -> DataFrame:
    return df.where(~F.coalesce(contains_any(F.col(tags), words), F.lit(False)))


def _by_uploader(owner: str, creator: int) -> Column:
    return F.coalesce(
        (F.col("owner") == owner) | (F.coalesce("creator_id", F.lit(0)) == creator), F.lit(False)
    )


def filter_uploader(
    df: DataFrame, owner: str, creator: int, exempt: Sequence[str], tags: str = "tags"
) -> DataFrame:
    """Drop posts of one uploader unless they carry an exempt tag."""
    kept = F.coalesce(has_any_token(F.col(tags), exempt), F.lit(False))
    return df.where(kept | ~_by_uploader(owner, creator))


def filter_max_size(
    df: DataFrame, exempt: Sequence[str], cap: int = MAX_FILE_SIZE, tags: str = "tags",
    size: str = "size",
) -> DataFrame:
    kept = F.coalesce(has_any_token(F.col(tags), exempt), F.lit(False))
    return df.where(kept | F.coalesce(F.col(size) <= cap, F.lit(True)))


def filter_missing_target(df: DataFrame, url: str = "file_url") -> DataFrame:
    return df.where(F.col("id").isNotNull() & F.col(url).isNotNull() & (F.col(url) != ""))


def media_manifest(
    posts: DataFrame,
    *,
    originals_only: bool = False,
    archives: bool = True,
    banned_words: Sequence[str] = (),
    uploader: tuple[str, int] | None = None,
    exempt: Sequence[str] = (),
    max_size: int | None = None,
    tags: str = "tag_string",
) -> DataFrame:
    """(id, target, ext, path, skip_reason) per post in one pass over its row.

    Posts need ``id`` and ``file_url``; ``large_file_url``, ``file_ext`` and ``image`` count where they
    are there. ``skip_reason`` is the first rule hit of: banned tag, uploader, variants, video, no target,
    size; NULL for a post to fetch. A rule without a parameter is off.
    """
    never = F.lit(False)
    target, own_ext = post_target(posts.columns), post_ext(posts.columns)
    chosen = F.struct(target.alias("url"), own_ext.alias("ext"), F.lit(None).cast("string").alias("reason"))
    if originals_only:
        chosen = original_variant(F.col("variants"), target, own_ext)
    spared = has_any_token(F.col(tags), exempt) if exempt else never
    spared = F.coalesce(spared, never)
    banned = contains_any(F.col(tags), banned_words) if banned_words else never
    uploaded = _by_uploader(*uploader) if uploader else never
    too_large = F.col("size") > max_size if max_size is not None else never

    picked = posts.withColumn("_m", chosen)
    url = F.col("_m.url")
    video = VIDEO_EXTENSIONS + (ARCHIVE_EXTENSIONS if archives else ())
    ext = target_ext(url, F.col("_m.ext"))
    reason = (
        F.when(banned, "banned_tag")
        .when(uploaded & ~spared, "uploader")
        .when(F.col("_m.reason").isNotNull(), F.col("_m.reason"))
        .when(ext.isin(*video), "video")
        .when(url.isNull() | (url == ""), "no_target")
        .when(too_large & ~spared, "too_large")
    )
    return picked.select(
        "id", url.alias("target"), ext.alias("ext"),
        shard_path(F.col("id"), F.col("_m.ext")).alias("path"), reason.alias("skip_reason"),
    )


def manifest_counts(manifest: DataFrame) -> DataFrame:
    reason = F.coalesce("skip_reason", F.lit("fetch")).alias("skip_reason")
    return manifest.groupBy(reason).agg(F.count(F.lit(1)).alias("n_posts"))


def not_yet_written(posts: DataFrame, output: DataFrame, key: str = "id") -> DataFrame:
    """Posts whose key is not in the output yet. A post without a key is in it if a row without a key
    is equal in every column both have; where they share no other column it never is.

    The keys of the output are merged, never broadcast: well compressed, they look small enough for
    that to the planner, and would be gathered on the driver."""
    shared = [c for c in posts.columns if c in output.columns and c != key]
    written = output.select(key).where(F.col(key).isNotNull()).hint("merge")
    if not shared:
        return posts.join(written, key, "left_anti").select(*posts.columns)
    named = posts.where(F.col(key).isNotNull()).join(written, key, "left_anti")
    whole = F.md5(F.to_json(F.struct(*shared), {"ignoreNullFields": "false"}))
    nameless = output.where(F.col(key).isNull()).select(whole.alias("_whole")).distinct().hint("merge")
    left = posts.where(F.col(key).isNull()).withColumn("_whole", whole).join(nameless, "_whole", "left_anti")
    return named.select(*posts.columns).unionByName(left.select(*posts.columns))


def audit_artifacts(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """(path, id, status) of expected (path, id, size) against stored (path, size) files."""
    expected = manifest.select("path", "id", F.col("size").alias("_wanted"))
    stored = listing.select("path", F.col("size").alias("_stored"))
    status = (
        F.when(F.col("id").isNull(), "unexpected")
        .when(F.col("_stored").isNull(), "missing")
        .when(F.col("_stored") == 0, "empty")
        .when(F.col("_stored") != F.col("_wanted"), "size_mismatch")
        .otherwise("ok")
    )
    return expected.join(stored, "path", "full").select("path", "id", status.alias("status"))
