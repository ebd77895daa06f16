"""Media targets, manifest filters and the audit of stored files."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.functions import media, text
from postlake.operators import manifest, records
from postlake.registry import inputs
from postlake.registry.base import define, query, same_result
from postlake.schemas import EXCLUDED_SUFFIXES
from postlake.sinks import files
from postlake.sources import jsonl
from postlake.sources.media import list_artifacts

BANNED = ["animated", "video", "3d", "photo_(medium)", "real_life", "supp_1"]
WORDS = ["red", "supp_7"]
_TOKENS = "list_has_any(string_split(tags, ' '), ['red', 'supp_7'])"
_EXT = "CASE WHEN contains(target, '.') THEN string_split(target, '.')[-1] ELSE file_ext END"


def _plain(spark, sf_dir):
    return inputs.plain_posts(spark, sf_dir)


@query(
    "media_target",
    f"SELECT id, target, {_EXT} AS ext FROM (SELECT *, coalesce(large_file_url, file_url) AS target FROM post_src)",
    "post_src",
)
def media_target(spark, sf_dir):
    target = media.media_target(F.col("large_file_url"), F.col("file_url"))
    posts = fx.flat_posts(spark, sf_dir).withColumn("target", target)
    return posts.select(
        "id", "target", media.target_ext(F.col("target"), F.col("file_ext")).alias("ext")
    )


define(
    "chosen",
    """SELECT *, CASE WHEN len(variants) > 0 THEN original.url ELSE target END AS picked_url,
  CASE WHEN len(variants) > 0 THEN original.file_ext ELSE file_ext END AS picked_ext,
  CASE WHEN len(variants) > 0 AND original IS NULL THEN 'no_original'
       WHEN len(variants) > 0 AND named IS NOT NULL AND
            (original.width < named.width OR original.height < named.height) THEN 'original_smaller'
       END AS picked_reason
FROM (SELECT *, list_filter(variants, lambda v: v.type = 'original')[1] AS original,
             list_filter(variants, lambda v: v.url = target)[1] AS named FROM variant_posts)""",
    "variant_posts",
)


@query(
    "original_variant",
    "SELECT id, coalesce(picked_url, '') AS url, coalesce(picked_ext, '') AS ext, coalesce(picked_reason, '') AS reason FROM chosen",
    "chosen",
)
def original_variant(spark, sf_dir):
    target = media.media_target(F.col("large_file_url"), F.col("file_url"))
    picked = media.original_variant(F.col("variants"), target, F.col("file_ext"))
    rows = inputs.variant_posts(spark, sf_dir).select("id", picked.alias("m"))
    return rows.select("id", *[
        F.coalesce(F.col(f"m.{c}"), F.lit("")).alias(c) for c in ("url", "ext", "reason")
    ])


@query(
    "safe_filename",
    """SELECT id, coalesce(CASE WHEN suffix NOT IN ('.webm', '.mp4', '.gif', '.zip') THEN '' || id || suffix END, '') AS name
FROM (SELECT id, regexp_extract(file_url, '[^/](\\.[^./]+)/*$', 1) AS suffix FROM post_src)""",
    "post_src",
)
def safe_filename(spark, sf_dir):
    name = media.safe_filename(F.col("file_url"), F.col("id"), EXCLUDED_SUFFIXES)
    return fx.flat_posts(spark, sf_dir).select("id", F.coalesce(name, F.lit("")).alias("name"))


@query("shard_path", "SELECT id, (id % 100) || '/' || id || '.' || file_ext AS path FROM post_src", "post_src")
def shard_path(spark, sf_dir):
    return fx.flat_posts(spark, sf_dir).select(
        "id", media.shard_path(F.col("id"), F.col("file_ext")).alias("path")
    )


@query(
    "filter_extensions",
    "SELECT id, '' || id || '.' || file_ext AS file_name FROM post_src WHERE file_ext NOT IN ('webm', 'mp4', 'gif', 'zip')",
    "post_src",
)
def filter_extensions(spark, sf_dir):
    return manifest.filter_extensions(fx.flat_posts(spark, sf_dir)).select("id", "file_name")


@query(
    "filter_video",
    "SELECT id, file_ext FROM post_src WHERE file_ext NOT IN ('webm', 'mp4', 'mov', 'avi', 'zip')",
    "post_src",
)
def filter_video(spark, sf_dir):
    return manifest.filter_video(fx.flat_posts(spark, sf_dir), "file_ext").select("id", "file_ext")


@query(
    "filter_video_only",
    "SELECT id, file_ext FROM post_src WHERE file_ext NOT IN ('webm', 'mp4', 'mov', 'avi')",
    "post_src",
)
def filter_video_only(spark, sf_dir):
    kept = manifest.filter_video(fx.flat_posts(spark, sf_dir), "file_ext", archives=False)
    return kept.select("id", "file_ext")


_BANNED = " OR ".join(f"contains(tags, '{w}')" for w in BANNED)


@query("filter_banned_substring", f"SELECT id FROM plain WHERE NOT coalesce({_BANNED}, false)", "plain")
def filter_banned_substring(spark, sf_dir):
    return manifest.filter_banned_substring(_plain(spark, sf_dir), words=BANNED).select("id")


@query("match_tag_token", f"SELECT id, coalesce({_TOKENS}, false) AS hit FROM plain", "plain")
def match_tag_token(spark, sf_dir):
    hit = text.has_any_token(F.col("tags"), WORDS)
    return _plain(spark, sf_dir).select("id", F.coalesce(hit, F.lit(False)).alias("hit"))


@query(
    "match_tag_substring",
    "SELECT id, coalesce(contains(tags, 'red') OR contains(tags, 'supp_7'), false) AS hit FROM plain",
    "plain",
)
def match_tag_substring(spark, sf_dir):
    hit = text.contains_any(F.col("tags"), WORDS)
    return _plain(spark, sf_dir).select("id", F.coalesce(hit, F.lit(False)).alias("hit"))


_UPLOADED = "(owner = 'mirror' OR coalesce(creator_id, 0) = 64)"


@query(
    "filter_uploader",
    f"SELECT id, owner FROM plain WHERE coalesce({_TOKENS}, false) OR NOT {_UPLOADED}",
    "plain",
)
def filter_uploader(spark, sf_dir):
    return manifest.filter_uploader(_plain(spark, sf_dir), "mirror", 64, WORDS).select("id", "owner")


@query(
    "filter_max_size",
    f"SELECT id, size FROM plain WHERE coalesce({_TOKENS}, false) OR size <= 30000000",
    "plain",
)
def filter_max_size(spark, sf_dir):
    return manifest.filter_max_size(_plain(spark, sf_dir), WORDS).select("id", "size")


@query(
    "filter_missing_target",
    "SELECT id FROM post_src WHERE large_file_url IS NOT NULL AND id IS NOT NULL",
    "post_src",
)
def filter_missing_target(spark, sf_dir):
    return manifest.filter_missing_target(fx.flat_posts(spark, sf_dir), "large_file_url").select("id")


_OWN_EXT = "CASE WHEN contains(picked_url, '.') THEN string_split(picked_url, '.')[-1] ELSE picked_ext END"
define(
    "variant_manifest",
    f"""SELECT id, picked_url AS target, {_OWN_EXT} AS ext,
  (id % 100) || '/' || id || '.' || picked_ext AS path,
  CASE WHEN picked_reason IS NOT NULL THEN picked_reason
       WHEN {_OWN_EXT} IN ('webm', 'mp4', 'mov', 'avi', 'zip') THEN 'video'
       WHEN picked_url IS NULL OR picked_url = '' THEN 'no_target' END AS skip_reason
FROM chosen""",
    "chosen",
)
define(
    "plain_manifest",
    f"""SELECT id, target, {_EXT} AS ext, (id % 100) || '/' || id || '.' || file_ext AS path, size,
  CASE WHEN {_BANNED} THEN 'banned_tag'
       WHEN {_UPLOADED} AND NOT coalesce({_TOKENS}, false) THEN 'uploader'
       WHEN {_EXT} IN ('webm', 'mp4', 'mov', 'avi') THEN 'video'
       WHEN target IS NULL THEN 'no_target'
       WHEN size > 30000000 AND NOT coalesce({_TOKENS}, false) THEN 'too_large' END AS skip_reason
FROM (SELECT *, file_url AS target FROM plain)""",
    "plain",
)


def _readable(rows):
    return rows.select("id", *[
        F.coalesce(c, F.lit("")).alias(c) for c in ("target", "ext", "path", "skip_reason")
    ])


_READABLE = "id, coalesce(target, '') AS target, coalesce(ext, '') AS ext, coalesce(path, '') AS path, coalesce(skip_reason, '') AS skip_reason"


@query("media_manifest", f"SELECT {_READABLE} FROM variant_manifest", "variant_manifest")
def media_manifest(spark, sf_dir):
    return _readable(manifest.media_manifest(inputs.variant_posts(spark, sf_dir), originals_only=True))


@same_result("media_manifest_raw", "media_manifest")
def media_manifest_raw(spark, sf_dir):
    """The manifest of records as they arrive, their variants below ``media_asset``."""
    posts = inputs.variant_posts(spark, sf_dir)
    asset = F.struct("variants").alias("media_asset")
    lines = posts.select(F.to_json(F.struct("id", "file_ext", "file_url", "large_file_url", asset)).alias("line"))
    recs = records.unwrap_envelope(jsonl.parse_tolerant(lines)).withColumn("variants", records.media_variants())
    flat = records.schema_fixed(recs, carry=["variants"])
    return _readable(manifest.media_manifest(flat, originals_only=True))


def _plain_manifest(spark, sf_dir):
    """Plain posts have neither an extension nor a large URL of their own."""
    return manifest.media_manifest(
        _plain(spark, sf_dir).drop("file_ext", "large_file_url"), archives=False, banned_words=BANNED, uploader=("mirror", 64),
        exempt=WORDS, max_size=30_000_000, tags="tags",
    )


@query("media_manifest_plain", f"SELECT {_READABLE} FROM plain_manifest", "plain_manifest")
def media_manifest_plain(spark, sf_dir):
    return _readable(_plain_manifest(spark, sf_dir))


@query(
    "manifest_counts",
    "SELECT coalesce(skip_reason, 'fetch') AS skip_reason, count(*) AS n_posts FROM plain_manifest GROUP BY 1",
    "plain_manifest",
)
def manifest_counts(spark, sf_dir):
    return manifest.manifest_counts(_plain_manifest(spark, sf_dir))


# Stored files: some expected ones are missing, empty or of another size, some are unexpected.
_STORED = """SELECT CASE WHEN id % 10 = 4 THEN 'old/' || id ELSE path END AS path,
  CASE id % 10 WHEN 2 THEN 0 WHEN 3 THEN size + 1 ELSE size END AS size
FROM {expected} WHERE id % 10 <> 1"""
define("expected_files", "SELECT id, path, size FROM plain_manifest WHERE skip_reason IS NULL", "plain_manifest")
define("stored_files", _STORED.format(expected="expected_files"), "expected_files")


@query(
    "audit_artifacts",
    """SELECT coalesce(e.path, s.path) AS path, coalesce(e.id, -1) AS id,
  CASE WHEN e.path IS NULL THEN 'unexpected' WHEN s.path IS NULL THEN 'missing' WHEN s.size = 0 THEN 'empty'
       WHEN s.size <> e.size THEN 'size_mismatch' ELSE 'ok' END AS status
FROM expected_files e FULL JOIN stored_files s ON e.path = s.path""",
    "stored_files",
)
def audit_artifacts(spark, sf_dir):
    sizes = _plain(spark, sf_dir).select("id", "size")
    expected = _plain_manifest(spark, sf_dir).where("skip_reason IS NULL").join(sizes, "id")
    listing = spark.sql(_STORED.format(expected="{expected}"), expected=expected)
    rows = manifest.audit_artifacts(expected, listing)
    return rows.withColumn("id", F.coalesce("id", F.lit(-1)))


define("small_files", "SELECT id, path, 1 + size % 97 AS size FROM expected_files", "expected_files")
define("kept_files", _STORED.format(expected="small_files"), "small_files")


def _stored_root(spark, sf_dir, expected):
    """Files of the expected sizes in the shared folder, but for those that are missing, empty, of another
    size or elsewhere; written once."""
    root = fx.folder(spark, sf_dir, "stored_media")
    if root not in _stored:
        stored = spark.sql(_STORED.format(expected="{expected}"), expected=expected)
        files.write_media(stored.select("path", F.repeat(F.lit("m"), F.col("size").cast("int")).cast("binary").alias("content")), root)
        _stored.add(root)
    return root


_stored: set[str] = set()


@query(
    "audit_stored_files",
    """SELECT coalesce(e.path, s.path) AS path, coalesce(e.id, -1) AS id,
  CASE WHEN e.path IS NULL THEN 'unexpected' WHEN s.path IS NULL THEN 'missing' WHEN s.size = 0 THEN 'empty'
       WHEN s.size <> e.size THEN 'size_mismatch' ELSE 'ok' END AS status
FROM small_files e FULL JOIN kept_files s ON e.path = s.path""",
    "kept_files",
)
def audit_stored_files(spark, sf_dir):
    """Files written by tasks, listed again and held against the manifest."""
    sizes = _plain(spark, sf_dir).select("id", (1 + F.col("size") % 97).alias("size"))
    expected = _plain_manifest(spark, sf_dir).where("skip_reason IS NULL").join(sizes, "id")
    root = _stored_root(spark, sf_dir, expected)
    rows = manifest.audit_artifacts(expected, list_artifacts(spark, root))
    return rows.withColumn("id", F.coalesce("id", F.lit(-1)))


@query(
    "not_yet_written",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def not_yet_written(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select("doc_id")
    return manifest.not_yet_written(documents, fx.table(spark, sf_dir, "labels"), "doc_id")
