"""Schemas and fixed values of the data model."""

from __future__ import annotations

# --- Fixed values: column names and types of the input and derived tables -------------------
POST_FIELDS = {
    "id": "BIGINT",
    "created_at": "STRING",
    "score": "BIGINT",
    "source": "STRING",
    "rating": "STRING",
    "image_width": "BIGINT",
    "image_height": "BIGINT",
    "tag_string": "STRING",
    "fav_count": "BIGINT",
    "file_ext": "STRING",
    "up_score": "BIGINT",
    "down_score": "BIGINT",
    "is_deleted": "BOOLEAN",
    "pixiv_id": "BIGINT",
    "tag_string_general": "STRING",
    "tag_string_character": "STRING",
    "tag_string_artist": "STRING",
    "tag_string_copyright": "STRING",
    "tag_string_meta": "STRING",
    "file_url": "STRING",
    "large_file_url": "STRING",
    "preview_file_url": "STRING",
}

TAG_COLUMNS = {
    "general": "tag_string_general",
    "character": "tag_string_character",
    "artist": "tag_string_artist",
    "copyright": "tag_string_copyright",
    "meta": "tag_string_meta",
}

ALL_TAG_COLUMNS = {
    "artist": "tag_string_artist",
    "character": "tag_string_character",
    "copyright": "tag_string_copyright",
    "general": "tag_string_general",
    "meta": "tag_string_meta",
}

TRIMMED_POST = (
    "id", "created_at", "file_url", "rating", "score", "tag_string", "tag_string_artist",
    "tag_string_character", "tag_string_copyright", "tag_string_meta", "tag_string_general",
)
TRIMMED_PLAIN_POST = ("id", "created_at", "file_url", "rating", "score", "tags")

DICTIONARY_FIELDS = {
    "id": "BIGINT",
    "name": "STRING",
    "count": "BIGINT",
    "type": "INT",
    "ambiguous": "INT",
}

VARIANT_FIELDS = {
    "type": "STRING",
    "url": "STRING",
    "width": "BIGINT",
    "height": "BIGINT",
    "file_ext": "STRING",
}

TAG_TYPE_NAMES = {
    0: "general",
    1: "artist",
    3: "copyright",
    4: "character",
    5: "meta",
    6: "deprecated",
}

RATING_NAMES = {"g": "general", "s": "sensitive", "q": "questionable", "e": "explicit"}

VIDEO_EXTENSIONS = ("webm", "mp4", "mov", "avi")
ARCHIVE_EXTENSIONS = ("zip",)
EXCLUDED_SUFFIXES = (".webm", ".mp4", ".gif", ".zip")
BANNED_WORDS = ("animated", "video", "3d", "photo_(medium)", "real_life")
SHARDS = 100
LOOKUP_BATCH = 99
DICTIONARY_BATCH = 100
REMOTE_WINDOW = 20
LOCAL_WINDOW = 100
MAX_FILE_SIZE = 30_000_000
# --------------------------------------------------------------------------------------------


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())
