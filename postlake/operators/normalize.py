"""From flat posts to the ``post``, ``tag`` and ``post_tag`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions.text import split_tags
from postlake.functions.times import parse_created_at
from postlake.operators.numbering import assign_tag_ids
from postlake.operators.skew import join_even
from postlake.schemas import TAG_COLUMNS


def post_table(flat: DataFrame) -> DataFrame:
    """The fields of a post that records and statistics need; ``file_url`` is NULL where flat posts
    lack the column."""
    url = F.col("file_url") if "file_url" in flat.columns else F.lit(None).cast("string")
    return flat.select(
        "id", "created_at", "score", "rating", url.alias("file_url"),
        parse_created_at(F.col("created_at")).alias("created_at_utc"),
    )


def tag_tokens(flat: DataFrame, carry: list, kinds: dict[str, str] | None = None) -> DataFrame:
    """One row per non-empty token of every kind: ``carry`` columns, kind, name."""
    kinds = kinds or {k: c for k, c in TAG_COLUMNS.items() if c in flat.columns}
    strings = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.col(c).alias("tags")) for k, c in kinds.items()]
    )
    carried = flat.select(*carry, F.explode(strings).alias("_s"))
    names = [c for c in carried.columns if c != "_s"]
    return (
        carried.select(*names, F.col("_s.kind"), F.explode(split_tags(F.col("_s.tags"))).alias("name"))
        .where("name <> ''")
    )


def distinct_tags_by_kind(flat: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    return tag_tokens(flat, [], kinds).select("kind", "name").distinct()


def tag_usage(flat: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """Distinct (kind, name) with the number of tokens, which costs no more than the distinct."""
    return tag_tokens(flat, [], kinds).groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n_uses"))


def numbered_tags(flat: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """(kind, name, n_uses, tag_id) for all tags of all kinds in one pass."""
    return assign_tag_ids(tag_usage(flat, kinds))


def tag_table(numbered: DataFrame) -> DataFrame:
    return numbered.select("tag_id", "name", "kind")


def build_post_tag(
    flat: DataFrame, numbered: DataFrame, kinds: dict[str, str] | None = None
) -> DataFrame:
    """(post_id, tag_id) per token, repeats kept. ``numbered`` may carry ``n_uses``, which saves
    a count when the dictionary is too large to broadcast. Only its tags of ``kinds`` are measured for that."""
    if kinds:
        numbered = numbered.where(F.col("kind").isin(*kinds))
    tokens = tag_tokens(flat, [F.col("id").alias("post_id")], kinds)
    weight = "n_uses" if "n_uses" in numbered.columns else None
    columns = ["kind", "name", "tag_id", *([weight] if weight else [])]
    joined = join_even(
        tokens, numbered.select(*columns), ["kind", "name"], F.xxhash64("post_id"), weight
    )
    return joined.select("post_id", "tag_id")


def union_tag_frames(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of per-kind (name, kind) frames, then DISTINCT."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged.distinct()
