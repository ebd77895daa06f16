"""Names of the tags of a post, gathered into strings in name order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.skew import join_even

# Holds the repeats of a name together; it sorts before all characters a tag may have.
_GLUE = "\0"


def named_entries(post_tag: DataFrame, tag: DataFrame) -> DataFrame:
    """(post_id, kind, entry): the tags of each post, repeats of a tag counted into one entry.

    Repeats are counted ahead of the shuffle; a relation bucketed on the post id needs none. Tags of
    posts without an id belong to no record and are left out. ``tag`` may carry ``n_uses``, which saves
    a count when the tags are too many to broadcast.
    """
    counted = post_tag.where("post_id IS NOT NULL").groupBy("post_id", "tag_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    weight = "n_uses" if "n_uses" in tag.columns else None
    named = join_even(counted, tag, ["tag_id"], F.xxhash64("post_id"), weight)
    entry = F.when(F.col("n") == 1, F.col("name")).otherwise(
        F.array_join(F.array_repeat("name", F.col("n")), _GLUE)
    )
    return named.select("post_id", "kind", entry.alias("entry"))


def joined_names(kind: str | None = None) -> Column:
    """Aggregate: the names of a group in order, joined by a space; the empty string for none."""
    entry = F.col("entry") if kind is None else F.when(F.col("kind") == kind, F.col("entry"))
    joined = F.array_join(F.sort_array(F.collect_list(entry)), " ")
    return F.replace(joined, F.lit(_GLUE), F.lit(" "))
