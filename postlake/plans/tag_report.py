"""Refresh the statistics tables, rank new tags and export the names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from postlake.operators import stats
from postlake.sinks.files import export_tag_lists
from postlake.sinks.tables import save_clustered

KINDS = ("character", "general", "artist")


def refresh_stats(spark: SparkSession, prefix: str = "", path: str | None = None) -> None:
    """Replace ``tag_<kind>_stats``, each sorted by first_seen. One pass serves all kinds."""
    everything = stats.tag_stats(
        spark.table(f"{prefix}tag"), spark.table(f"{prefix}post_tag"), spark.table(f"{prefix}post")
    )
    save_clustered(
        everything, ["kind", "first_seen"], f"{prefix}tag_stats",
        f"{path}/tag_stats" if path else None,
    )
    for kind in KINDS:
        name = f"tag_{kind}_stats"
        of_kind = stats.filter_kind(spark.table(f"{prefix}tag_stats"), kind).drop("kind")
        save_clustered(
            of_kind, ["first_seen", "tag_id"], prefix + name, f"{path}/{name}" if path else None
        )


def report(
    spark: SparkSession, start: dt.datetime, min_count: int, out: str, prefix: str = ""
) -> DataFrame:
    """Rank the tags new since ``start`` in all kinds and write their names to ``out``."""
    ranked = stats.filter_stats(spark.table(f"{prefix}tag_stats"), start, min_count)
    export_tag_lists(ranked, out)
    return stats.rank_new_tags(spark.table(f"{prefix}tag_stats"), start, min_count)
