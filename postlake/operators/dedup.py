"""Keep-first and keep-last per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.search import filter_id_range


def dedup_rank(df: DataFrame, key: list[str], order: list, rank: str = "rank") -> DataFrame:
    """Number the rows of each key in ``order``. Followed by a filter on a small rank, Spark drops
    all but that many rows per key before the shuffle, so a hot key stays small."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    return dedup_rank(df, key, order, "_rank").where("_rank = 1").drop("_rank")


def dedup_by_id(df: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """First row per non-null key; rows without a key are all kept.

    ``order`` names columns that are unique together. They also keep apart the rows without a key,
    which so spread over all partitions, and the input is read once.
    """
    if key not in df.columns:
        return df
    apart = F.when(F.col(key).isNull(), F.struct(*order))
    marked = df.withColumn("_apart", apart)
    return keep_first(marked, [key, "_apart"], order).drop("_apart")


def dedup_one_null(df: DataFrame, order: list, key: str = "id") -> DataFrame:
    """First row per key where NULL is a key of its own."""
    return keep_first(df, [key], order)


def merge_bulk_windows(
    windows: list[DataFrame], low: int | None, high: int | None, order: list
) -> DataFrame:
    """Union of fetched id windows clipped to [low, high], each id once. A frame may hold many
    windows; they may overlap."""
    merged = windows[0]
    for window in windows[1:]:
        merged = merged.unionByName(window)
    return dedup_one_null(filter_id_range(merged, low, high), order)
