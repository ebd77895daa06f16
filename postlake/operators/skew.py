"""An equi join that stays even when one key holds a large share of the rows."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.session import shuffle_partitions

# A key is hot when it holds more rows than a partition should: a share of 1/n for n partitions. There
# are fewer than n hot keys however large the data is, which bounds the broadcast of the hot keys; no
# more than MOST_HOT are told apart.
MOST_HOT = 10_000

# Raw bytes up to which a dimension is broadcast; measured, never assumed.
BROADCAST_BYTES = 64 << 20


def _row_bytes(df: DataFrame) -> Column:
    width = F.lit(0)
    for name, kind in df.dtypes:
        width = width + (F.octet_length(name) if kind == "string" else F.lit(8))
    return F.coalesce(width, F.lit(8))


def raw_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``, from one aggregate over it."""
    return df.agg(F.sum(_row_bytes(df)).cast("bigint")).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return raw_bytes(df) <= limit


def split_by_use(
    dimension: DataFrame, weight: str, limit: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``dimension`` to broadcast, and the others, None if all take up to ``limit``. If they take more, a
    quarter of it goes to those with the largest ``weight``, which hold most uses. The weights are told apart by
    their powers of two, of which there are few."""
    power = F.length(F.bin(weight))
    sums = dimension.groupBy(power.alias("_power")).agg(F.sum(_row_bytes(dimension.drop(weight))).cast("bigint").alias("_bytes"))
    by_power = sums.orderBy(F.desc("_power")).collect()
    if sum(row["_bytes"] for row in by_power) <= limit:
        return dimension, None
    held = list(itertools.accumulate(row["_bytes"] for row in by_power))
    fitting = [row["_power"] for row, size in zip(by_power, held) if size <= limit // 4]
    often = power >= fitting[-1] if fitting else F.lit(False)
    return dimension.where(often), dimension.where(~often)


def hot_keys(dimension: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Keys of ``dimension`` whose ``weight`` (rows they match) exceeds a partition's share of the sum,
    with ``_salts``: how many partitions' worth of rows they hold."""
    parts = min(shuffle_partitions(dimension.sparkSession), MOST_HOT)
    share = dimension.agg(F.sum(weight) / parts).scalar()
    salts = F.ceil(F.col(weight) / share).cast("int").alias("_salts")
    return dimension.where(F.col(weight) > share).select(*on, salts)


def join_even(
    facts: DataFrame, dimension: DataFrame, on: list[str], spread: Column,
    weight: str | None = None, how: str = "inner", limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` to ``dimension``, which holds each key once.

    A dimension measured below ``limit`` is broadcast. Above it, rows of a hot key are spread over
    as many salts as it fills partitions by ``spread`` (a deterministic hash, so that a task run again
    after a loss sends its rows to the same places) and the hot key is repeated once per salt. ``weight`` names
    a column of the dimension that holds the rows each key matches; without it they are counted. The shuffled
    join hashes the dimension, so the facts stream past it and are never sorted.
    """
    values = dimension.drop(weight) if weight else dimension
    if fits_broadcast(values, limit):
        return facts.join(F.broadcast(values), on, how)
    if weight:
        weighted = dimension.select(*on, weight)
    else:
        weight = "_rows"
        weighted = facts.groupBy(*on).agg(F.count(F.lit(1)).alias(weight))
    hot = F.broadcast(hot_keys(weighted, on, weight))
    salt = F.when(F.col("_salts") > 0, F.pmod(spread, F.col("_salts")).cast("int")).otherwise(F.lit(0))
    salted = facts.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    repeated = values.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted.join(repeated.hint("shuffle_hash"), [*on, "_salt"], how).drop("_salt")
