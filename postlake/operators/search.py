"""Posts by tags, by id and by score, and the records built from them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.gather import joined_names, named_entries
from postlake.operators.numbering import dense_positions
from postlake.schemas import ALL_TAG_COLUMNS, LOCAL_WINDOW, TRIMMED_PLAIN_POST, TRIMMED_POST
from postlake.session import cut_lineage

_MASK_BITS = 63


def filter_id_range(df: DataFrame, low: int | None, high: int | None, key: str = "id") -> DataFrame:
    """Inclusive bounds; None and 0 mean no bound."""
    if low:
        df = df.where(F.col(key) >= low)
    if high:
        df = df.where(F.col(key) <= high)
    return df


def filter_id_window(df: DataFrame, post_id: int, size: int = LOCAL_WINDOW) -> DataFrame:
    """The aligned window of ``size`` ids that holds ``post_id``."""
    start = post_id - post_id % size
    return df.where(F.col("id").between(start, start + size - 1))


def filter_min_score(df: DataFrame, minimum: int) -> DataFrame:
    return df.where(F.coalesce(F.col("score"), F.lit(0)) >= minimum)


def post_point_lookup(post: DataFrame, post_id: int) -> DataFrame:
    return post.where(F.col("id") == post_id)


def post_tags_by_id(post_tag: DataFrame, tag: DataFrame, post_id: int) -> DataFrame:
    return (
        post_tag.where(F.col("post_id") == post_id).join(tag, "tag_id").select("kind", "name")
    )


def tag_ids_of(tag: DataFrame, names: list[str]) -> dict[str, list[int]]:
    """Ids of some tag names. A name has one id per kind, so the answer is as small as the query."""
    found: dict[str, list[int]] = {name: [] for name in names}
    rows = tag.where(F.col("name").isin(list(found))).select("name", "tag_id")
    for row in rows.toLocalIterator():
        found[row["name"]].append(row["tag_id"])
    return found


def search_intersect(post_tag: DataFrame, tag: DataFrame, names: list[str]) -> DataFrame:
    """Ids of the posts that carry all of ``names``; a name counts once whatever its kinds.

    The names become tag ids first, so that the scan of a relation sorted by tag skips the rest.
    Each name is a bit, and a post matches when the OR of its bits is full: one partial aggregate
    and one shuffle of the matching rows for any number of names.
    """
    names = list(dict.fromkeys(names))
    if not names:
        raise ValueError("a search needs at least one tag")
    ids = tag_ids_of(tag, names)
    wanted = [tag_id for name in names for tag_id in ids[name]]
    if not all(ids.values()):
        return post_tag.where(F.lit(False)).select("post_id")
    hits = post_tag.where(F.col("tag_id").isin(wanted))
    masks, full = [], F.lit(True)
    for start in range(0, len(names), _MASK_BITS):
        part = names[start : start + _MASK_BITS]
        bit = F.lit(0).cast("bigint")
        for place, name in enumerate(part):
            bit = F.when(F.col("tag_id").isin(ids[name]), F.lit(1 << place).cast("bigint")).otherwise(bit)
        column = f"_mask{start}"
        masks.append(F.bit_or(bit).alias(column))
        full = full & (F.col(column) == F.lit((1 << len(part)) - 1).cast("bigint"))
    return hits.groupBy("post_id").agg(*masks).where(full).select("post_id")


def search_min_score(
    post_tag: DataFrame, tag: DataFrame, post: DataFrame, names: list[str], minimum: int
) -> DataFrame:
    matches = search_intersect(post_tag, tag, names)
    scored = filter_min_score(post, minimum).select(F.col("id").alias("post_id"))
    return matches.join(scored, "post_id", "left_semi")


def _rows_between(ids: DataFrame, start: int, end: int) -> DataFrame:
    """Rows ``start`` to ``end`` in id order: numbered in parallel, so that no size of page or cap
    gathers in one task, and sorted again, as numbered rows come back in no order."""
    placed = dense_positions(ids, ["post_id"], "_at")
    return placed.where(F.col("_at").between(start, end - 1)).drop("_at").orderBy("post_id")


def search_page(ids: DataFrame, page: int, size: int) -> DataFrame:
    """Page ``page`` (from 1) of the matches in id order."""
    return _rows_between(ids, (page - 1) * size, page * size)


def search_all_capped(ids: DataFrame, max_posts: int | None = None) -> DataFrame:
    return _rows_between(ids, 0, max_posts) if max_posts else ids.orderBy("post_id")


_DRAW_BITS = 60


def random_posts(ids: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` matches in random order. Hashing the id makes the draw repeatable under retries.

    The first bits of the hash are a number; a bound on it, from the number of matches, lets a little
    more than ``n`` pass, and only those are written and put in order, in parallel. Where too few pass,
    which is rare, the bound doubles.
    """
    drawn = ids.withColumn("_draw", F.md5(F.concat(F.lit(f"{seed}:"), F.col("post_id").cast("string"))))
    first = F.conv(F.substring("_draw", 1, _DRAW_BITS // 4), 16, 10).cast("bigint")
    total, wanted = ids.count(), n + 5 * math.isqrt(n) + 20
    bound = (wanted << _DRAW_BITS) // total if wanted < total else 1 << _DRAW_BITS
    while True:
        chosen = cut_lineage(drawn.where(first < bound) if bound < 1 << _DRAW_BITS else drawn)
        if bound >= 1 << _DRAW_BITS or chosen.count() >= n:
            break
        bound *= 2
    placed = dense_positions(chosen, ["_draw", "post_id"], "_at")
    return placed.where(F.col("_at") < n).orderBy("_at").select(*ids.columns)


def build_post_dict(post_tag: DataFrame, tag: DataFrame, post: DataFrame) -> DataFrame:
    """One record per post: its fields, one tag string per category and all tags, the categories in
    alphabetical order."""
    strings = [
        F.nullif(joined_names(kind), F.lit("")).alias(column)
        for kind, column in ALL_TAG_COLUMNS.items()
    ]
    tagged = named_entries(post_tag, tag).groupBy(F.col("post_id").alias("id")).agg(*strings)
    every = F.concat_ws(" ", *ALL_TAG_COLUMNS.values()).alias("tag_string")
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ALL_TAG_COLUMNS.values()]
    return post.join(tagged, "id", "left").select(*post.columns, *text, every)


def trim_post(df: DataFrame) -> DataFrame:
    """The fixed columns of a post record, NULL where missing; plain tags give the short form."""
    plain = "tags" in df.columns and "tag_string" not in df.columns
    keep = TRIMMED_PLAIN_POST if plain else TRIMMED_POST
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in keep])


_BITMAP_IDS = 32_768  # bits of a bitmap


def id_window_coverage(post: DataFrame, low: int, high: int, size: int) -> DataFrame:
    """(window, n_posts, missing) for every aligned window that overlaps [low, high].

    ``missing`` lists the ids of the window inside [low, high] that no post has. Ids become bits ahead
    of the shuffle: a bitmap holds as many whole windows as it has room for, and a window above its
    size takes several. An id that repeats a million times costs one bit. Ids are not negative.
    """
    first = low - low % size
    span = size * (_BITMAP_IDS // size) if size <= _BITMAP_IDS else _BITMAP_IDS
    pieces = 1 if size <= _BITMAP_IDS else -(-size // span)
    windows = post.sparkSession.range(first, high + 1, max(size, span)).select(
        F.col("id").alias("_start"), F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("_piece"),
        F.lit(None).cast("bigint").alias("_bit"),
    )
    ids = post.where(F.col("id").between(low, high)).select((F.col("id") - first).alias("_id"))
    into = F.col("_id") % max(size, span)
    bits = ids.select((F.col("_id") - into + first).alias("_start"), F.floor(into / span).cast("int").alias("_piece"), (into % span).alias("_bit"))
    held = windows.unionByName(bits).groupBy("_start", "_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    start = F.col("_start") + F.col("_piece") * span  # of the bitmap
    if pieces == 1:
        parts = held.select(start.alias("_from"), "_bits", F.explode(F.sequence(start, F.least(start + span - size, F.lit(high)), F.lit(size))).alias("window"))
        length = size
    else:
        parts = held.select(start.alias("_from"), "_bits", F.col("_start").alias("window"))
        length = span

    begin = F.col("window") if pieces == 1 else F.col("_from")
    low_id = F.greatest(begin, F.lit(low))
    high_id = F.least(begin + length - 1, F.col("window") + size - 1, F.lit(high))
    inside = F.when(low_id <= high_id, F.sequence(low_id, high_id)).otherwise(F.array().cast("array<bigint>"))

    def unset(post_id: Column) -> Column:
        at = post_id - F.col("_from")
        byte = F.substring(F.col("_bits"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 0

    found = parts.select("window", F.size(inside).cast("bigint").alias("_n"), F.filter(inside, unset).alias("missing"))
    counted = found.select("window", (F.col("_n") - F.size("missing")).alias("n_posts"), "missing")
    if pieces == 1:
        return counted
    ordered = F.sort_array(F.flatten(F.collect_list("missing")))
    return counted.groupBy("window").agg(F.sum("n_posts").alias("n_posts"), ordered.alias("missing"))
