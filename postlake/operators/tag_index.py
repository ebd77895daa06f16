"""An inverted index of tags: per tag and block of 32,768 post ids, the ids as words of 64 bits.

A search is a filter on tag ids, one AND per word and the ids of the bits that stay. Words without a bit
are not kept: a tag with a third of all posts is a bit per post, a tag on one post a single word. Saved
bucketed on the block, the index is searched without an exchange, and only in blocks that the rarest
tag has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.search import filter_min_score
from postlake.operators.skew import BROADCAST_BYTES, fits_broadcast

BLOCK_IDS = 32_768
_BYTES = BLOCK_IDS // 8
WORD_IDS = 64
INDEX = "tag_id BIGINT, block BIGINT, word INT, bits BIGINT"


def build_tag_index(post_tag: DataFrame, parts: int | None = None) -> DataFrame:
    """(tag_id, block, word, bits): the posts of a tag among the 64 ids of a word of a block.

    Repeats of a tag on a post are one bit. Relations without a post id cannot be found by a search
    and are left out. No tag has more rows than posts, however rare it is. ``parts`` moves the rows to
    that many partitions by block ahead of the grouping, so that a task holds the words of some blocks
    and not those of all its input.
    """
    at = F.bitmap_bit_position("post_id")
    rows = post_tag.where("post_id IS NOT NULL").select(
        "tag_id", F.bitmap_bucket_number("post_id").alias("block"), F.floor(at / WORD_IDS).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % WORD_IDS).cast("int")).alias("bit"),
    )
    rows = rows.repartition(parts, "block") if parts else rows
    return rows.groupBy("tag_id", "block", "word").agg(F.bit_or("bit").alias("bits"))


def save_tag_index(post_tag: DataFrame, name: str, path: str | None = None, buckets: int | None = None) -> None:
    """The index as a table bucketed on the block and sorted by tag: searches skip row groups by tag id
    and AND within a bucket."""
    from postlake.sinks.tables import save_bucketed

    save_bucketed(build_tag_index(post_tag, buckets), "block", name, path, buckets, order=["tag_id", "block", "word"])


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "block BIGINT, word INT, bits BIGINT")


def search_words(index: DataFrame, tag: DataFrame, names: list[str]) -> DataFrame:
    """(block, word, bits): the posts that carry all of ``names``, as words by block; a name counts once
    whatever its kinds.

    Blocks that the rarest name lacks are not read further where the list of its blocks, at most one
    per use, is known to fit a broadcast; the rows are the same either way. ``tag`` may carry
    ``n_uses``, which saves a pass over the index that counts them.
    """
    names = list(dict.fromkeys(names))
    if not names:
        raise ValueError("a search needs at least one tag")
    known = tag.where(F.col("name").isin(names)).select("name", "tag_id", *[c for c in ("n_uses",) if c in tag.columns]).collect()
    ids = {name: [row["tag_id"] for row in known if row["name"] == name] for name in names}
    if not all(ids.values()):
        return _nothing(index.sparkSession)
    place = {tag_id: at for at, name in enumerate(names) for tag_id in ids[name]}
    rows = index.where(F.col("tag_id").isin(list(place)))
    if len(names) > 1:
        if "n_uses" in tag.columns:
            uses = {row["tag_id"]: row["n_uses"] for row in known}
        else:
            uses = {row["tag_id"]: row["n"] for row in rows.groupBy("tag_id").agg(F.sum(F.bit_count("bits")).alias("n")).collect()}
        rarest = min(names, key=lambda name: sum(uses.get(tag_id, 0) for tag_id in ids[name]))
        blocks = index.where(F.col("tag_id").isin(ids[rarest])).select("block").distinct()
        if 8 * sum(uses.get(tag_id, 0) for tag_id in ids[rarest]) <= BROADCAST_BYTES or fits_broadcast(blocks):
            rows = rows.join(F.broadcast(blocks), "block", "left_semi")
    if len(place) == len(names):  # one kind each
        each = rows
    else:
        named = reduce(lambda at, pair: at.when(F.col("tag_id") == pair[0], F.lit(pair[1])), place.items(), F)
        each = rows.groupBy("block", "word", named.alias("_name")).agg(F.bit_or("bits").alias("bits"))
    found = each.groupBy("block", "word").agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("_names"))
    return found.where((F.col("_names") == len(names)) & (F.col("bits") != 0)).drop("_names")


def _places(word: Column, bits: Column) -> Column:
    """The places in their block of the set bits of a word."""
    at = F.filter(F.sequence(F.lit(0), F.lit(WORD_IDS - 1)), lambda bit: F.getbit(bits, bit) == 1)
    return F.transform(at, lambda bit: (word * WORD_IDS + bit).cast("bigint"))


def search_blocks(index: DataFrame, tag: DataFrame, names: list[str]) -> DataFrame:
    """(block, ids, n): the posts that carry all of ``names``, as bitmaps by block; see ``search_words``."""
    found = search_words(index, tag, names).select("block", F.explode(_places(F.col("word"), F.col("bits"))).alias("_place"))
    return found.groupBy("block").agg(F.bitmap_construct_agg("_place").alias("ids"), F.count(F.lit(1)).alias("n"))


def _set_places(bitmap: Column) -> Column:
    """The places of the set bits, in order; bytes without any are passed over first."""
    byte = lambda at: F.substring(bitmap, at + 1, F.lit(1))
    full = F.filter(F.sequence(F.lit(0), F.lit(_BYTES - 1)), lambda at: byte(at) != F.lit(b"\0"))
    value = lambda at: F.conv(F.hex(byte(at)), 16, 10).cast("int")
    places = F.transform(
        full, lambda at: F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(7)), lambda bit: F.when(F.getbit(value(at), bit) == 1, at * 8 + bit)),
            lambda place: place.isNotNull(),
        ),
    )
    return F.flatten(places)


def _id_at(block: Column, place: Column) -> Column:
    """The post id at a place of a block; blocks of ids up to 0 count downwards."""
    return F.when(block > 0, (block - 1) * BLOCK_IDS + place + 1).otherwise(block * BLOCK_IDS - place)


def block_ids(block: Column, bitmap: Column) -> Column:
    """The post ids of a block's bitmap, in order."""
    return F.sort_array(F.transform(_set_places(bitmap), lambda place: _id_at(block, place)))


def post_ids(blocks: DataFrame) -> DataFrame:
    """(post_id) of the bitmaps of ``blocks``."""
    return blocks.select(F.explode(block_ids(F.col("block"), F.col("ids"))).alias("post_id"))


def search_index(index: DataFrame, tag: DataFrame, names: list[str]) -> DataFrame:
    """Ids of the posts that carry all of ``names``."""
    places = search_words(index, tag, names).select("block", F.explode(_places(F.col("word"), F.col("bits"))).alias("_place"))
    return places.select(_id_at(F.col("block"), F.col("_place")).alias("post_id"))


def search_index_min_score(index: DataFrame, tag: DataFrame, post: DataFrame, names: list[str], minimum: int) -> DataFrame:
    scored = filter_min_score(post, minimum).select(F.col("id").alias("post_id"))
    return search_index(index, tag, names).join(scored, "post_id", "left_semi")
