"""Typing free-form tags against the dictionary.

A token is looked up under several spellings, the first that is a key of the dictionary wins. The
distinct tokens are resolved, then their types are brought back to the occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.labels import tag_type_name
from postlake.functions.text import (
    contains_any, entity_apostrophe, html_unescape, split_tags, strip_backslash,
)
from postlake.operators.numbering import batch_lookups
from postlake.operators.skew import BROADCAST_BYTES, join_even, split_by_use
from postlake.schemas import DICTIONARY_BATCH, DICTIONARY_FIELDS, LOOKUP_BATCH
from postlake.session import cut_lineage, shuffle_partitions

# Tokens that a task types and gathers, and how few tasks do so.
TYPED_TOKENS = 500_000
MIN_PARTS = 8


def token_usage(posts: DataFrame, tags: str = "tags") -> DataFrame:
    """(token, n_uses): distinct tokens, the empty token included, with their occurrences."""
    tokens = posts.select(F.explode(split_tags(F.col(tags))).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n_uses"))


def distinct_tagset(posts: DataFrame, tags: str = "tags") -> DataFrame:
    return posts.select(F.explode(split_tags(F.col(tags))).alias("token")).distinct()


def posts_without_tags(posts: DataFrame, tags: str = "tags") -> DataFrame:
    return posts.where(F.col(tags).isNull()).select("id")


def tag_exists(tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Tokens that are a key of the dictionary as they are."""
    return tokens.join(dictionary.select(F.col("key").alias("token")), "token", "left_semi")


def missing_exact(tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    return tokens.join(dictionary.select(F.col("key").alias("token")), "token", "left_anti")


def _spellings(token: Column, as_typed_first: bool) -> Column:
    bare = strip_backslash(token)
    tries = [
        entity_apostrophe(bare), F.lower(bare), F.upper(bare), bare,
        entity_apostrophe(html_unescape(bare)),
    ]
    return F.array_distinct(F.array(*([token] if as_typed_first else []), *tries))


def _look_up(
    tokens: DataFrame, dictionary: DataFrame, as_typed_first: bool, how: str
) -> DataFrame:
    """Distinct tokens with the dictionary row their first known spelling names. A left join keeps
    the tokens without one."""
    carried = [c for c in tokens.columns if c != "token"]
    spellings = _spellings(F.col("token"), as_typed_first)
    tries = tokens.select("token", *carried, F.posexplode(spellings).alias("priority", "key"))
    found = tries.join(dictionary.withColumn("_known", F.lit(True)), "key", how)
    first = F.min_by(F.struct(*DICTIONARY_FIELDS), F.when(F.col("_known"), F.col("priority")))
    return found.groupBy("token", *carried).agg(first.alias("tag")).select(
        "token", *carried, "tag.*"
    )


def resolve_tag_alias(
    tokens: DataFrame, dictionary: DataFrame, as_typed_first: bool = True
) -> DataFrame:
    """Distinct tokens with the dictionary row their first known spelling names.

    ``as_typed_first`` tries the token as it stands before the alias spellings, as typing does;
    fetching decides by the alias spellings alone.
    """
    return _look_up(tokens, dictionary, as_typed_first, "inner")


def missing_tags(tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct tokens none of whose alias spellings is known."""
    spellings = _spellings(F.col("token"), as_typed_first=False)
    tries = tokens.select("token", F.explode(spellings).alias("key"))
    known = dictionary.select("key", F.lit(True).alias("_known"))
    found = tries.join(known, "key", "left").groupBy("token").agg(F.max("_known").alias("_known"))
    return found.where("_known IS NULL").select("token")


def typed_vocabulary(
    posts: DataFrame, dictionary: DataFrame, default: int | None, tags: str = "tags"
) -> DataFrame:
    """(token, n_uses, type) of all tokens of ``posts``, materialised as it is joined more than
    once. Without ``default`` a token that cannot be resolved fails the job."""
    unknown = (
        F.lit(default)
        if default is not None
        else F.raise_error(F.concat(F.lit("tag is not in the dictionary: "), "token")).cast("int")
    )
    known = _look_up(token_usage(posts, tags), dictionary, as_typed_first=True, how="left")
    return cut_lineage(
        known.select("token", "n_uses", F.coalesce("type", unknown).alias("type"))
    )


def _rare_types(posts: DataFrame, often: DataFrame, rare: DataFrame, tags: str, count: int) -> DataFrame:
    """(_key, _rare): the types of the tokens of a post that are in ``rare``, as a map."""
    tokens = posts.select("_key", F.explode(F.array_distinct(split_tags(F.col(tags)))).alias("token"))
    tokens = tokens.join(F.broadcast(often), "token", "left").where("type IS NULL").select("_key", "token")
    uses = rare.agg(F.sum("n_uses")).first()[0]
    parts = max(shuffle_partitions(posts.sparkSession), -(-uses // TYPED_TOKENS))
    known = rare.select("token", "type").repartition(parts, "token").hint("shuffle_hash")
    found = tokens.repartition(parts, "token").join(known, "token").select("_key", "token", "type")
    types = F.map_from_entries(F.collect_set(F.struct("token", "type")))
    return found.repartition(count, "_key").groupBy("_key").agg(types.alias("_rare"))


def _typed_posts(
    posts: DataFrame, dictionary: DataFrame, default: int | None, tags: str, carry: list[str],
    kept: tuple[str, ...] = ("token", "type"), limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(_rec, _typed): every post with a tag string by itself, as ids may be NULL or repeat; the columns
    of ``carry`` and its tokens in order as (pos, ``kept``).

    A post moves once, as it is, to a task of few posts that takes it apart and gathers its tokens again.
    The types of tokens are broadcast up to ``limit``, of the most used ones if they are more. The others
    join their types by token and follow the post by its hash: each is rare, so no key is hot. Posts may share
    a hash, as a type hangs on its token alone; four bytes move less.
    """
    vocabulary = typed_vocabulary(posts, dictionary, default, tags)
    count = max(MIN_PARTS, -(-(vocabulary.agg(F.sum("n_uses")).first()[0] or 0) // TYPED_TOKENS))
    often, rare = split_by_use(vocabulary, "n_uses", limit)
    often = often.select("token", "type")
    # Without rare tokens nothing has to find the post, and any key spreads equal posts.
    key = F.monotonically_increasing_id() if rare is None else F.hash(*dict.fromkeys([*carry, tags]))
    tagged = posts.where(F.col(tags).isNotNull()).withColumn("_key", key)
    placed = tagged.select("_key", F.struct(*carry).alias("_rec"), F.col(tags).alias("_tags")).repartition(count, "_key")
    rare_type = F.lit(None).cast("int")
    if rare is not None:
        placed = placed.join(_rare_types(tagged, often, rare, tags, count).hint("shuffle_hash"), "_key", "left")
        rare_type = F.try_element_at("_rare", F.col("token"))
    tokens = placed.withColumn("_row", F.monotonically_increasing_id()).select(
        "_key", "_row", "_rec", *(["_rare"] if rare is not None else []), F.posexplode(split_tags(F.col("_tags"))).alias("pos", "token")
    )
    tokens = tokens.select(
        "_key", "_row", F.when(F.col("pos") == 0, F.col("_rec")).alias("_rec"), "pos", "token", rare_type.alias("_type")
    )
    typed = tokens.join(F.broadcast(often), "token", "left").withColumn("type", F.coalesce("type", "_type"))
    entries = F.sort_array(F.collect_list(F.struct("pos", *kept))).alias("_typed")
    return typed.groupBy("_key", "_row").agg(F.any_value("_rec", F.lit(True)).alias("_rec"), entries).select("_rec", "_typed")


def tag_types(
    posts: DataFrame, dictionary: DataFrame, default: int | None = None, tags: str = "tags"
) -> DataFrame:
    """(id, types): a row per post with tags, the type of every token in token order."""
    typed = _typed_posts(posts, dictionary, default, tags, ["id"], kept=("type",))
    return typed.select("_rec.id", F.col("_typed.type").alias("types"))


def tag_types_verbose(
    posts: DataFrame, dictionary: DataFrame, default: int | None = None, tags: str = "tags"
) -> DataFrame:
    types = tag_types(posts, dictionary, default, tags)
    return types.select("id", F.transform("types", tag_type_name).alias("types"))


def structured_tags(
    posts: DataFrame, dictionary: DataFrame, default: int | None = None, tags: str = "tags"
) -> DataFrame:
    """(id, type, tags): for each post the tokens of each type, order and repeats kept."""
    typed = _typed_posts(posts, dictionary, default, tags, ["id"])
    grouped = typed.select("_rec.id", "_typed", F.explode(F.array_distinct("_typed.type")).alias("_code"))
    of_type = F.filter("_typed", lambda entry: entry["type"] == F.col("_code"))["token"]
    return grouped.select("id", tag_type_name(F.col("_code")).alias("type"), of_type.alias("tags"))


def tag_lists(
    posts: DataFrame, dictionary: DataFrame, columns: dict[str, int], default: int | None = None,
    tags: str = "tags", carry: tuple[str, ...] = ("id",),
) -> DataFrame:
    """The columns of ``carry`` and one array per column of ``columns``: the tokens of the type it stands
    for, each post by itself. Posts without tags have empty arrays."""
    typed = _typed_posts(posts, dictionary, default, tags, list(carry))

    def of(code: int) -> Column:
        return F.filter("_typed", lambda entry: entry["type"] == code)["token"]

    tagged = typed.select(*[F.col("_rec")[c].alias(c) for c in carry], *[of(code).alias(name) for name, code in columns.items()])
    none = F.array().cast("array<string>")
    untagged = posts.where(F.col(tags).isNull()).select(*carry, *[none.alias(name) for name in columns])
    return tagged.unionByName(untagged)


def parse_tags(posts: DataFrame, dictionary: DataFrame, tags: str = "tags") -> DataFrame:
    """(post_id, pos, token, dictionary row) for the tokens that resolve."""
    usage = token_usage(posts, tags)
    known = cut_lineage(resolve_tag_alias(usage, dictionary, as_typed_first=False))
    placed = posts.select(
        F.col("id").alias("post_id"), F.posexplode(split_tags(F.col(tags))).alias("pos", "token")
    )
    return join_even(placed, known, ["token"], F.xxhash64("post_id", "pos"), "n_uses")


def tokens_to_look_up(
    posts: DataFrame, words: list[str], dictionary: DataFrame, tags: str = "tags"
) -> DataFrame:
    """Unknown distinct tokens of the posts whose tag string contains any of ``words``."""
    matching = posts.where(contains_any(F.col(tags), words))
    return missing_tags(distinct_tagset(matching, tags), dictionary)


def lookup_batches_for_posts(
    posts: DataFrame, words: list[str], dictionary: DataFrame, size: int = DICTIONARY_BATCH,
    tags: str = "tags",
) -> DataFrame:
    tokens = tokens_to_look_up(posts, words, dictionary, tags)
    return batch_lookups(tokens.withColumnRenamed("token", "name"), size)


def missing_batches(
    posts: DataFrame, dictionary: DataFrame, size: int = LOOKUP_BATCH, tags: str = "tags"
) -> DataFrame:
    """Tokens of all posts that are no key of the dictionary, in batches to look up."""
    tokens = missing_exact(distinct_tagset(posts, tags), dictionary)
    return batch_lookups(tokens.withColumnRenamed("token", "name"), size)
