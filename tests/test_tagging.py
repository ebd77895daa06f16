"""The dictionary, tag typing and metadata against a plain Python model."""

import html
import json
import os

import pytest
from pyspark.sql import functions as F

from postlake.operators import metadata, skew, tagging
from postlake.plans.dictionary_refresh import refresh
from postlake.sinks import files
from postlake.sources import dictionary
from tests.conftest import plan_of, values

LINES = [
    {"id": 1, "name": "red", "count": 5, "type": 0, "ambiguous": 0},
    {"id": 2, "name": "head_on_another&#039;s_shoulder", "count": 1, "type": 0, "ambiguous": 0},
    {"id": 3, "name": "takagi-san", "count": 1, "type": 4, "ambiguous": 0},
    {"id": 4, "name": "type_95_(girls&#039;_frontline)", "count": 1, "type": 4, "ambiguous": 0},
    {"id": 5, "name": "m.m", "count": 1, "type": 1, "ambiguous": 0},
    {"id": 6, "name": "UPPER", "count": 1, "type": 3, "ambiguous": 0},
    {"id": 7, "name": "a&b", "count": 1, "type": 5, "ambiguous": 0},
    {"id": 8, "name": "red", "count": 9, "type": 5, "ambiguous": 1},
    {"id": 9, "name": "it's", "count": 1, "type": 1, "ambiguous": 0},
    {"id": 10, "name": "old", "count": 1, "type": 6, "ambiguous": 0},
    {"id": 11, "name": "a&amp;b", "count": 1, "type": 3, "ambiguous": 0},
]
TOKENS = [
    "red", "RED", "\\red", "head_on_another's_shoulder", "takagi-san", "type_95_(girls'_frontline)", "m.m",
    "upper", "Upper", "a&b", "a&amp;b", "A&B", "it's", "It's", "it&#x27;s", "it&#39;s", "old", "nope", "", "\\",
    "head_on_another&#39;s_shoulder",
]


def write_lines(path, lines):
    with open(path, "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


@pytest.fixture
def source(folder):
    os.makedirs(f"{folder}/dict")
    write_lines(f"{folder}/dict/tags.jsonl", [json.dumps(t) for t in LINES] + ['{"id": 5, "name"', ""])
    return f"{folder}/dict"


def model():
    """Keys of the dictionary as the lines are read one after the other."""
    keys = {}
    for tag in LINES:
        for key in (tag["name"], html.escape(tag["name"])):
            keys[key] = tag
    return keys


def lookup(keys, token, as_typed_first=True):
    bare = token.removeprefix("\\")
    entity = lambda t: t.replace("'", "&#039;")
    tries = [entity(bare), bare.lower(), bare.upper(), bare, entity(html.unescape(bare))]
    for key in ([token] if as_typed_first else []) + tries:
        if key in keys:
            return keys[key]
    return None


def test_dictionary_keys(spark, source):
    got = {r["key"]: (r["id"], r["type"]) for r in dictionary.load_tag_dictionary(spark, source).collect()}
    assert got == {key: (tag["id"], tag["type"]) for key, tag in model().items()}


def test_later_files_win(spark, source):
    write_lines(f"{source}/a_new.jsonl", [json.dumps({**LINES[0], "id": 99})])
    os.utime(f"{source}/a_new.jsonl", (4e9, 4e9))
    rows = dictionary.load_tag_dictionary(spark, source).where("key = 'red'")
    assert rows.first()["id"] == 99


@pytest.mark.parametrize("as_typed_first", [True, False])
def test_alias_rules(spark, source, as_typed_first):
    tokens = spark.createDataFrame([(t,) for t in TOKENS], "token string")
    found = tagging.resolve_tag_alias(tokens, dictionary.load_tag_dictionary(spark, source), as_typed_first)
    got = {r["token"]: r["id"] for r in found.collect()}
    keys = model()
    wanted = {t: lookup(keys, t, as_typed_first) for t in TOKENS}
    assert got == {t: tag["id"] for t, tag in wanted.items() if tag}
    missing = tagging.missing_tags(tokens, dictionary.load_tag_dictionary(spark, source))
    assert {r[0] for r in missing.collect()} == {t for t in TOKENS if not lookup(keys, t, False)}


@pytest.fixture
def posts(spark):
    return spark.createDataFrame(
        [(1, " ".join(TOKENS)), (2, "red  red old"), (3, None), (4, "nope")], "id bigint, tags string"
    )


def test_types_keep_token_order(spark, source, posts):
    tags = dictionary.load_tag_dictionary(spark, source)
    keys = model()
    got = {r["id"]: r["types"] for r in tagging.tag_types(posts, tags, default=0).collect()}
    type_of = lambda t: (lookup(keys, t) or {"type": 0})["type"]
    assert got == {1: [type_of(t) for t in TOKENS], 2: [5, 0, 5, 6], 4: [0]}
    names = {r["id"]: r["types"] for r in tagging.tag_types_verbose(posts, tags, default=0).collect()}
    assert names[2] == ["meta", "general", "meta", "deprecated"]
    lists = {(r["id"], r["type"]): r["tags"] for r in tagging.structured_tags(posts, tags, default=0).collect()}
    assert lists[2, "meta"] == ["red", "red"] and lists[2, "general"] == [""]
    with pytest.raises(Exception, match="tag is not in the dictionary"):
        tagging.tag_types(posts, tags).collect()


def test_posts_are_typed_each_by_itself(spark, source):
    tags = dictionary.load_tag_dictionary(spark, source)
    posts = spark.createDataFrame(
        [(None, "red"), (None, "m.m red"), (7, "old"), (7, "nope old"), (7, None)], "id bigint, tags string"
    )
    typed = tagging.tag_types(posts, tags, default=0).collect()
    assert sorted((str(r["id"]), r["types"]) for r in typed) == [("7", [0, 6]), ("7", [6]), ("None", [1, 5]), ("None", [5])]
    lists = tagging.structured_tags(posts, tags, default=0).collect()
    assert sorted((str(r["id"]), r["type"], r["tags"]) for r in lists) == [
        ("7", "deprecated", ["old"]), ("7", "deprecated", ["old"]), ("7", "general", ["nope"]),
        ("None", "artist", ["m.m"]), ("None", "meta", ["red"]), ("None", "meta", ["red"]),
    ]
    made = metadata.structured_metadata(posts, tags, default=0).collect()
    assert sorted((str(r["id"]), r["tag_list_meta"], r["tag_list_artist"], r["tag_list_general"]) for r in made) == [
        ("7", [], [], []), ("7", [], [], []), ("7", [], [], ["nope"]), ("None", ["red"], [], []), ("None", ["red"], ["m.m"], []),
    ]


AWKWARD = [(None, "red"), (None, "red"), (7, "old nope"), (7, "old nope"), (7, " nope  RED"), (8, ""), (9, None), (10, " ".join(TOKENS * 3))]


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, 300, 0])
def test_types_are_the_same_broadcast_or_not(spark, source, monkeypatch, limit):
    monkeypatch.setattr(tagging._typed_posts, "__defaults__", (("token", "type"), limit))
    monkeypatch.setattr(tagging, "TYPED_TOKENS", 3)
    tags, keys = dictionary.load_tag_dictionary(spark, source), model()
    posts = spark.createDataFrame(AWKWARD, "id bigint, tags string")
    type_of = lambda t: (lookup(keys, t) or {"type": 0})["type"]
    wanted = [(i, [t for t in (text or "").split(" ") if text is not None and type_of(t) == 5], [t for t in (text or "").split(" ") if text is not None and type_of(t) == 0]) for i, text in AWKWARD]
    made = metadata.structured_metadata(posts, tags, default=0)
    assert values(made, "id", "tag_list_meta", "tag_list_general") == sorted(wanted, key=str)
    types = [(i, [type_of(t) for t in text.split(" ")]) for i, text in AWKWARD if text is not None]
    assert values(tagging.tag_types(posts, tags, default=0)) == sorted(types, key=str)
    assert ("_rare" in plan_of(made)) == (limit < skew.BROADCAST_BYTES)
    split = skew.split_by_use(tagging.typed_vocabulary(posts, tags, 0), "n_uses", limit)
    assert [part is not None and not part.isEmpty() for part in split] == [limit > 0, limit < skew.BROADCAST_BYTES]


def test_posts_may_share_a_hash(spark, source, monkeypatch):
    monkeypatch.setattr(tagging._typed_posts, "__defaults__", (("token", "type"), 0))
    tags = dictionary.load_tag_dictionary(spark, source)
    posts = spark.createDataFrame(AWKWARD, "id bigint, tags string")
    wanted = values(tagging.tag_types(posts, tags, default=0))
    monkeypatch.setattr(F, "hash", lambda *columns: F.length(F.coalesce(columns[-1], F.lit(""))) % 2)
    assert values(tagging.tag_types(posts, tags, default=0)) == wanted


def test_tokens_of_a_post_are_gathered_where_it_is_taken_apart(spark, source, posts):
    plan = plan_of(metadata.structured_metadata(posts, dictionary.load_tag_dictionary(spark, source), default=0))
    assert "Exchange" not in plan[plan.index("ObjectHashAggregate"):plan.index("Generate posexplode")]


def test_the_most_used_are_split_off_up_to_a_limit(spark):
    used = spark.sql("SELECT * FROM VALUES ('a', 1, 9L), ('b', 1, 7L), ('c', 1, 2L), ('d', 1, 2L), (NULL, 1, 1L) d(k, v, n)")
    often, rare = skew.split_by_use(used, "n", 43)
    assert values(often, "k") == [("a",)] and values(rare, "k") == [("b",), ("c",), ("d",), (None,)]
    assert skew.split_by_use(used, "n", 44)[1] is None
    assert skew.split_by_use(used, "n", 35)[0].isEmpty() and skew.split_by_use(used, "n", 35)[1].count() == 5


def test_parse_tags(spark, source, posts):
    rows = tagging.parse_tags(posts.where("id = 2"), dictionary.load_tag_dictionary(spark, source))
    assert values(rows, "pos", "token", "id") == [(0, "red", 8), (2, "red", 8), (3, "old", 10)]


def test_batches_for_posts(spark, source, posts):
    tags = dictionary.load_tag_dictionary(spark, source)
    batch = tagging.lookup_batches_for_posts(posts, ["nop"], tags).collect()[0]
    assert batch["names"].split(" ") == sorted(t for t in TOKENS if not lookup(model(), t, False))
    assert tagging.lookup_batches_for_posts(posts, [], tags).count() == 0


def test_metadata(spark, source):
    row = {
        "id": 1, "created_at": "Sun Nov 05 11:30:58 -0600 2023", "score": 2, "image": "x.y.png",
        "tags": "red old takagi-san red nope",
    }
    posts = spark.createDataFrame(
        [tuple(row.values())], "id bigint, created_at string, score bigint, image string, tags string"
    )
    plain = metadata.normalize_metadata(posts).first().asDict()
    assert list(plain) == list(metadata.FIELDS)
    assert plain["created_at"] == "2023-11-05 11:30:58" and plain["image_ext"] == "png"
    assert (plain["source"], plain["title"], plain["has_children"], plain["parent_id"]) == ("", "", "false", 0)
    tags = dictionary.load_tag_dictionary(spark, source)
    made = metadata.structured_metadata(posts, tags, default=0).first().asDict()
    assert "tags" not in made
    assert made["tag_list_meta"] == ["red", "red"] and made["tag_list_character"] == ["takagi-san"]
    assert made["tag_list_general"] == ["nope"] and made["tag_list_artist"] == []


def test_compact_and_append(spark, source, folder, posts):
    files.compact_dictionary(spark, source, f"{folder}/v2")
    assert len(values(dictionary.newest_tags(spark, f"{folder}/v2"))) == len({t["name"] for t in LINES})
    new = spark.createDataFrame([(50, "nope", 1, 1, 0)], "id bigint, name string, count bigint, type int, ambiguous int")
    files.append_dictionary(new, f"{folder}/v2")
    tags = dictionary.load_tag_dictionary(spark, f"{folder}/v2")
    assert tags.where("key = 'nope'").first()["id"] == 50
    assert tags.where("key = 'red'").first()["id"] == 8
    batches = refresh(spark, source, f"{folder}/v3", posts)
    got = {t for r in batches.collect() for t in r["names"].split(" ")}
    assert got == {t for t in TOKENS if t not in model()}


def test_expand_aliases_of_live_tags(spark, source):
    tags = dictionary.read_tags(spark, source).where("id = 6")
    assert values(dictionary.expand_aliases(tags, lower=True), "key") == [("UPPER",), ("upper",)]
    assert values(dictionary.expand_aliases(tags), "key") == [("UPPER",)]


def test_posts_without_tags(posts):
    assert values(tagging.posts_without_tags(posts)) == [(3,)]
    assert ("",) in values(tagging.distinct_tagset(posts))
    assert posts.where(F.col("tags").isNull()).count() == 1
