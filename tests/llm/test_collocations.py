import re
from collections import Counter

import numpy as np
import pytest

from postlake.llm import collocations as c


def plain(rows, least, longest=4, share=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (lang, text)."""
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in counts.items() if len(key) > 2 and a >= least}
    out = {}
    for (lang, *words), a in candidates.items():
        inside = (
            100 * other >= share * a for (lang2, *longer), other in candidates.items()
            if lang2 == lang and len(longer) > len(words) and any(longer[i:i + len(words)] == words for i in range(len(longer)))
        )
        if any(inside):
            continue
        cuts = [(counts[(lang, *words[:k])], counts[(lang, *words[k:])]) for k in range(1, len(words))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score)
        for lang, found in out.items() for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)
    )


def frame(spark, rows, partitions=5):
    return spark.createDataFrame(list(rows), "lang STRING, text STRING").repartition(partitions)


def random_rows(seed, n, words=("New", "york", "city", "of", "the", "a\tb", "é東", "x", "İ", "tea . pot")):
    random = np.random.default_rng(seed)
    marks = np.array([" ", " ", " ", "  ", "\t", ", ", "\n", "!", "\x0b"])
    for _ in range(n):
        size = int(random.integers(0, 40))
        text = "".join(w + m for w, m in zip(random.choice(np.array(words), size), random.choice(marks, size)))
        yield str(random.choice(["en", "de"])), text + "new york city of the tea" * int(random.integers(0, 2))


@pytest.mark.parametrize(("shards", "least"), [(1, 3), (3, 6)])
def test_phrases_as_counted_plainly(spark, shards, least):
    rows = [*random_rows(1, 120), (None, None), (None, "a b a b a b a b a b a b"), ("en", ""), ("en", " \t\n"), ("xx", "once upon a time")]
    rows += rows[:9]
    got = c.collocations(frame(spark, rows), least, shards=shards, block_words=300)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows, least)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_top_and_share(spark):
    rows = list(random_rows(2, 80))
    got = c.collocations(frame(spark, rows, 2), 5, longest=3, share=50, top=7, shards=2, block_words=200)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 3, 50, 7)


def test_counts_of_frequent_phrases_are_whole_though_they_start_late(spark):
    """A word that is rare in the first shards: its phrases start later and still meet every shard."""
    rows = [("en", "common pair " * 20) for _ in range(12)] + [("en", "late bird " * (i % 4)) for i in range(12)]
    phrases, sizes = c.frequent_phrases(frame(spark, rows, 6), 15, shards=4, block_words=40)
    words = {row["word"]: (row["n"], row["id"]) for row in phrases[1].collect()}
    assert {word: n for word, (n, _) in words.items()} == {"common": 240, "pair": 240, "late": 18, "bird": 18}
    pairs = {(row["x"], row["y"]): row["n"] for row in phrases[2].collect()}
    ids = {word: key for word, (_, key) in words.items()}
    assert pairs == {(ids["common"], ids["pair"]): 240, (ids["pair"], ids["common"]): 228, (ids["late"], ids["bird"]): 18}
    assert [tuple(row) for row in sizes.collect()] == [("en", 516)]


def test_rare_phrases_stay_out_of_the_search_for_longer_ones(spark, monkeypatch):
    """Blocks hold frequent words in pairs that are rare: such pairs are sorted and moved nowhere, and a
    block without a frequent pair does not disturb the others. A block gives few rows of lists."""
    names, random, given, pairs = [f"w{i}" for i in range(30)], np.random.default_rng(3), {}, c._pairs
    mixed = [[("en", " ".join(random.permutation(names))) for _ in range(8)] for _ in range(3)]
    common = [("en", "once upon a time " + " ".join(random.permutation(names))) for _ in range(12)]

    def watched(known, folder, length, *rest):
        given.setdefault(length, []).append((known.count(), known.selectExpr("explode(id) AS id").count()))
        return pairs(known, folder, length, *rest)

    monkeypatch.setattr(c, "_pairs", watched)
    docs = frame(spark, common, 1)
    for some in mixed:
        docs = docs.union(frame(spark, some, 1))
    got = sorted(map(tuple, c.collocations(docs, 12, shards=2, block_words=20).collect()))
    assert got == plain([*common, *(row for some in mixed for row in some)], 12) and len(got) > 0
    assert set(given) == {2, 3, 4}
    assert all(rows <= 4 and listed <= 30 for length in (3, 4) for rows, listed in given[length])


def test_scores_pass_64_bits(spark):
    heads = "CAST(n AS DECIMAL(19, 0)) * 2000000 div CAST(n + n AS DECIMAL(19, 0))"
    assert spark.sql(f"SELECT {heads} FROM (SELECT 4000000000000000000 AS n)").first()[0] == 1_000_000


def test_empty_tables_and_clashing_columns(spark, documents, clashing):
    empty = c.collocations(documents([]))
    assert empty.collect() == [] and empty.columns[0] == "lang"
    rare = clashing(documents()).selectExpr("*", "1 AS block", "2 AS local", "3 AS word", "4 AS shard", "5 AS x")
    got = c.collocations(rare, 2, shards=1, longest=2)
    assert sorted(map(tuple, got.collect())) == plain([(row["lang"], row["text"]) for row in rare.collect()], 2, 2)
