import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import embeddings, simhash
from postlake.llm.components import components, forest
from postlake.llm.queries import QUERIES
from tests.llm.brute import fingerprint, near_groups, smallest_reachable


@pytest.mark.parametrize("seed", range(4))
def test_components_equal_a_walk(spark, seed):
    random = np.random.default_rng(seed)
    links = random.integers(0, 300, (220, 2)).tolist() + [[i, i + 1] for i in range(400, 460)] + [[5, 5]]
    links += [[500, i] for i in range(501, 560)]
    got = {row["node"]: row["component"] for row in components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    want = smallest_reachable(600, links)
    named = {x for a, b in links for x in (a, b) if a != b}
    assert got == {node: want[node] for node in named}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).collect() == []
    assert components(spark.createDataFrame([(1, None), (None, 2), (3, 3)], "a BIGINT, b BIGINT")).collect() == []


def test_forest():
    assert forest(6, np.array([4, 3, 5]), np.array([3, 2, 5])).tolist() == [0, 1, 2, 2, 2, 5]


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_walk_equals_all_pairs(budget):
    random = np.random.default_rng(budget)
    base = random.integers(0, 1 << 64, 60, np.uint64)
    flips = [np.uint64(1) << np.uint64(bit) for bit in random.integers(0, 64, 300)]
    values = np.unique(np.concatenate([base, base[random.integers(0, 60, 300)] ^ np.array(flips, np.uint64)]))
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= budget}
    i, j = simhash.near_pairs(values, None, budget)
    assert {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())} == want
    left, right = values[::2], values[1::2]
    i, j = simhash.near_pairs(left, right, budget)
    assert set(zip(i.tolist(), j.tolist())) == {
        (a, b) for a in range(len(left)) for b in range(len(right)) if int(left[a] ^ right[b]).bit_count() <= budget
    }


@pytest.mark.parametrize("limit", [8, 100_000])
def test_near_duplicates_whatever_the_node_limit(documents, limit):
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    rows, base = [], [list(random.choice(words, 120)) for _ in range(12)]
    for at in range(240):
        text = list(base[at % 12])
        for _ in range(int(random.integers(0, 3))):
            text[int(random.integers(0, 120))] = str(random.choice(words))
        rows.append((at, " ".join(text), "en", "s", 0))
    docs = documents(rows)
    got = {row["doc_id"]: row for row in simhash.near_duplicates(docs, limit=limit).collect()}
    prints = [fingerprint(text) for _, text, *_ in rows]
    groups = near_groups(prints)
    assert [got[at]["fingerprint"] for at in range(240)] == [f"{one:016x}" for one in prints]
    assert [got[at]["component_id"] for at in range(240)] == groups
    assert sorted(row["doc_id"] for row in simhash.keep_one(docs, simhash.near_duplicates(docs, limit=limit)).collect()) == sorted(set(groups))


def test_simhash_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    prints = [fingerprint(row["text"]) for row in rows]
    groups = near_groups(prints)
    got = {row["doc_id"]: (row["fingerprint"], row["component_id"]) for row in QUERIES["op3_simhash"](spark, sf_dir).collect()}
    assert got == {row["doc_id"]: (f"{one:016x}", rows[group]["doc_id"]) for row, one, group in zip(rows, prints, groups)}


def test_simhash_of_awkward_documents(documents, clashing):
    docs = clashing(documents())
    found = simhash.near_duplicates(docs)
    rows = found.collect()
    assert len(rows) == docs.count()
    by_id = {row["doc_id"]: row["component_id"] for row in rows if row["doc_id"] in (2, 3, 4, 5)}
    assert by_id == {2: 2, 3: 2, 4: 2, 5: 5}  # without words: fingerprint 0
    kept = simhash.keep_one(docs, found)
    assert kept.columns == docs.columns
    texts = sorted((str(row["doc_id"]), row["text"] or "") for row in kept.collect())
    assert [key for key, _ in texts] == ["1", "1", "2", "5", "6", "7", "None"]  # a row for each component of id 1
    assert texts[0][1] == "The quick brown fox, it's here.\nThe quick brown fox." and texts[-1][1].startswith("sin")
    assert texts[1][1] == "another text under one id"
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.keep_one(documents([]), simhash.near_duplicates(documents([]))).collect() == []


def test_a_repeated_id_stays_only_where_it_is_the_smallest(documents):
    one, two = ("eins zwei drei vier", "uno dos tres cuatro cinco")
    docs = documents([(1, one, "de", "a", 0), (2, one, "de", "a", 0), (2, two, "es", "a", 0), (3, two, "es", "a", 0), (4, "x y z", "en", "a", 0)])
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert sorted((row["doc_id"], row["text"]) for row in kept.collect()) == [(1, one), (2, two), (4, "x y z")]
    docs = documents([(1, one, "de", "a", 0), (2, one, "de", "a", 0), (2, two, "es", "a", 0), (0, two, "es", "a", 0)])
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert sorted((row["doc_id"], row["text"]) for row in kept.collect()) == [(0, two), (1, one)]


def test_an_id_keeps_a_row_in_each_component_it_begins(documents):
    one, two = ("eins zwei drei vier", "uno dos tres cuatro cinco")
    docs = documents([(1, one, "de", "a", 0), (1, two, "es", "b", 0), (1, two, "es", "a", 0), (5, one, "de", "a", 0), (6, two, "es", "a", 0)])
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert sorted((row["doc_id"], row["text"]) for row in kept.collect()) == [(1, one), (1, two)]


def cosine_groups(vectors, least=0.9):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = units @ units.T >= least
    np.fill_diagonal(near, False)
    return near.sum(axis=1), smallest_reachable(len(units), np.argwhere(near).tolist())


def test_embeddings_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    links, groups = cosine_groups(np.array([row["embedding"] for row in rows], float))
    got = {row["vec_id"]: tuple(row)[1:] for row in QUERIES["op7_embedding_dedup"](spark, sf_dir).collect()}
    want = {row["vec_id"]: (int(n), rows[g]["vec_id"], g == at) for at, (row, n, g) in enumerate(zip(rows, links, groups))}
    assert got == want


def test_embedding_recall_on_isolated_pairs(spark):
    random = np.random.default_rng(5)
    base = random.standard_normal((1500, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    noise = random.standard_normal((1500, 32))
    noise -= (noise * base).sum(axis=1, keepdims=True) * base
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    vectors = np.concatenate([base, 0.905 * base + np.sqrt(1 - 0.905 ** 2) * noise])
    links, _ = cosine_groups(vectors)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = embeddings.near_duplicates(frame).agg(F.sum("n_links")).first()[0]
    assert 0.9 * links.sum() <= got <= links.sum()


def pairs_in_a_cone(n, pairs, cosine, seed=9):
    """``n`` vectors of 64 dimensions, all about one topic; the last ``pairs`` are ``cosine`` from the first."""
    random = np.random.default_rng(seed)
    own = random.standard_normal((n, 64))
    topic = random.standard_normal(64)
    vectors = own / np.linalg.norm(own, axis=1, keepdims=True) + np.sqrt(3) * topic / np.linalg.norm(topic)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    noise = random.standard_normal((pairs, 64))
    noise -= (noise * vectors[:pairs]).sum(axis=1, keepdims=True) * vectors[:pairs]
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    vectors[n - pairs:] = cosine * vectors[:pairs] + np.sqrt(1 - cosine ** 2) * noise
    return vectors


def test_every_pair_of_a_hot_topic_is_linked(spark):
    vectors = pairs_in_a_cone(9000, 300, 0.902)
    links, groups = cosine_groups(vectors)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = {row["vec_id"]: (row["n_links"], row["component_id"]) for row in embeddings.near_duplicates(frame).collect()}
    assert links.sum() >= 600
    assert got == {i: (int(n), g) for i, (n, g) in enumerate(zip(links, groups))}
    passes = embeddings.near_duplicates(frame, passes=4).agg(F.sum("n_links")).first()[0]
    assert 0 < passes < links.sum()


def test_the_number_of_vectors_switches_nothing(spark, monkeypatch):
    def unwanted(*_):
        raise AssertionError("all pairs of a small input")

    vectors = pairs_in_a_cone(2500, 60, 0.95)
    links, groups = cosine_groups(vectors)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    monkeypatch.setattr(embeddings, "all_links", unwanted)
    got = {row["vec_id"]: (row["n_links"], row["component_id"]) for row in embeddings.near_duplicates(frame, window=128).collect()}
    assert got == {i: (int(n), g) for i, (n, g) in enumerate(zip(links, groups))}


def test_links_that_passes_do_not_find_ask_for_all_pairs(spark, monkeypatch):
    vectors = pairs_in_a_cone(600, 40, 0.95)
    links, _ = cosine_groups(vectors)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    monkeypatch.setattr(embeddings, "MOST_PASSES", 4)
    got = embeddings.near_duplicates(frame, window=1).agg(F.sum("n_links")).first()[0]
    assert got == links.sum()


@pytest.mark.parametrize("file_rows", [30, 50, 67, 1000])
def test_all_pairs_of_files_meet(spark, file_rows):
    random = np.random.default_rng(8)
    vectors = random.standard_normal((200, 3))
    sizes = [3] * 200 + [2] * 3
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(200 + i, [1.0, 0.1 * i]) for i in range(3)]
    frame = spark.createDataFrame([(i, size, v) for (i, v), size in zip(rows, sizes)], "node BIGINT, size INT, vector ARRAY<DOUBLE>")
    near = np.argwhere(cosine_matrix(vectors) >= 0.97).tolist() + [[200, 201], [201, 202]]
    links = [list(row) for row in embeddings.all_links(frame, 0.97, file_rows).collect()]
    assert smallest_reachable(203, links) == smallest_reachable(203, near)
    assert all(a != b for a, b in links)


def cosine_matrix(vectors):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return units @ units.T


def test_dense_groups_beyond_a_block_are_counted_whole(spark):
    random = np.random.default_rng(6)
    vectors = np.concatenate([np.ones(16) + 0.01 * random.standard_normal((150, 16)), random.standard_normal((50, 16))])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000 + i, vectors[0].tolist()) for i in range(30)]
    links, groups = cosine_groups(np.array([v for _, v in rows]))
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    member = frame.select(F.lit(1).alias("component"), F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("copies"), F.col("embedding").alias("vector")).where("vec_id < 150")
    counted = {row["node"]: row["n"] for row in embeddings.exact_links(member, 0.9, block=40).collect()}
    assert counted == {i: 149 for i in range(150)}
    got = {row["vec_id"]: row["n_links"] for row in embeddings.near_duplicates(frame, window=5).collect()}
    assert got == {key: int(n) for (key, _), n in zip(rows, links)}


def test_awkward_embeddings(spark):
    one = [1.0, 2.0, -3.0]
    rows = [
        (1, one), (2, None), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]),
        (7, [1e200, 2e200, -3e200]), (8, [1e-200, 2e-200, -3e-200]), (9, [1.0, 2.0]), (10, []), (11, one), (11, one), (None, one),
        (None, None), (12, [-0.0, 1.0, 0.0]), (13, [0.0, 1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("node", F.lit("own")).withColumn("kept", F.lit("own"))
    got = embeddings.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    group = sorted((str(row["vec_id"]), row["n_links"], row["component_id"], row["kept"]) for row in got if row["component_id"] == 1)
    assert group == [("1", 5, 1, True), ("11", 5, 1, False), ("11", 5, 1, False), ("7", 5, 1, False), ("8", 5, 1, False), ("None", 5, 1, False)]
    alone = {row["vec_id"]: (row["n_links"], row["component_id"], row["kept"]) for row in got if row["vec_id"] in (2, 3, 4, 5, 6, 9, 10)}
    assert alone == {key: (0, key, True) for key in (2, 3, 4, 5, 6, 9, 10)}
    assert {row["vec_id"]: row["component_id"] for row in got if row["vec_id"] in (12, 13)} == {12: 12, 13: 12}
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []
