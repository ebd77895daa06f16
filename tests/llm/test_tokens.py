import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postlake.llm import byte_bpe, simple8b
from postlake.llm.pieces import byte_level_pieces, encoded_rows, steps, word_pieces
from postlake.llm.queries import QUERIES
from postlake.llm.token_counts import count_tokens
from postlake.llm.token_files import read_documents, write_shards
from postlake.llm.tokenizers_files import library_table
from tests.llm.brute import library, ranks_encoding

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = "aAbZs'tREé́̇İΣς1٣ \n\t\x85\xa0　\x1c.,!%#<|endoftext|>​😀東ÀßÿØ×"


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    return [(row["doc_id"], row["text"] or "") for row in rows]


def flat(texts, table, cut):
    got = [[] for _ in texts]
    for rows, ids in encoded_rows(texts, table, cut):
        for row, one in zip(rows.tolist(), ids.tolist()):
            got[row].append(one)
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=4))
def test_pieces_give_the_ids_of_the_whole_text(some):
    for path, table, cut in ((BYTES, library_table(BYTES), byte_level_pieces), (WORDS, library_table(WORDS, lower=True), word_pieces)):
        want = [one.ids for one in library(path.rsplit("/", 1)[1]).encode_batch(some, add_special_tokens=False)]
        assert flat(some, table, cut) == want


COMPOSED = ["<|ENDOFTEXT|>", "<|endoftext|>", "<|EndOfText|>", "<|", "J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "A", "b", "Z", "É", "\u030c", " ", "\n"]


def test_case_is_dropped_where_the_library_drops_it():
    random = np.random.default_rng(4)
    some = ["a <|ENDOFTEXT|> b", "J\u030c", "H\u0331 T\u0308 W\u030a Y\u030a"]
    some += ["".join(random.choice(COMPOSED, size)) for size in random.integers(0, 12, 2000)]
    want = [one.ids for one in library("word_bpe_49k.json").encode_batch(some, add_special_tokens=False)]
    assert want[0] == [320, 27, 347, 40786, 4160, 91, 285, 321]
    assert flat(some, library_table(WORDS, lower=True), word_pieces) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=4))
def test_byte_pieces_give_the_ids_of_the_rank_library(some):
    table = byte_bpe._table(RANKS, public_tokenizers.PATTERN)
    encoding = ranks_encoding()
    assert flat(some, table, byte_level_pieces) == [encoding.encode_ordinary(text) for text in some]


def test_every_character_is_split_like_the_rank_library():
    table, encoding = byte_bpe._table(RANKS, public_tokenizers.PATTERN), ranks_encoding()
    some = [f"a {chr(c)}b1{chr(c)} {chr(c)}." for c in range(0, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    assert flat(some, table, byte_level_pieces) == [encoding.encode_ordinary(text) for text in some]


def test_long_matches_merge_alike():
    ranks, encoding = byte_bpe.ranks_of(RANKS), ranks_encoding()
    for text in ("a" * 5000, "ab" * 300 + "c" * 200, "é" * 400, "!" * 999):
        assert ranks.merge_long(text.encode()) == encoding.encode_ordinary(text)


def test_long_texts_are_cut_without_a_trace():
    text = "word " * 5000 + "x" * 9000
    assert "".join(part for _, part in (pair for step in steps([text], 1000) for pair in step)) == text
    assert max(len(part) for step in steps(["word " * 5000], 1000) for _, part in step) < 1100


@pytest.mark.parametrize("high", [2, 50_000, 1 << 40, 1 << 64])
@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 4096, 4097, 20_000])
def test_simple8b_round_trip(n, high):
    values = np.random.default_rng(n).integers(0, high - 1, n, np.uint64, endpoint=True)
    values[::3] %= np.uint64(5)
    words, offsets, escapes, escape_offsets = simple8b.encode(values)
    assert (simple8b.decode(words, escapes) == values).all()
    assert len(escapes) == int((values >= np.uint64(1 << 60)).sum())
    if n > 4096:  # a block alone
        assert (simple8b.decode(words[offsets[1]:], escapes[escape_offsets[1]:]) == values[4096:]).all()


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1000])
def test_packing_in_portions_gives_the_same_words(n):
    values = np.random.default_rng(n).integers(0, 1 << 62, n, np.uint64) >> np.random.default_rng(1).integers(0, 62, n, np.uint64)
    whole = simple8b.encode(values, block=16, at_once=1 << 20)
    assert all((a == b).all() for a, b in zip(whole, simple8b.encode(values, block=16, at_once=2)))


def test_shard_round_trip():
    lengths = np.array([3, 0, 5000, 1])
    values = np.arange(5004, dtype=np.uint64) ** 5
    shard = simple8b.Shard(simple8b.pack_shard([7, None, 8, 8], lengths, values, block=64))
    assert [(doc, len(ids)) for doc, ids in shard.documents()] == [(7, 3), (None, 0), (8, 5000), (8, 1)]
    assert (np.concatenate([ids for _, ids in shard.documents()]) == values).all()
    assert (shard.values(100, 300) == values[100:300]).all()


def test_token_files_query(spark, sf_dir, texts):
    got = {row["doc_id"]: row for row in QUERIES["op1_token_files"](spark, sf_dir).collect()}
    start = 0
    for (doc, _), one in zip(texts, library("word_bpe_49k.json").encode_batch([t for _, t in texts], add_special_tokens=False)):
        ids = np.array([*one.ids, 2], "<u4")
        assert tuple(got[doc]) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def test_token_files_of_awkward_documents(spark, documents, clashing, folder):
    docs = clashing(documents())
    found = read_documents(write_shards(docs, f"{folder}/a", WORDS, end_id=2, shard_ids=50), f"{folder}/a", with_ids=True)
    rows = sorted(found.collect(), key=lambda row: row["start"])
    keys = [row["doc_id"] for row in rows]
    assert keys == [None, None, 1, 1, 1, 2, 3, 4, 5, 6, 7]
    assert [row["start"] for row in rows] == list(np.cumsum([0] + [row["n_tokens"] for row in rows[:-1]]))
    encoder = library("word_bpe_49k.json")
    want = sorted([*encoder.encode(row["text"] or "", add_special_tokens=False).ids, 2] for row in docs.collect())
    assert sorted(row["ids"] for row in rows) == want
    empty = write_shards(documents([]), f"{folder}/b", WORDS, end_id=2)
    assert read_documents(empty, f"{folder}/b").collect() == []


def test_byte_bpe_query(spark, sf_dir, texts):
    got = {row["doc_id"]: row for row in QUERIES["op4_byte_bpe"](spark, sf_dir).collect()}
    encoding = ranks_encoding()
    assert len(got) == len(texts)
    for doc, text in texts:
        ids = encoding.encode_ordinary(text)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert tuple(got[doc]) == (doc, len(ids), digest, hashlib.sha256(text.encode()).hexdigest())


def test_byte_bpe_of_awkward_documents(documents, clashing):
    docs = clashing(documents())
    tokens = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.decode(tokens, RANKS).collect()
    encoding = ranks_encoding()
    want = sorted((str(row["doc_id"]), encoding.encode_ordinary(row["text"] or ""), (row["text"] or "").encode()) for row in docs.collect())
    assert sorted((str(row["doc_id"]), row["ids"], bytes(row["decoded"])) for row in rows) == want
    assert byte_bpe.encode(documents([]), RANKS, public_tokenizers.PATTERN).collect() == []


def test_token_counts_query(spark, sf_dir, texts):
    got = {row["doc_id"]: row for row in QUERIES["op9_token_counts"](spark, sf_dir).collect()}
    counted = library("byte_bpe_50k.json").encode_batch([text for _, text in texts], add_special_tokens=False)
    assert len(got) == len(texts)
    for (doc, text), one in zip(texts, counted):
        assert tuple(got[doc]) == (doc, len(text.encode()), len(one.ids), len(one.ids) > 512)


def test_token_counts_of_awkward_documents(documents, clashing):
    docs = clashing(documents())
    encoder = library("byte_bpe_50k.json")
    want = sorted(
        (str(row["doc_id"]), len((row["text"] or "").encode()), len(encoder.encode(row["text"] or "", add_special_tokens=False).ids))
        for row in docs.collect()
    )
    assert sorted((str(row["doc_id"]), row["n_bytes"], row["n_tokens"]) for row in count_tokens(docs, BYTES).collect()) == want
    assert count_tokens(documents([]), BYTES).collect() == []
