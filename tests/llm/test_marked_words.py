import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from postlake.llm.marked_words import MARK, _framed, _table, decode, encode, marked_words, word_codes
from postlake.llm.pieces import PieceTable
from postlake.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ALPHABET = "abtheTHE.,  \n\t\r\x00é́東😀</s><unk><0x41>" + MARK + " 　​"


def framed(text):
    return [LIBRARY.bos_id(), *LIBRARY.encode(text), LIBRARY.eos_id()]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=4))
def test_words_give_the_ids_of_the_whole_text(some):
    offsets, ids = _framed(some, MODEL)
    assert [one.tolist() for one in np.split(ids, offsets[1:-1])] == [framed(text) for text in some]


@pytest.mark.parametrize("size", [1, 7, 50])
def test_long_texts_are_cut_without_a_trace(size):
    some = ["one  two " * 40 + MARK + " end ", "x" * 500, "", " a" * 90, None, "a " + "  b" * 50]
    got = [[] for _ in some]
    for rows, ids in word_codes(some, _table(MODEL), size):
        for row, one in zip(rows.tolist(), ids.tolist()):
            got[row].append(one)
    assert got == [LIBRARY.encode(text or "") for text in some]


def test_words_of_a_text():
    assert marked_words("a b") == ["a", "b"]
    assert marked_words(" a  b ") == [" a", " b", ""]
    assert marked_words("") == []


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {row["doc_id"]: row for row in QUERIES["op12_sentencepiece"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for row in docs:
        ids = framed(row["text"] or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
        assert tuple(got[row["doc_id"]]) == (row["doc_id"], len(ids), digest, text)


def test_awkward_documents(documents, clashing):
    docs = clashing(documents()).withColumnRenamed("kept", "decoded")
    tokens = encode(docs, MODEL)
    want = sorted((str(row["doc_id"]), framed(row["text"] or "")) for row in docs.collect())
    assert sorted((str(row["doc_id"]), np.frombuffer(row["ids"], "<u4").tolist()) for row in tokens.collect()) == want
    texts = sorted((str(row["doc_id"]), row["text"] or "") for row in docs.collect())
    assert sorted((str(row["doc_id"]), row["decoded"]) for row in decode(tokens, MODEL).collect()) == texts
    both = encode(docs, MODEL, decoded="plain").collect()
    assert sorted((str(row["doc_id"]), row["plain"]) for row in both) == texts
    assert encode(documents([]), MODEL).collect() == []


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(LIBRARY.serialized_model_proto())
    model.pieces[500].piece = f"a{MARK}b"
    path = tmp_path / "crossing.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="cross"):
        _table(str(path))


def test_a_table_is_bounded_in_bytes():
    """Texts without spaces are a piece each: they are forgotten, short words seen again are kept."""
    table = PieceTable(lambda pieces: (np.array([len(p) for p in pieces], np.int32), np.ones(len(pieces), np.int64)), size=100_000)
    for at in range(200):
        pieces = ["word", "word", "word", f"{at:05}" * 1000]
        assert table.ids(table.look_up(pieces)).tolist() == [4, 4, 4, 5000]
        assert table._bytes < 110_000 and len(table._codes) < 25
