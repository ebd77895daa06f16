"""SentencePiece ids by a table of distinct marked words.

The library writes a space as the mark U+2581 and puts one ahead of the text. Where no piece of a
vocabulary holds a mark behind another character, no merge crosses from a word to the mark that
follows, so a text is its marked words (a run of marks and what follows) encoded each by itself. A
Python worker encodes each distinct word once and joins its ids back by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postlake.llm.pieces import STEP_CHARS, PieceTable, small_batches

MARK = "▁"
# A mark behind another character starts a word; a text may hold the mark itself.
_WORD_START = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


@lru_cache(maxsize=4)
def _processor(path: str):
    """The library for the model at ``path``; fails where words cannot be encoded each by itself."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    processor = SentencePieceProcessor(model_file=path)
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(processor.serialized_model_proto())
    normal = model.normalizer_spec
    crossing = any(re.search(f"[^{MARK}]{MARK}", one.piece) for one in model.pieces)
    plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and not normal.remove_extra_whitespaces
    if crossing or not plain or not normal.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model's pieces may cross the marks between words")
    return processor


@lru_cache(maxsize=4)
def _table(path: str) -> PieceTable:
    processor = _processor(path)
    mark = processor.piece_to_id(MARK)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = processor.encode(words, num_threads=1)
        found = [ids if word else [mark] for word, ids in zip(words, found)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([number for ids in found for number in ids], np.int32), lengths

    return PieceTable(encode)


def marked_words(text: str) -> list[str]:
    """The words of a text without the mark each begins with; "" is a mark alone."""
    if "  " in text or MARK in text or text[:1] == " ":
        return _WORD_START.split(text)
    return text.split(" ") if text else []


def _parts(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut at the mark between two words."""
    start = 0
    while len(text) - start > size:
        cut = _WORD_START.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.end()
    yield text[start:]


def word_codes(texts: list[str | None], table: PieceTable, size: int = STEP_CHARS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each id, ids) for steps of about ``size`` characters, in order."""
    words, rows, counts, weight = [], [], [], 0

    def step():
        codes = table.look_up(words)
        places = np.repeat(np.array(rows, np.int64), counts)
        return np.repeat(places, table.lengths(codes)), table.ids(codes)

    for row, text in enumerate(texts):
        for at, part in enumerate(_parts(text or "", size)):
            found = marked_words(part) if at == 0 else marked_words("x " + part)[1:]
            words += found
            rows.append(row)
            counts.append(len(found))
            weight += len(part) + 1
            if weight >= size:
                yield step()
                words, rows, counts, weight = [], [], [], 0
    if words:
        yield step()


def _framed(texts: list[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids): the ids of the texts one after another, each between begin and end."""
    processor, table = _processor(path), _table(path)
    steps = list(word_codes(texts, table))
    places = np.concatenate([rows for rows, _ in steps]) if steps else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(places, minlength=len(texts)) + 2)])
    ids = np.empty(int(offsets[-1]), "<u4")
    if steps:
        ids[np.arange(len(places)) + 2 * places + 1] = np.concatenate([ids for _, ids in steps])
    ids[offsets[:-1]] = processor.bos_id()
    ids[offsets[1:] - 1] = processor.eos_id()
    return offsets, ids


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: str | None = None) -> DataFrame:
    """(id, ids) for each row of ``docs``: ids with begin and end, as little-endian unsigned 32-bit
    integers in one BINARY; ``decoded`` names a column for the text that the library decodes from them.

    ``path``: a SentencePiece model without normalisation whose pieces hold marks at their beginning
    only; another model fails. A null or empty text has the begin and end ids alone and decodes to the
    empty text. Null and repeated ids keep a row each; ties cannot arise. Other columns are not
    carried, so that none clashes. An empty table gives no rows. A text is encoded in steps of words,
    a word without a space in it whole.
    """

    def run(batches):
        for batch in small_batches(batches, "text", 4 << 20):
            offsets, ids = _framed(batch.column("text").to_pylist(), path)
            buffers = [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(ids)]
            columns = {id_col: batch.column("id"), "ids": pa.Array.from_buffers(pa.binary(), len(batch), buffers)}
            if decoded:
                decode = _processor(path).decode
                columns[decoded] = pa.array([decode(one.tolist()) for one in np.split(ids.astype(np.int64), offsets[1:-1])], pa.string())
            yield pa.record_batch(columns)

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    shape = f"{id_col} BIGINT, ids BINARY" + (f", {decoded} STRING" if decoded else "")
    return rows.mapInArrow(run, shape)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded): the library's text of the ids in ``ids_col``, as ``encode`` writes them; null
    ids decode to the empty text."""

    def run(batches):
        processor = _processor(path)
        for batch in small_batches(batches, "ids"):
            texts = [processor.decode(np.frombuffer(one or b"", "<u4").tolist()) for one in batch.column("ids").to_pylist()]
            yield pa.record_batch({id_col: batch.column("id"), "decoded": pa.array(texts, pa.string())})

    rows = tokens.select(tokens[id_col].cast("long").alias("id"), tokens[ids_col].alias("ids"))
    return rows.mapInArrow(run, f"{id_col} BIGINT, decoded STRING")
