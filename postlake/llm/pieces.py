"""Texts in batches of even size, cut where no token crosses, each distinct piece encoded once.

A piece is what stands between two safe boundaries of a text. Words repeat, so encoding the distinct
pieces of a task and adding up their ids gives the ids of the whole text for a fraction of the work.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa

# Between a character that is no white space and one space before another such character. Byte-level
# patterns take a single space with what follows it, so no match, and no special string, crosses.
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")

#: Characters of text per step; longer texts are cut at safe boundaries into parts of about this size.
STEP_CHARS = 1 << 21
#: Distinct pieces kept by a Python worker before it starts anew, and about how many bytes they may take.
TABLE_LIMIT = 500_000
TABLE_BYTES = 96 << 20
#: Longer pieces (texts without spaces) are not kept when a table starts anew.
LONG_PIECE = 64
#: About what a piece takes besides its characters and ids.
_ENTRY_BYTES = 150


def byte_level_pieces(text: str) -> list[str]:
    """Pieces for patterns that join one space to the word after it."""
    return _BEFORE_SPACE.split(text) if text else []


def word_pieces(text: str) -> list[bytes]:
    """Pieces for vocabularies that drop white space and case: the words between spaces and line ends,
    in UTF-8. Plain ASCII is in lower case; words with other characters, which compose before their case
    is dropped, and those that may hold a special string are as they stand."""
    data = text.encode().replace(b"\n", b" ")
    if b"<|" in data:
        return [word.lower() if word.isascii() and b"<|" not in word else word for word in data.split(b" ")]
    if data.isascii():
        return data.lower().split(b" ")
    return [word.lower() if word.isascii() else word for word in data.split(b" ")]


def parts(text: str, size: int = STEP_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut at safe boundaries; whole if it has none."""
    start = 0
    while len(text) - start > size:
        cut = _BEFORE_SPACE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def steps(texts: Iterable[str | None], size: int = STEP_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Lists of (row, part) with about ``size`` characters each, whatever the texts' lengths."""
    held, weight = [], 0
    for row, text in enumerate(texts):
        for part in parts(text or "", size):
            held.append((row, part))
            weight += len(part) + 1
            if weight >= size:
                yield held
                held, weight = [], 0
    if held:
        yield held


class _Codes(dict):
    def __missing__(self, key):
        self[key] = code = len(self)
        return code


class PieceTable:
    """Ids of distinct pieces. ``encode`` takes pieces and returns (flat ids, ids per piece).

    Beyond ``limit`` pieces, or ``size`` bytes, short pieces seen again so far are kept and the others
    forgotten, so that texts without spaces, a piece each, do not pile up.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = TABLE_LIMIT, size: int = TABLE_BYTES):
        self._encode = encode
        self._limit = limit
        self._size = size
        self._keep({}, np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _keep(self, codes: dict, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._codes = _Codes(codes)
        self._ids = ids
        self._lengths = lengths
        self._starts = np.cumsum(lengths) - lengths
        self._seen = np.zeros(len(codes), np.int64)
        self._bytes = self._weight(list(codes), ids)

    @staticmethod
    def _weight(pieces: list, ids: np.ndarray) -> int:
        return sum(map(len, pieces)) + 4 * len(ids) + _ENTRY_BYTES * len(pieces)

    def _forget(self) -> None:
        names = list(self._codes)
        again = np.array([at for at in np.flatnonzero(self._seen > 2).tolist() if len(names[at]) <= LONG_PIECE], np.int64)
        if len(again) * 2 > self._limit or self._weight([names[at] for at in again.tolist()], self.ids(again)) * 2 > self._size:
            again = again[:0]
        self._keep({names[old]: new for new, old in enumerate(again.tolist())}, self.ids(again), self._lengths[again])

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """The codes of ``pieces``; valid until the next call."""
        if len(self._codes) > self._limit or self._bytes > self._size:
            self._forget()
        known = len(self._codes)
        codes = np.fromiter(map(self._codes.__getitem__, pieces), np.int64, len(pieces))
        if len(self._codes) > known:
            fresh = list(islice(self._codes, known, None))
            ids, lengths = self._encode(fresh)
            self._bytes += self._weight(fresh, ids)
            self._ids = np.concatenate([self._ids, ids])
            self._lengths = np.concatenate([self._lengths, lengths])
            self._starts = np.cumsum(self._lengths) - self._lengths
        seen = np.bincount(codes, minlength=len(self._codes))
        seen[:len(self._seen)] += self._seen
        self._seen = seen
        return codes

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        return self._lengths[codes]

    def ids(self, codes: np.ndarray) -> np.ndarray:
        """The ids of the pieces, one after another."""
        lengths = self._lengths[codes]
        return self._ids[ragged(self._starts[codes], lengths)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] of them), starts[1], ..."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums_by_row(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def encoded_rows(
    texts: list[str | None], table: PieceTable, cut: Callable[[str], list[str]], size: int = STEP_CHARS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each id, ids) for steps of ``texts`` of about ``size`` characters, in order."""
    for step in steps(texts, size):
        pieces, counts = [], []
        for _, part in step:
            found = cut(part)
            pieces += found
            counts.append(len(found))
        codes = table.look_up(pieces)
        rows = np.repeat(np.array([row for row, _ in step], np.int64), counts)
        yield np.repeat(rows, table.lengths(codes)), table.ids(codes)


def counted_rows(
    texts: list[str | None], table: PieceTable, cut: Callable[[str], list[str]]
) -> np.ndarray:
    """Ids of each text."""
    total = np.zeros(len(texts), np.int64)
    for step in steps(texts):
        pieces, counts = [], []
        for _, part in step:
            found = cut(part)
            pieces += found
            counts.append(len(found))
        codes = table.look_up(pieces)
        rows = np.repeat(np.array([row for row, _ in step], np.int64), counts)
        total += sums_by_row(rows, table.lengths(codes), len(texts))
    return total


def small_batches(batches: Iterable[pa.RecordBatch], column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of ``column``."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        weights = np.diff(np.frombuffer(batch.column(column).cast(pa.large_binary()).buffers()[1], np.int64)[
            batch.column(column).offset: batch.column(column).offset + batch.num_rows + 1
        ])
        group = np.cumsum(weights) // size
        for rows in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(group)) + 1):
            yield batch.slice(int(rows[0]), len(rows))
