"""Byte-level BPE by ranks: encoding in numpy matrices, and decoding.

The distinct pieces of a batch become rows of matrices, one matrix for each range of lengths, padded
to its width. In each round every row merges its leftmost pair of lowest rank, all rows at once: pair
ranks come from an open hash table over (left id, right id), and rows close up behind the merge.
Rows without a pair left are done. Pieces longer than the widest matrix, which are rare, go through a
heap of pairs, so that a long run costs n log n.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from postlake.llm.pieces import PieceTable, byte_level_pieces, encoded_rows, ragged, small_batches

WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64, 128)
_NONE = np.int32(np.iinfo(np.int32).max)
_ROWS = 1 << 15
#: Bytes of text in a step of a worker, and the distinct pieces it keeps with about their bytes: what a
#: worker holds beside its ranks stays near 100 MB.
STEP_BYTES = 1 << 18
TABLE_PIECES, TABLE_BYTES = 100_000, 24 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 over the golden ratio, odd


class Ranks:
    """The vocabulary of a rank file: base64 bytes and a rank on each line; ids are ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        tokens = [b""] * (max(self.ids.values()) + 1)
        for token, number in self.ids.items():
            tokens[number] = token
        self.lengths = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (self.ids[token[:cut]], self.ids[token[cut:]], number)
            for token, number in self.ids.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ids and token[cut:] in self.ids
        ]
        self._fill(np.array(pairs, np.int64).reshape(-1, 3))

    def _fill(self, pairs: np.ndarray) -> None:
        """An open hash table with linear probing, at most a quarter full."""
        size = 1 << max(4, int(len(pairs) * 4 - 1).bit_length())
        self._mask = np.int64(size - 1)
        self._shift = np.uint64(64 - (size - 1).bit_length())
        self._keys = np.full(size, -1, np.int64)
        self._values = np.full(size, _NONE, np.int32)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        left, slots = np.arange(len(keys)), self._slot(keys)
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self._keys[slots[left]] < 0
            chosen = left[free]
            self._keys[slots[chosen]] = keys[chosen]  # of those that want one slot, one wins
            won = chosen[self._keys[slots[chosen]] == keys[chosen]]
            self._values[slots[won]] = pairs[won, 2]
            left = np.setdiff1d(left, won, assume_unique=True)
            slots[left] = (slots[left] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _MIX >> self._shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge; the highest int32 where there is none."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slot(keys)
        found = self._keys[slots]
        out = np.where(found == keys, self._values[slots], _NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0) & (right >= 0) & (left >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & self._mask
            found = self._keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self._values[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def merge_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge a padded (-1) matrix of ids. Returns (ids of all rows, ids per row)."""
        n, width = rows.shape
        lengths = (rows >= 0).sum(axis=1)
        done = rows.copy()
        live = np.arange(n)
        ranks = self.pair_ranks(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(n, width - 1)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            going = best < _NONE
            if not going.all():
                done[live[~going]] = -1
                done[live[~going], :rows.shape[1]] = rows[~going]
                live, rows, ranks, at, best = live[going], rows[going], ranks[going], at[going], best[going]
            if not len(live):
                break
            lengths[live] -= 1
            k = np.arange(len(live))
            rows[k, at] = best
            # Close up: everything right of the merge moves one place left.
            columns = np.arange(rows.shape[1] - 1)
            rows = np.take_along_axis(rows, columns + (columns > at[:, None]), axis=1)
            if rows.shape[1] == 1:
                done[live] = -1
                done[live, :1] = rows
                break
            columns = np.arange(rows.shape[1] - 1)
            ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= at[:, None]), ranks.shape[1] - 1), axis=1)
            last = rows.shape[1] - 1
            has = at < last
            if has.any():
                r, c = k[has], at[has]
                ranks[r, c] = self.pair_ranks(rows[r, c], rows[r, c + 1])
            has = at > 0
            if has.any():
                r, c = k[has], at[has]
                ranks[r, c - 1] = self.pair_ranks(rows[r, c - 1], rows[r, c])
        return done[done >= 0], lengths

    def merge_long(self, piece: bytes) -> list[int]:
        """One long piece: the same merges from a heap of (rank, place)."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pair_ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        none, heap = int(_NONE), []
        current = first + [none]
        heap = [(rank, at) for at, rank in enumerate(first) if rank < none]
        heapq.heapify(heap)

        def rank_of(left: int, right: int) -> int:
            return int(self.pair_ranks(np.array([left], np.int32), np.array([right], np.int32))[0])

        while heap:
            rank, at = heapq.heappop(heap)
            if ids[at] < 0 or current[at] != rank:
                continue
            gone = after[at]
            ids[at], ids[gone] = rank, -1
            after[at] = after[gone]
            current[gone] = none
            if after[at] < n:
                before[after[at]] = at
                current[at] = rank_of(ids[at], ids[after[at]])
                if current[at] < none:
                    heapq.heappush(heap, (current[at], at))
            else:
                current[at] = none
            if before[at] >= 0:
                left = before[at]
                current[left] = rank_of(ids[left], ids[at])
                if current[left] < none:
                    heapq.heappush(heap, (current[left], left))
        return [number for number in ids if number >= 0]

    def encode_matches(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each match of the pattern: itself if it is a token, else by merging its bytes."""
        n = len(matches)
        lengths = np.zeros(n, np.int64)
        sizes = np.fromiter(map(len, matches), np.int64, n)
        known = np.fromiter((self.ids.get(match, -1) for match in matches), np.int64, n)
        lengths[known >= 0] = 1
        flat_parts, order = [known[known >= 0].astype(np.int32)], [np.flatnonzero(known >= 0)]
        low = 1
        for width in WIDTHS:
            bucket = np.flatnonzero((known < 0) & (sizes > low) & (sizes <= width))
            low = width
            for start in range(0, len(bucket), max(1, min(_ROWS, (1 << 20) // width))):
                rows = bucket[start:start + max(1, min(_ROWS, (1 << 20) // width))]
                text = np.frombuffer(b"".join([matches[row] for row in rows.tolist()]), np.uint8)
                matrix = np.full((len(rows), width), -1, np.int32)
                matrix[np.arange(width) < sizes[rows][:, None]] = self.of_byte[text]
                found, counts = self.merge_rows(matrix)
                flat_parts.append(found)
                order.append(rows)
                lengths[rows] = counts
        for row in np.flatnonzero((known < 0) & (sizes > WIDTHS[-1])).tolist():
            found = self.merge_long(matches[row])
            flat_parts.append(np.array(found, np.int32))
            order.append(np.array([row]))
            lengths[row] = len(found)
        rows, flat = np.concatenate(order), np.concatenate(flat_parts)
        starts = np.zeros(n, np.int64)
        starts[rows] = np.cumsum(lengths[rows]) - lengths[rows]
        return flat[ragged(starts, lengths)], lengths

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, one after another."""
        return self.bytes[ragged(self.starts[ids], self.lengths[ids])]


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def _table(path: str, pattern: str) -> PieceTable:
    ranks, split = ranks_of(path), regex.compile(pattern)

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        matches, counts = [], []
        for piece in pieces:
            found = split.findall(piece)
            matches += found
            counts.append(len(found))
        distinct = dict.fromkeys(matches)
        for code, match in enumerate(distinct):
            distinct[match] = code
        ids, lengths = ranks.encode_matches([match.encode() for match in distinct])
        codes = np.fromiter(map(distinct.__getitem__, matches), np.int64, len(matches))
        starts = np.cumsum(lengths) - lengths
        flat = ids[ragged(starts[codes], lengths[codes])]
        owner = np.repeat(np.arange(len(pieces)), counts)
        return flat, np.bincount(owner, weights=lengths[codes], minlength=len(pieces)).astype(np.int64)

    return PieceTable(encode, TABLE_PIECES, TABLE_BYTES)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """(id, ``out``: ARRAY<INT>) for each row: the ids of its whole text, each match of ``pattern``
    encoded apart, without special tokens. ``decoded`` names a BINARY column for the bytes decoded from
    those ids, in the same pass.

    A null or empty text has no ids (an empty array). Null and repeated ids keep a row each. Other
    columns are not carried. An empty table gives no rows. A text of any length is cut at places no
    match crosses, and only its ids are held whole.
    """

    def run(batches):
        table = _table(path, pattern)
        for batch in small_batches(batches, "text", STEP_BYTES):
            texts = batch.column("text").to_pylist()
            found = list(encoded_rows(texts, table, byte_level_pieces, STEP_BYTES))
            rows = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
            ids = np.concatenate([i for _, i in found]) if found else np.zeros(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(texts)))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            columns = {id_col: batch.column("id"), out: lists}
            if decoded:
                columns[decoded] = _decoded(ranks_of(path), lists)
            yield pa.record_batch(columns)

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"{id_col} BIGINT, {out} ARRAY<INT>" + (f", {decoded} BINARY" if decoded else ""))


def _decoded(ranks: Ranks, lists: pa.ListArray) -> pa.BinaryArray:
    counts = np.array(lists.value_lengths().fill_null(0), np.int64)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(ranks.lengths[ids])])[np.concatenate([[0], np.cumsum(counts)])]
    data = pa.py_buffer(ranks.decode(ids).tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), data])


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """(id, ids, ``out``: BINARY): the bytes the ids of each row stand for; none for null or no ids."""

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            yield pa.record_batch({id_col: batch.column("id"), ids_col: lists, out: _decoded(ranks_of(path), lists)})

    rows = tokens.select(tokens[id_col].cast("long").alias("id"), tokens[ids_col].alias("ids"))
    return rows.mapInArrow(run, f"{id_col} BIGINT, {ids_col} ARRAY<INT>, {out} BINARY")
