"""Simple-8b word-aligned coding of unsigned integers, and the shard file made of it.

A 64-bit word holds a selector in its top 4 bits and, below, as many values as the selector says, the
first in the lowest bits. A value of 61 bits or more does not fit any word: selector 0 stands for one
such value, kept whole in the block's escapes. Values are coded in blocks of a fixed number; the
offsets of each block's words and escapes let any run of blocks be decoded alone, all words at once.

Shard file, little endian: magic ``S8B1``, u32 values per block, u64 counts (documents, ids, words,
escapes); then i64 document ids, u8 null marks, u64 document offsets (documents + 1), u64 word offsets
and u64 escape offsets (blocks + 1 each), u64 words, u64 escapes.
"""

from __future__ import annotations

import struct

import numpy as np


#: Values per word and bits per value of selectors 1 to 14; selector 0 marks an escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
BLOCK = 4096
#: The selector of most values per word for values of so many bits; 255: an escape.
_NARROWEST = np.append(np.searchsorted(BITS[1:], np.arange(61)) + 1, [255] * 5).astype(np.uint8)
_MAGIC = b"S8B1"
_HEAD = struct.Struct("<4sIQQQQ")


def encode(values: np.ndarray, block: int = BLOCK, at_once: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block, escapes, escape offset of each block); ``at_once`` blocks are
    packed together, which bounds what packing holds besides the values and the words."""
    size = at_once * block
    parts = [_encode(values[start:start + size], block) for start in range(0, max(1, len(values)), size)]
    words, offsets, escapes, escape_offsets = zip(*parts)

    def joined(starts: tuple[np.ndarray, ...]) -> np.ndarray:
        ends = np.cumsum([0, *(int(one[-1]) for one in starts)])
        return np.concatenate([[0], *(one[1:] + end for one, end in zip(starts, ends))]).astype(np.int64)

    return np.concatenate(words), joined(offsets), np.concatenate(escapes), joined(escape_offsets)


def _encode(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // block)
    offsets = np.zeros(blocks + 1, np.int64)
    if n == 0:
        return np.zeros(0, np.uint64), offsets, np.zeros(0, np.uint64), offsets.copy()
    # The narrowest selector each value fits (0: none), in rows of one block; then, per selector, the
    # widest value of each run of its length, built up from runs of half the length.
    width = np.full((blocks, block), 255, np.uint8)
    width.ravel()[:n] = _NARROWEST[np.frexp(values.astype(np.float64))[1]]
    selector = np.zeros((blocks, block), np.int8)
    runs = {1: width}
    for choice in range(14, 0, -1):  # the last that fits takes most values
        count = int(COUNTS[choice])
        if count > block:
            continue
        half = 1 << (count - 1).bit_length() - 1 if count > 1 else 1
        if half * 2 not in runs and half > 1 and half not in runs:
            runs[half] = np.maximum(runs[half // 2][:, :-(half // 2)], runs[half // 2][:, half // 2:])
        lower = runs[half]
        widest = np.maximum(lower[:, :lower.shape[1] - (count - half)], lower[:, count - half:]) if count > half else lower
        selector[:, :block - count + 1][widest <= choice] = choice
    selector = selector.ravel()[:n]
    step = COUNTS[selector]
    # All blocks walk from word to word together.
    at = np.arange(blocks) * block
    last = np.minimum(at + block, n)
    first = np.zeros(n, bool)
    while len(at):
        first[at] = True
        at = at + step[at]
        going = at < last
        at, last = at[going], last[going]
    starts = np.flatnonzero(first)
    chosen = selector[starts].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for choice in np.unique(chosen):
        if choice == 0:
            continue
        rows = np.flatnonzero(chosen == choice)
        for slot in range(COUNTS[choice]):
            words[rows] |= values[starts[rows] + slot] << np.uint64(slot * BITS[choice])
    escaped = starts[chosen == 0]
    offsets[1:] = np.cumsum(np.bincount(starts // block, minlength=blocks))
    escape_offsets = np.zeros(blocks + 1, np.int64)
    escape_offsets[1:] = np.cumsum(np.bincount(escaped // block, minlength=blocks))
    return words, offsets, values[escaped], escape_offsets


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values of a run of whole blocks, given its words and its escapes."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for choice in np.unique(chosen):
        rows = np.flatnonzero(chosen == choice)
        if choice == 0:
            out[starts[rows]] = escapes
            continue
        mask = np.uint64((1 << int(BITS[choice])) - 1)
        for slot in range(COUNTS[choice]):
            out[starts[rows] + slot] = (words[rows] >> np.uint64(slot * BITS[choice])) & mask
    return out


def pack_shard(doc_ids: list, lengths: np.ndarray, values: np.ndarray, block: int = BLOCK) -> bytes:
    """One shard file; ``lengths`` are the values of each document."""
    words, offsets, escapes, escape_offsets = encode(values, block)
    nulls = np.array([doc is None for doc in doc_ids], np.uint8)
    ids = np.array([0 if doc is None else doc for doc in doc_ids], np.int64)
    doc_offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    return b"".join([
        _HEAD.pack(_MAGIC, block, len(ids), len(values), len(words), len(escapes)),
        ids.astype("<i8").tobytes(), nulls.tobytes(), doc_offsets.tobytes(), offsets.astype("<u8").tobytes(),
        escape_offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes(),
    ])


class Shard:
    """A shard file read back; documents are decoded from the blocks that hold them."""

    def __init__(self, data: bytes):
        magic, self.block, docs, self.n_ids, words, escapes = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a Simple-8b shard")
        blocks = -(-self.n_ids // self.block)
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        ids, nulls = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if null else doc for doc, null in zip(ids.tolist(), nulls.tolist())]
        self.doc_offsets = take("<u8", docs + 1).astype(np.int64)
        self._offsets = take("<u8", blocks + 1).astype(np.int64)
        self._escape_offsets = take("<u8", blocks + 1).astype(np.int64)
        self._words, self._escapes = take("<u8", words), take("<u8", escapes)

    def values(self, start: int, stop: int) -> np.ndarray:
        """The values at places ``start`` to ``stop`` of the shard."""
        if stop <= start:
            return np.zeros(0, np.uint64)
        low, high = start // self.block, -(-stop // self.block)
        found = decode(
            self._words[self._offsets[low]:self._offsets[high]],
            self._escapes[self._escape_offsets[low]:self._escape_offsets[high]],
        )
        return found[start - low * self.block:stop - low * self.block]

    def documents(self):
        """(document id, values) in file order, decoding about a million values at a time."""
        docs, first = len(self.doc_ids), 0
        while first < docs:
            last = int(np.searchsorted(self.doc_offsets, self.doc_offsets[first] + (1 << 20), side="right")) - 1
            last = min(max(last, first + 1), docs)
            base = int(self.doc_offsets[first])
            found = self.values(base, int(self.doc_offsets[last]))
            for doc in range(first, last):
                yield self.doc_ids[doc], found[int(self.doc_offsets[doc]) - base:int(self.doc_offsets[doc + 1]) - base]
            first = last


__all__ = ["BLOCK", "Shard", "decode", "encode", "pack_shard"]
