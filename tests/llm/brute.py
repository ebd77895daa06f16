"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import base64
import re

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ranks_encoding(name="byte_bpe_multi_50k.tiktoken"):
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def smallest_reachable(n, linked):
    """Of ``n`` places, the smallest reachable over the pairs of ``linked``."""
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in linked:
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    return [root(x) for x in range(n)]


def near_groups(prints, budget=2):
    """Component of each row by fingerprints that differ in at most ``budget`` bits."""
    values = np.array(prints, np.uint64)
    linked = []
    for at in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values[at + 1:] ^ values[at]) <= budget)
        linked += [(at, at + 1 + int(other)) for other in near]
    return smallest_reachable(len(values), linked)


def repeated_words(words):
    """Words in 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    covered = set()
    for at, window in enumerate(windows):
        if windows.count(window) > 1:
            covered |= {at, at + 1, at + 2}
    return len(covered)
