"""Vocabularies of the tokenizers library, loaded once by each Python worker."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from postlake.llm.pieces import PieceTable

# Latin letters and a run of ASCII marks behind them: normalisers change no more than their case, and
# the pattern gives the letters (with the space before them) and the run. The model is asked at once.
_PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: visible Latin-1 characters as themselves, the others,
    in order, as the characters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in visible]
    return {byte: chr(256 + at) for at, byte in enumerate(others)}


_LETTERS = _byte_letters()


@lru_cache(maxsize=4)
def library_table(path: str, lower: bool = False) -> PieceTable:
    """A piece table over the library for the vocabulary at ``path``; ``lower``: it lower-cases texts
    and drops white space, and its pieces are bytes."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use every core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenize = tokenizer.model.tokenize
    runs: dict[str, list[int]] = {"": []}

    def plain(piece: str) -> list[int] | None:
        parts = _PLAIN.fullmatch(piece)
        if parts is None:
            return None
        space, letters, run = parts.groups()
        if lower:
            letters = letters.lower()
        elif space:
            letters = space + letters
        if lower and letters.isascii():
            ids = [token.id for token in tokenize(letters)]
        else:
            ids = [token.id for token in tokenize(letters.encode().decode("latin-1").translate(_LETTERS))]
        if run not in runs:
            if len(runs) > 10_000:
                runs.clear()
                runs[""] = []
            runs[run] = [token.id for token in tokenize(run)]
        return ids + runs[run]

    def encode(pieces: list) -> tuple[np.ndarray, np.ndarray]:
        texts = [piece.decode() for piece in pieces] if lower else pieces
        found = list(map(plain, texts))
        others = [at for at, ids in enumerate(found) if ids is None]
        for start in range(0, len(others), 1024):
            chosen = others[start:start + 1024]
            encoded = tokenizer.encode_batch_fast([texts[at] for at in chosen], add_special_tokens=False)
            for at, one in zip(chosen, encoded):
                found[at] = one.ids
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([number for one in found for number in one], np.int32), lengths

    return PieceTable(encode)
