"""Token ids of a word-level BPE file: texts are cut into words, and every distinct word is encoded once.

The tokenizer drops white space, lower-cases, and never merges across white space or between a letter
and the punctuation mark after it. So a text's ids are those of its pieces, one after the other.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from tradeflow.llm import text_arrays as ta
from tradeflow.llm.tokens import Encoder

WORD_TOKENIZER = "word_bpe_49k.json"
#: Words that a worker remembers: more than an ``Encoder``, as each costs more to encode.
REMEMBERED = 2_000_000
MARKS = np.frombuffer(b".,;:!?", np.uint8)


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals of U+00C0-U+00DE as small letters, which the tokenizer makes them anyway.

    Letters before a byte that may start a combining mark stay, as do all bytes where a special string
    could stand (those are found before lower-casing).
    """
    if b"<|" in data.tobytes():
        return data
    following = np.concatenate([data[1:], [32]])
    plain = (following < 0x80) | (following == 0xC3)
    second = np.concatenate([[False], data[:-1] == 0xC3])
    upper = (data >= 65) & (data <= 90) | second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    return np.where(upper & plain, data | 32, data)


def word_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, cut once more between a letter (A-Z, a-z, U+00C0-U+00FF) and a mark."""
    starts, ends = ta.runs(~ta.is_space(data), offsets)
    if not len(data):
        return starts, ends
    before, lead = np.concatenate([[0], data[:-1]]), np.concatenate([[0, 0], data[:-2]])[: len(data)]
    small = (before | 32 >= 97) & (before | 32 <= 122) & (before < 0x80)
    accented = (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    cut = np.isin(data, MARKS) & (small | accented)
    cut[offsets[:-1][offsets[:-1] < len(data)]] = False
    inside = np.flatnonzero(cut)
    return np.sort(np.concatenate([starts, inside])), np.sort(np.concatenate([ends, inside]))


class WordEncoder(Encoder):
    """An ``Encoder`` whose pieces are words; new ones pass through the tokenizer one by one, in batches of bounded bytes."""

    remembered = REMEMBERED

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = lowered(data)
        return data, *word_pieces(data, offsets)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, slots: np.ndarray) -> None:
        for group in self._batches(np.arange(len(slots)), ends - starts):
            texts = [data[a:b].tobytes().decode("utf-8") for a, b in zip(starts[group].tolist(), ends[group].tolist())]
            self._store_each(slots[group], self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)
