"""Token ids of whole texts through a tokenizer file, with every distinct piece encoded once.

Byte-level BPE never merges across the start of a run of white space that follows another character.
So texts are cut there, into a word with the white space before it; equal pieces have equal ids, and
only pieces that are new to the worker pass through the tokenizer, in batches of bounded bytes. The
ids of a text are those of its pieces, one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tradeflow.llm import text_arrays as ta

TOKENIZER = "byte_bpe_50k.json"
BATCH_BYTES = 1 << 20
#: Pieces that a worker remembers, 32 bytes each besides their ids, and text that it looks at together.
REMEMBERED = 500_000
BLOCK_BYTES = 1 << 19


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def safe_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row starts, and starts of ASCII white space after a character that is no white space.

    Other white space (U+0085, U+00A0, U+1680, U+2000 and on, U+3000) has lead bytes C2, E1, E2 or
    E3; after such a lead no cut is made, nor after any other control character.
    """
    cut = ta.is_space(data)
    cut[1:] &= data[:-1] > 32
    cut[2:] &= data[:-2] != 0xC2
    for lead in (0xE1, 0xE2, 0xE3):
        cut[3:] &= data[:-3] != lead
    cut[:1] = False
    starts = offsets[:-1][np.diff(offsets) > 0]
    cut[starts] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes Arrow text columns; keeps the ids of the pieces it has met, up to a bound."""

    remembered = REMEMBERED

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        # The vocabulary writes each byte of a token as one character.
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.token_bytes[number] = len(token)
        self.forget()

    def forget(self) -> None:
        # Known pieces in order of their hash, and the slot of each.
        self.hashes, self.slot_of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def row_ids(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per block of rows: ids of all its rows, and where each row's ids start and the last end."""
        for start, end in ta.blocks(column, BLOCK_BYTES):
            slots, chunk_rows = self._pieces(column.slice(start, end - start))
            lengths = self.lengths[slots]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            ids = self.pool[np.repeat(self.starts[slots] - (ends - lengths), lengths) + np.arange(total)]
            yield ids, np.concatenate([[0], ends])[chunk_rows]

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of ids per row, without making the ids."""
        out = [np.zeros(0, np.int64)]
        for start, end in ta.blocks(column, BLOCK_BYTES):
            slots, chunk_rows = self._pieces(column.slice(start, end - start))
            out.append(np.diff(np.concatenate([[0], np.cumsum(self.lengths[slots])])[chunk_rows]))
        return np.concatenate(out)

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes that are encoded, and starts and ends of the pieces."""
        starts = safe_cuts(data, offsets)
        return data, starts, np.concatenate([starts[1:], [len(data)]]).astype(np.int64)[: len(starts)]

    def _pieces(self, rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A slot per piece, and for each row's start the number of pieces before it."""
        data, offsets = ta.bytes_of(rows)
        data, starts, ends = self._cut(data, offsets)
        named = ta.span_hashes(data, starts, ends)
        if len(self.hashes) + len(named) > self.remembered:
            self.forget()
        unknown = np.flatnonzero(self._found(named)[1])
        if len(unknown):
            new, first = np.unique(named[unknown], return_index=True)
            place = unknown[first]
            slots = np.arange(len(self.hashes), len(self.hashes) + len(new))
            while slots[-1] >= len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
                self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self._learn(data, starts[place], ends[place], slots)
            at = np.searchsorted(self.hashes, new)
            self.hashes, self.slot_of = np.insert(self.hashes, at, new), np.insert(self.slot_of, at, slots)
        return self.slot_of[self._found(named)[0]], np.searchsorted(starts, offsets)

    def _found(self, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash stands among the known ones, and whether it is new."""
        at = np.minimum(np.searchsorted(self.hashes, named), max(len(self.hashes) - 1, 0))
        return at, self.hashes[at] != named if len(self.hashes) else np.ones(len(named), bool)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, slots: np.ndarray) -> None:
        """Encode new pieces: joined where their bounds are safe cuts, one by one elsewhere."""
        # Before the next piece's white space there must be a character that is none.
        joined = ta.is_space(data[starts]) & (data[ends - 1] > 32)
        for back, leads in ((2, (0xC2,)), (3, (0xE1, 0xE2, 0xE3))):
            joined &= ~np.isin(data[np.maximum(ends - back, 0)], leads)
        alone, joined = np.flatnonzero(~joined), np.flatnonzero(joined)
        for group in self._batches(joined, ends - starts):
            self._learn_joined(data, starts[group], (ends - starts)[group], slots[group])
        for group in self._batches(alone, ends - starts):
            texts = [data[starts[k] : ends[k]].tobytes().decode("utf-8") for k in group.tolist()]
            self._store_each(slots[group], self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    @staticmethod
    def _batches(rows: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Rows in groups of about ``BATCH_BYTES`` bytes of text."""
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes[rows]) // BATCH_BYTES)) + 1
        return [group for group in np.split(rows, cuts) if len(group)]

    def _learn_joined(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, slots: np.ndarray) -> None:
        ends = np.cumsum(sizes)
        raw = data[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes()
        encoded = self.tokenizer.encode_batch_fast([raw.decode("utf-8")], add_special_tokens=False)
        ids = np.array(encoded[0].ids, np.uint32)
        token_ends = np.cumsum(self.token_bytes[ids])
        until = np.searchsorted(token_ends, ends, side="right")
        if not np.array_equal(token_ends[until - 1], ends):
            raise ValueError("a token crosses the bounds of a piece")
        self._store(slots, np.diff(until, prepend=0), ids)

    def _store_each(self, slots: np.ndarray, encoded: list) -> None:
        ids = [e.ids for e in encoded]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self._store(slots, counts, np.fromiter((i for own in ids for i in own), np.uint32, int(counts.sum())))

    def _store(self, slots: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.starts[slots] = self.used + np.cumsum(counts) - counts
        self.lengths[slots] = counts
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
