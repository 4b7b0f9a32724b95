"""Packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import text_arrays as ta
from tradeflow.llm.ordered import place_in_ranges, running_totals
from tradeflow.llm.storage import Store
from tradeflow.llm.tokens import encoder, tokenizer_path

CAPACITY = 2048
END = 0

Pattern = tuple[tuple[int, ...], int]


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document.

    A document's ids are those of its text, then ``END``. One with more than ``capacity`` ids is cut so
    that only its first piece is shorter. Ids never leave the worker.
    """
    path = tokenizer or tokenizer_path()

    @F.arrow_udf("array<struct<piece: int, start: long, length: long, ids_crc32: long>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = encoder(path)
        for batch in batches:
            per_row, parts = [0], []
            for ids, bounds in tokens.row_ids(ta.as_large(batch)):
                for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = np.append(ids[start:end], np.uint32(END)).astype("<u4")
                    size = (len(own) - 1) % capacity + 1
                    at = 0
                    for piece in range(-(-len(own) // capacity)):
                        parts.append((piece, at, size, zlib.crc32(own[at : at + size].tobytes())))
                        at, size = at + size, capacity
                    per_row.append(len(parts))
            table = np.array(parts, np.int64).reshape(-1, 4)
            fields = [pa.array(table[:, 0], pa.int32()), *[pa.array(table[:, k], pa.int64()) for k in (1, 2, 3)]]
            values = pa.StructArray.from_arrays(fields, ["piece", "start", "length", "ids_crc32"])
            yield pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), values)
        ta.give_back()

    return docs.select("doc_id", F.explode(cut("text")).alias("_piece")).select("doc_id", "_piece.*")


def pack_documents(docs: DataFrame, store: Store, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    The plan is made for numbers of pieces per length, at most ``capacity`` of them, which is all that
    reaches the driver: for each length, longest first, one, two or three other lengths that fill the
    rest of a sequence exactly are found by their sum in an index (``Sums``) and consumed as long as there
    are any; what remains is placed best-fit, longest first. Each piece then finds its place by its length and its rank among the pieces of that
    length; ranks come from running totals over ranges, so a length may have any number of pieces.

    A null or empty text is one piece of length 1. Equal rows are packed each. An empty table gives no
    rows. Sequences have no gaps, and no piece is cut but those of documents longer than ``capacity``.
    """
    pieces = store.keep(pieces_of(docs, capacity, tokenizer).withColumn("_one", F.lit(1).cast("long")), "pack-pieces")
    found = pieces.groupBy("length").agg(F.sum("_one").alias("pieces")).collect()
    counts = [0] * (capacity + 1)
    for row in found:
        counts[row["length"]] = row["pieces"]
    slots = Slots(plan(counts, capacity))
    order = [F.col("length"), F.col("doc_id").asc_nulls_first(), F.col("piece"), F.col("ids_crc32")]
    ranked = running_totals(place_in_ranges(pieces, order, store, "pack-order"), order, ["_one"])
    shorter = [0, *accumulate(counts)]

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, position: pa.Array) -> pa.Array:
        lengths = length.to_numpy()
        sequence, offset = slots.find(lengths, position.to_numpy() - np.array(shorter)[lengths])
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    placed = ranked.withColumn("_place", place("length", "_one_before"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_place.*")


class Sums:
    """Sums of one, two and three lengths that are still there, looked up by the gap that they fill exactly.

    Pairs stand in a hash table by their sum, entered when the sum is first asked for; a triple is a length and
    a pair with the rest of the sum. Numbers of pieces only fall, so a pair of which a length has run out
    never comes back and leaves the table when it is met.
    """

    def __init__(self, left: list[int]):
        self.left = left
        self.larger: dict[int, list[int]] = {}

    def singles(self, gap: int) -> Iterator[tuple[int, ...]]:
        if gap > 0 and self.left[gap]:
            yield (gap,)

    def pairs(self, gap: int, most: int | None = None) -> Iterator[tuple[int, ...]]:
        """The larger part first, from the largest down to half the sum; none larger than ``most``."""
        own = self.larger.get(gap)
        if own is None:
            own = self.larger[gap] = self._pairs_of(gap)
        at = len(own) if most is None else bisect_right(own, most)
        while at > 0:
            at -= 1
            first = own[at]
            if self.left[first] and self.left[gap - first]:
                yield first, gap - first
                at = min(at, len(own))
            else:
                del own[at]

    def _pairs_of(self, gap: int) -> list[int]:
        if gap < 2:
            return []
        present = np.array(self.left[: gap]) > 0
        both = present[1:gap] & present[gap - 1 : 0 : -1]
        starts = np.flatnonzero(both) + 1
        return starts[starts >= -(-gap // 2)].tolist()

    def triples(self, gap: int, most: int) -> Iterator[tuple[int, ...]]:
        """The largest part first, none larger than ``most``."""
        for first in range(min(most, gap - 2), 0, -1):
            if self.left[first]:
                for pair in self.pairs(gap - first, first):
                    yield first, *pair
                    if not self.left[first]:
                        break


def plan(counts: Sequence[int], capacity: int = CAPACITY) -> list[Pattern]:
    """Sequences as (lengths, how many such sequences) for ``counts[length]`` pieces of each length.

    Full pieces first, then exact fillings by one, by two and by three others, each for all lengths from
    the longest down; what is left goes best-fit.
    """
    left = list(counts)
    patterns: list[Pattern] = []
    sums = Sums(left)

    def consume(lengths: tuple[int, ...]) -> None:
        times = min(left[size] // n for size, n in Counter(lengths).items())
        if times:
            patterns.append((lengths, times))
            for size in lengths:
                left[size] -= times

    consume((capacity,))
    for fillings in (sums.singles, sums.pairs, lambda gap: sums.triples(gap, capacity - gap)):
        for size in range(capacity - 1, 0, -1):
            if left[size]:
                for lengths in fillings(capacity - size):
                    consume((size, *lengths))
                    if not left[size]:
                        break
    return patterns + _best_fit(left, capacity)


def _best_fit(left: Sequence[int], capacity: int) -> list[Pattern]:
    """Longest first into the sequences with the least room that suffices, many equal ones at a time."""
    by_room: dict[int, list[Pattern]] = defaultdict(list)
    for size in range(capacity, 0, -1):
        n = left[size]
        while n:
            room = min((r for r, have in by_room.items() if r >= size and have), default=None)
            if room is None:
                each = capacity // size
                for fill, times in ((each, n // each), (n % each, 1)):
                    if fill and times:
                        by_room[capacity - fill * size].append(((size,) * fill, times))
                break
            lengths, times = by_room[room].pop()
            used = min(n, times)
            if times > used:
                by_room[room].append((lengths, times - used))
            by_room[room - size].append(((*lengths, size), used))
            n -= used
    return [pattern for have in by_room.values() for pattern in have]


class Slots:
    """For each length, which sequence and offset its first, second, ... piece gets."""

    def __init__(self, patterns: Sequence[Pattern]):
        entries = defaultdict(list)
        given: Counter[int] = Counter()
        sequence = 0
        for lengths, times in patterns:
            at = 0
            for size in lengths:
                entries[size].append((given[size], sequence, at))
                given[size] += times
                at += size
            sequence += times
        self.entries = {size: np.array(rows, np.int64) for size, rows in entries.items()}

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        sizes, first = np.unique(lengths[order], return_index=True)
        for size, own in zip(sizes.tolist(), np.split(order, first[1:])):
            rows = self.entries[size]
            hit = rows[np.searchsorted(rows[:, 0], ranks[own], side="right") - 1]
            sequence[own] = hit[:, 1] + ranks[own] - hit[:, 0]
            offset[own] = hit[:, 2]
        return sequence, offset
