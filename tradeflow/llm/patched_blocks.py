"""Patched frame-of-reference blocks of unsigned 32-bit numbers.

A block holds up to ``BLOCK`` numbers as differences from its minimum, each packed into the block's
width. Differences that need more bits are exceptions: their low bits are packed like the others, their
places and high bits follow in two lists. The width is that of the percentile, out of ``PERCENTILES``,
that makes the block smallest.

A block's bytes: minimum (u32), numbers (u16), exceptions (u16), width (u8), packed bits (lowest first),
exception places (u16 each), exception high bits (u32 each). All numbers are little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 1024
PERCENTILES = (75, 90, 95, 98, 99, 100)
HEAD = struct.Struct("<IHHB")
EXCEPTION_BITS = 48


def _bit_lengths(x: np.ndarray) -> np.ndarray:
    """Bits that each number below 2**32 needs, from the exponent of its double."""
    return np.maximum((x.astype(np.float64).view(np.int64) >> 52) - 1022, 0)


def _overlaps(width: int) -> list[tuple[int, int, int]]:
    """(number, byte, shift) of every number of eight that shares bits with a byte of the ``width`` they are packed into."""
    return [(k, byte, 8 * byte - k * width) for k in range(8) for byte in range(k * width // 8, -(-(k + 1) * width // 8))]


def _pack_bits(rows: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each number, one after the other, per row; eight numbers fill ``width`` bytes."""
    count = rows.shape[1]
    rows = np.pad(rows, ((0, 0), (0, -count % 8))) & np.uint32((1 << width) - 1)
    eights = np.ascontiguousarray(rows.reshape(-1, 8).T)
    packed = np.zeros((width, eights.shape[1]), np.uint8)
    for k, byte, shift in _overlaps(width):
        part = eights[k] >> np.uint32(shift) if shift >= 0 else eights[k] << np.uint32(-shift)
        packed[byte] |= part.astype(np.uint8)
    return np.ascontiguousarray(packed.T).reshape(len(rows), -1)[:, : -(-count * width // 8)]


def _unpack_bits(packed: np.ndarray, count: int, width: int) -> np.ndarray:
    eights = -(-count // 8)
    packed = np.pad(packed, ((0, 0), (0, eights * width - packed.shape[1])))
    columns = np.ascontiguousarray(packed.reshape(-1, width).T).astype(np.uint32)
    numbers = np.zeros((8, columns.shape[1]), np.uint32)
    for k, byte, shift in _overlaps(width):
        numbers[k] |= columns[byte] << np.uint32(shift) if shift >= 0 else columns[byte] >> np.uint32(-shift)
    numbers &= np.uint32((1 << width) - 1)
    return np.ascontiguousarray(numbers.T).reshape(len(packed), -1)[:, :count]


def encode(numbers: np.ndarray) -> list[bytes]:
    """The blocks of ``numbers`` (uint32); only the last may be shorter."""
    numbers = np.asarray(numbers, np.uint32)
    full = len(numbers) // BLOCK
    blocks = _encode_rows(numbers[: full * BLOCK].reshape(full, BLOCK)) if full else []
    if len(numbers) > full * BLOCK:
        blocks += _encode_rows(numbers[None, full * BLOCK :])
    return blocks


def _encode_rows(rows: np.ndarray) -> list[bytes]:
    least = rows.min(axis=1)
    over, size = rows - least[:, None], rows.shape[1]
    bits = _bit_lengths(over) + 33 * np.arange(len(rows))[:, None]
    within = np.cumsum(np.bincount(bits.ravel(), minlength=33 * len(rows)).reshape(-1, 33), axis=1)
    widths = np.stack([(within < -(-size * p // 100)).sum(axis=1) for p in PERCENTILES], axis=1)
    beyond = size - np.take_along_axis(within, widths, axis=1)
    best = np.argmin(widths * size + beyond * EXCEPTION_BITS, axis=1)
    width = widths[np.arange(len(rows)), best]
    out: list[bytes] = [b""] * len(rows)
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        packed = _pack_bits(over[own], w)
        high = over[own] >> w if w < 32 else np.zeros_like(over[own])
        row, place = np.nonzero(high)
        cuts = np.searchsorted(row, np.arange(len(own) + 1))
        places, highs = place.astype("<u2"), high[row, place].astype("<u4")
        for k, block in enumerate(own.tolist()):
            a, b = cuts[k], cuts[k + 1]
            head = HEAD.pack(int(least[block]), size, b - a, w)
            out[block] = b"".join((head, packed[k].tobytes(), places[a:b].tobytes(), highs[a:b].tobytes()))
    return out


def decode(blocks: list[bytes]) -> np.ndarray:
    """The numbers of consecutive blocks."""
    heads = [HEAD.unpack_from(b) for b in blocks]
    ends = np.cumsum([h[1] for h in heads])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
    groups: dict[tuple[int, int], list[int]] = {}
    for k, (_, size, _, width) in enumerate(heads):
        groups.setdefault((size, width), []).append(k)
    for (size, width), own in groups.items():
        length = -(-size * width // 8)
        packed = np.stack([np.frombuffer(blocks[k], np.uint8, length, HEAD.size) for k in own]) if length else np.zeros((len(own), 0), np.uint8)
        rows = _unpack_bits(packed, size, width) if width else np.zeros((len(own), size), np.uint32)
        for row, k in zip(rows, own):
            least, _, exceptions, _ = heads[k]
            if exceptions:
                places = np.frombuffer(blocks[k], "<u2", exceptions, HEAD.size + length)
                row[places] |= np.frombuffer(blocks[k], "<u4", exceptions, HEAD.size + length + 2 * exceptions).astype(np.uint32) << np.uint32(width)
            out[ends[k] - size : ends[k]] = row + np.uint32(least)
    return out
