"""Words of many texts at once, as byte positions and 64-bit hashes.

Texts stay UTF-8 bytes. All word patterns of this package split at ASCII bytes
only, so a byte is enough to tell whether a character belongs to a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: ``[^\\x20\\x09-\\x0D]+``
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, after lower-casing
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


class Powers:
    """Powers of the hash base and of its inverse, grown when a text needs more."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 1))
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


POWERS = Powers()


class Block(NamedTuple):
    """Some rows of a batch: ``data`` holds their texts end to end."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """A text column in blocks of about ``limit`` bytes; a null text is empty.

    A longer text makes a block of its own, so memory follows the longest text.
    """
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    else:
        column = column.cast(pa.string())
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, dtype=wide)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(n, max(high, low + 1))
        start, stop = offsets[low], offsets[high]
        yield Block(low, data[start:stop], offsets[low : high + 1] - start)
        low = high


class Words(NamedTuple):
    """Words of a block: byte spans, and the first word of each row (rows + 1)."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words(block: Block, data: np.ndarray, is_word: np.ndarray) -> Words:
    """Runs of bytes that ``is_word`` marks; a run ends with its row."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = is_word[data]
    if not len(data):
        empty = np.zeros(0, dtype=np.int64)
        return Words(empty, empty, np.zeros(block.rows + 1, dtype=np.int64))
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    cuts = block.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[1:-1][cuts]
    stops[cuts - 1] = inside[1:-1][cuts - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, block.offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one to one)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, from one running sum over the bytes."""
    POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * POWERS.up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * POWERS.down[starts])


# Unrelated multipliers, so that words changing places change the sum.
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size`` neighbouring words; rows are not told apart."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * _PLACE[k]
    return mix(total)
