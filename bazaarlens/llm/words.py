"""Words and word runs of Arrow text columns as arrays of 64-bit hashes.

Small helper for tasks that read whole texts: a batch is cut into pieces of rows of about a
megabyte, and all words of a piece are found and hashed in a few array operations. Nulls are
read as empty texts. One text is never cut: a very long one makes a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_random = np.random.default_rng(20240229)
_BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(int(_BASE), -1, 2**64))
_PLACE_FACTORS = _random.integers(1, 2**63, 64, dtype=U64) * U64(2) + U64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Which UTF-8 bytes belong to words. Bytes from 0x80 on are parts of characters beyond ASCII.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = {True: np.ones(1, dtype=U64), False: np.ones(1, dtype=U64)}


def _power_table(size: int, inverse: bool) -> np.ndarray:
    if len(_powers[inverse]) < size:
        steps = np.full(size, _BASE_INVERSE if inverse else _BASE, dtype=U64)
        steps[0] = 1
        _powers[inverse] = np.multiply.accumulate(steps)
    return _powers[inverse]


def text_pieces(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds of the rows in them) of each piece."""
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + most_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def find_words(data: np.ndarray, bounds: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each row's words begin among them (one more at the end)."""
    inside = in_word[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    filled = bounds[:-1][np.diff(bounds) > 0]
    starts[filled] = inside[filled]
    after = bounds[1:][np.diff(bounds) > 0] - 1
    ends[after] = inside[after]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values over all places."""
    values = values ^ (values >> U64(30))
    values *= U64(0xBF58476D1CE4E5B9)
    values ^= values >> U64(27)
    values *= U64(0x94D049BB133111EB)
    values ^= values >> U64(31)
    return values


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial of them, wherever the word stands."""
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE_VALUES[data] * _power_table(len(data) + 1, False)[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power_table(len(data) + 1, True)[starts])


def hash_runs(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words, by the place of its first word; may cross rows."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=U64)
    total = np.full(count, int(length) * int(_BASE) % 2**64, dtype=U64)
    for place in range(length):
        total += mixed(words[place : place + count] + U64(place)) if place >= len(_PLACE_FACTORS) else (
            words[place : place + count] * _PLACE_FACTORS[place]
        )
    return mixed(total)


def as_longs(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
