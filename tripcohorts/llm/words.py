"""Words and hashes of many texts at once, with numpy over the bytes of an Arrow column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text in one part; arrays of eight bytes for each of them are held at a time.
PART_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: For each byte its lower-case form, A to Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit values."""
    x = values + np.uint64((seed * 2 + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int, base: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below `count`, kept by the worker."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        known = np.full(max(count, PART_BYTES + 1), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        _powers[base] = known
    return known[:count]


class Rolling:
    """Hashes of any stretches of a byte array, equal for equal bytes, from prefix sums."""

    def __init__(self, data: np.ndarray):
        spread = _BYTE_VALUES[data]
        spread *= powers(len(data), _BASE)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * powers(len(self.sums), _INVERSE)[starts]
        return mixed(raw + (ends - starts).astype(np.uint64))


_BYTE_VALUES = mixed(np.arange(256, dtype=np.uint64), 7)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts after each other, and where each starts (and the last ends)."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind, len(column) + 1 + column.offset)[column.offset :].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of several texts: byte positions, the text each belongs to, and their hashes."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray  # of each text, and the number of all words
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray = WHITE, rolling: Rolling | None = None) -> Words:
    """Longest runs without separators; a word never goes on in the next text."""
    inside = ~separator[data]
    begins = np.ones(len(data) + 1, bool)
    begins[1:-1] = False
    begins[bounds] = True
    starts = np.flatnonzero(inside & (begins[:-1] | ~np.append(False, inside[:-1])[: len(inside)]))
    ends = np.flatnonzero(inside & (begins[1:] | ~np.append(inside[1:], False)[: len(inside)])) + 1
    first = np.searchsorted(starts, bounds)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(starts, ends, text, first, (rolling or Rolling(data)).of(starts, ends))


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each run of `size` words within a text."""
    last = len(words.hashes) - size + 1
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(last, np.uint64)
    for place in range(size):
        total = mixed(total * np.uint64(3) + words.hashes[place : place + last])
    whole = np.flatnonzero(words.text[:last] == words.text[size - 1 :])
    return whole, total[whole]
