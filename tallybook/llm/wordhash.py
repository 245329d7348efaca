"""Words of whole texts as numpy arrays: bounds and hashes, a megabyte of text at a time.

A word is a run of bytes other than the ASCII white space \\x20 and \\x09-\\x0D, which is the same in
UTF-8 bytes and in characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers have inverses modulo 2 ** 64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, count: int) -> np.ndarray:
    """base ** 0, 1, 2, ... modulo 2 ** 64; those for a chunk are kept."""
    kept = _POWERS.get(int(base))
    if kept is None or len(kept) < count:
        kept = np.full(max(count, CHUNK_BYTES + 1), base, np.uint64)
        kept[0] = 1
        kept = np.cumprod(kept, dtype=np.uint64)
        if len(kept) <= 2 * CHUNK_BYTES:
            _POWERS[int(base)] = kept
    return kept[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them all (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """A hash of values[start:end] for each pair of bounds, by prefix sums of a polynomial modulo 2 ** 64."""
    inverse = _INVERSE if base == _BASE else np.uint64(pow(int(base), -1, 1 << 64))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(base, len(values)), out=prefix[1:])
    shifted = (prefix[end] - prefix[start]) * powers(inverse, len(values) + 1)[start]
    return mix(shifted + (end - start).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


@dataclass
class Words:
    """The words of some documents: document k has words first[k]:first[k + 1]."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def documents(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(self.documents), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return range_hash(LOWER[self.data] if lower else self.data, self.start, self.end)

    def runs(self, length: int) -> np.ndarray:
        """Starts of all runs of ``length`` consecutive words inside one document."""
        left = self.first[1:][self.document()] - np.arange(len(self.start))
        return np.flatnonzero(left >= length)

    def text(self, k: int) -> bytes:
        return self.data[self.offsets[k] : self.offsets[k + 1]].tobytes()


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    space = _SPACE[data]
    edge_before, edge_after = np.empty(len(data), bool), np.empty(len(data), bool)
    edge_before[1:], edge_after[:-1] = space[:-1], space[1:]
    some = offsets[:-1] < offsets[1:]
    edge_before[offsets[:-1][some]] = True
    edge_after[offsets[1:][some] - 1] = True
    start = np.flatnonzero(~space & edge_before)
    end = np.flatnonzero(~space & edge_after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(bounds, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[slice, Words]]:
    """The rows of a column in chunks of about ``most`` bytes; a longer text is a chunk of its own, whole."""
    data, offsets = utf8(column)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        low, high = offsets[at], offsets[to]
        yield slice(at, to), words_of(data[low:high], offsets[at : to + 1] - low)
        at = to
