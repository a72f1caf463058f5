"""Splitting Arrow text columns into hashed words with numpy, without a Python step per word.

A word is a maximal run of characters other than U+0020 and U+0009 to U+000D. Those
are single bytes in UTF-8, so the work is done on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the sequences values[start:end]; equal sequences hash alike wherever they lie."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power(_BASE, n), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """The words of consecutive rows: byte spans, hashes, and the first word of each row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray  # row i has the words rows[i] to rows[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, end to end, and where each row begins; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_table(chosen: bytes) -> np.ndarray:
    """Which of the 256 bytes are among the chosen ones."""
    table = np.zeros(256, bool)
    table[list(chosen)] = True
    return table


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A to Z in lower case."""
    return data + ((data >= ord("A")) & (data <= ord("Z"))).astype(np.uint8) * np.uint8(32)


def split_words(column: pa.Array, separators: np.ndarray = _IS_SPACE) -> Words:
    """The maximal runs of bytes that are not among the separators, a table of the 256 bytes."""
    data, offsets = text_bytes(column)
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(offsets))
    begins[offsets[filled]] = inside[offsets[filled]]
    last = offsets[filled + 1] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets))


def chunks(batch: pa.RecordBatch, text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows with about ``most`` bytes of text, so that arrays stay small."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        done = sizes[first - 1] if first else 0
        after = max(first + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield batch.slice(first, after - first)
        first = after
