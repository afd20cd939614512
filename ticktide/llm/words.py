"""Words of whole Arrow text columns as numpy arrays, without one Python object per word.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Those six are single bytes in UTF-8 and never part of another character, so splitting bytes
equals splitting code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
# Fixed odd multiplier of the rolling word hash, and the two multipliers of the 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = {}


def mix(value: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (splitmix64's finaliser)."""
    value = value.astype(np.uint64, copy=True)
    value ^= value >> np.uint64(30)
    value *= np.uint64(MIX[0])
    value ^= value >> np.uint64(27)
    value *= np.uint64(MIX[1])
    return value ^ (value >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))


def _power_table(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known


def text_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The column with nulls as empty texts."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")


def text_slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch that hold at most ``limit`` bytes of text each, or a single row."""
    sizes = np.cumsum(pc.binary_length(text_of(batch, column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        stop = max(int(np.searchsorted(sizes, done + limit, side="right")), at + 1)
        yield batch.slice(at, stop - at)
        at = stop


@dataclass
class Words:
    """Words of several texts: byte ranges in ``data`` and, per text, its range of words."""

    data: np.ndarray   # bytes of all texts, one after the other
    start: np.ndarray  # first byte of each word
    end: np.ndarray    # byte behind each word
    first: np.ndarray  # index of each text's first word, plus the number of words
    offsets: np.ndarray  # first byte of each text, plus the number of bytes

    @property
    def row(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        terms = _BYTE_CODE[self.data]
        terms *= _power_table(BASE, size)[:size]
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        inverse = _power_table(pow(BASE, -1, 1 << 64), size)
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])

    def only(self, wanted: np.ndarray) -> Words:
        """The same words without the bytes that the table of 256 flags leaves out; empty words go."""
        keep = wanted[self.data]
        before = np.zeros(len(keep) + 1, np.int64)
        np.cumsum(keep, out=before[1:])
        start, end = before[self.start], before[self.end]
        full = end > start
        count = np.zeros(len(full) + 1, np.int64)
        np.cumsum(full, out=count[1:])
        return Words(self.data[keep], start[full], end[full], count[self.first], before[self.offsets])

    def per_text(self, counted: np.ndarray) -> np.ndarray:
        """How many bytes that the table of 256 flags marks each text holds."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(counted[self.data], out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def lines(self) -> Words:
        """The lines that hold a word, cut at line feeds, in place of the words."""
        ends = np.union1d(np.flatnonzero(self.data == 10), self.offsets[1:])
        starts = np.union1d(np.flatnonzero(self.data == 10) + 1, self.offsets[:-1])
        line, word = np.unique(np.searchsorted(ends, self.start, side="right"), return_index=True)
        begin, end = starts[np.searchsorted(starts, self.start[word], side="right") - 1], ends[line]
        return Words(self.data, begin, end, np.searchsorted(begin, self.offsets), self.offsets)

    def tokens(self) -> list[bytes]:
        """The words as byte strings."""
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.start.tolist(), self.end.tolist())]


def byte_flags(marked: bytes) -> np.ndarray:
    """A table of 256 flags, set for the given bytes."""
    flags = np.zeros(256, bool)
    flags[list(marked)] = True
    return flags


def words_of(column: pa.Array, lower: bool = False, separator: np.ndarray = _SEPARATOR) -> Words:
    """Split a non-null large_string column at the bytes that the table of 256 flags marks. ``lower`` changes A-Z only."""
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    raw = _LOWER[raw] if lower else raw
    inside = ~separator[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(raw, start, end, np.searchsorted(start, offsets), offsets)


def crc_remainder(ids, modulus: int):
    """Spark column: crc32 of the id as text, modulo; a null id counts as the empty text."""
    from pyspark.sql import functions as F

    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % modulus
