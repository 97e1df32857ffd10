"""Vectorised text kernels on the bytes of an Arrow string column: words, window hashes, anchors.

A hash of a run of values is a polynomial modulo 2**64, cut out of running sums, so each window costs a constant. Texts
are worked on in slices of a quarter of a megabyte: memory follows the slice, or the longest single text, never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
#: Sliding minima are taken in segments, so that a position within one fits in the low bits of its key.
SEGMENT, POSITION_BITS = 1 << 22, 23
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Separators for words as features: everything in ASCII but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[key] = np.multiply.accumulate(steps)
    return _powers[key][:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running_sums(values: np.ndarray) -> np.ndarray:
    """Weighted running sums of `values`, for `spans`."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(values)), out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of `values[start:end]` for each pair; equal runs have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts], salt)


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    n, (_, offsets, data) = len(column), column.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about SLICE_BYTES, or a single longer text."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1)
        yield start, min(end, n)
        start = min(end, n)


@dataclass
class Words:
    """Words of some texts in a row: byte spans, hashes, and for each text the index of its first word (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def window_starts(self, n: int) -> np.ndarray:
        """Words at which `n` words of one text start."""
        room = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(room >= n)

    def windows(self, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all windows of `n` words within a text."""
        at = self.window_starts(n)
        return at, spans(running_sums(self.hashes), at, at + n, salt)


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False, gaps: np.ndarray = SPACES) -> Words:
    """Words between the bytes in `gaps`, by default `[^\\x20\\x09-\\x0D]+`; `lower` hashes them without regard to ASCII case."""
    inside = ~gaps[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, spans(running_sums(LOWER[data] if lower else data), starts, ends), np.searchsorted(starts, offsets))


@dataclass
class Anchors:
    """One window of `grams` neighbouring grams has its smallest gram at `at`; `low` to `high` are the windows with that one."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


def anchors_of(hashes: np.ndarray, first: np.ndarray, grams: int) -> Anchors:
    """The smallest of each `grams` neighbouring hashes, the leftmost of equals. `first` bounds the texts' hashes.

    Which one it is depends on the window's content alone, so equal windows have their anchor at the same offset.
    """
    n = len(hashes)
    parts = []
    low_bits = np.uint64((1 << POSITION_BITS) - 1)
    limit = np.repeat(first[1:], np.diff(first))  # end of the text of each hash
    for begin in range(0, n, SEGMENT):
        end = min(n, begin + SEGMENT + grams - 1)
        if end - begin < grams:
            break
        key = (hashes[begin:end] & ~low_bits) | np.arange(end - begin, dtype=np.uint64)
        span = 1
        while span * 2 <= grams:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        size = end - begin - grams + 1
        least = np.minimum(key[:size], key[grams - span : grams - span + size])
        start = np.arange(begin, begin + size)
        whole = start + grams <= limit[start]
        start, at = start[whole], (least[whole] & low_bits).astype(np.int64) + begin
        parts.append((start, at))
    start = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    at = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    i = np.flatnonzero(new)
    return Anchors(at[i], start[i], start[np.append(i[1:], len(at)) - 1] if len(i) else start[i])


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
