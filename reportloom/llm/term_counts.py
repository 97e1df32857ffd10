"""Counting the terms of many texts with numpy: terms packed into 64-bit words, radix-sorted and run-counted.

A term is a run of ASCII letters and of characters beyond ASCII, its A-Z lower-cased. One of at most 8 bytes is a word of 64 bits,
one of at most 16 bytes two such words (big-endian, filled with zero bytes, so numbers sort like bytes; no term holds a zero byte).
These lengths are two buckets, sorted by stable passes over 16-bit digits. Longer terms go into buckets of at most twice
their length in bytes and are sorted there as bytes. Equal neighbours are counted: occurrences and documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .kernels import LOWER, strings

#: Text worked on at a time. A longer single text is taken alone.
CHUNK_BYTES = 8 << 20
WORD = 8

TERM_BYTE = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


def term_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each term and the byte after its last one; a term ends with its text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = TERM_BYTE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (cut | ~inside[:-1])).astype(np.int32)  # Spark's texts end below 2**31 bytes
    return starts, np.flatnonzero(inside[:-1] & (cut | ~inside[1:])).astype(np.int32)


def packed(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first `lengths` (at most 8) bytes from each start as one number; `padded` has 8 bytes to spare."""
    every = np.ndarray((len(padded) - WORD + 1,), ">u8", padded, strides=(1,))
    unused = ((WORD - lengths) * 8).astype(np.uint64)
    return every[starts].astype(np.uint64) >> unused << unused


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by unsigned columns, the last one first in rank: passes over 16-bit digits, constant digits left out."""
    order = np.arange(len(columns[0]), dtype=np.int32)
    for column in columns:
        for shift in range(0, column.dtype.itemsize * 8, 16):
            digit = (column >> column.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def counted_runs(columns: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row of each run of equal rows, its rows, and its different documents (which ascend within a run)."""
    if not len(docs):
        return (np.zeros(0, np.int64),) * 3
    new = np.ones(len(docs), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    new[1:] |= docs[1:] != docs[:-1]
    return at, np.diff(np.append(at, len(docs))), np.add.reduceat(new.astype(np.int64), at)


def group_terms(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes] | None, np.ndarray, np.ndarray]]:
    """Group, first word, second word, long terms (None in the packed buckets), occurrences and documents of each term of each group.

    `groups` gives each text's group, a small number.
    """
    data = LOWER[data]
    starts, ends = term_places(data, offsets)
    padded = np.concatenate([data, np.zeros(2 * WORD, np.uint8)])
    doc = np.searchsorted(offsets, starts, "right").astype(np.int32) - np.int32(1)
    lengths = ends - starts
    group = groups.astype(np.uint32)
    for least, most in ((1, WORD), (WORD + 1, 2 * WORD)):
        pick = np.flatnonzero((lengths >= least) & (lengths <= most))
        first = packed(padded, starts[pick], np.minimum(lengths[pick], WORD))
        columns = [first, group[doc[pick]]]
        if least > 1:
            columns.insert(0, packed(padded, starts[pick] + WORD, lengths[pick] - WORD))
        order = radix_order(columns)
        columns = [c[order] for c in columns]
        at, n, docs = counted_runs(columns, doc[pick][order])
        second = columns[0][at] if least > 1 else np.zeros(len(at), np.uint64)
        yield columns[-1][at], columns[-2][at], second, None, n, docs
    longer = np.flatnonzero(lengths > 2 * WORD)
    size = np.ceil(np.log2(np.maximum(lengths[longer], 2))).astype(np.int64)
    raw = memoryview(data)
    for bits in np.unique(size):
        pick = longer[size == bits]
        terms = np.array([bytes(raw[a:b]) for a, b in zip(starts[pick], ends[pick], strict=True)], f"S{1 << int(bits)}")
        order = np.argsort(terms, kind="stable")
        order = order[radix_order([group[doc[pick]][order]])]
        columns = [terms[order], group[doc[pick]][order]]
        at, n, docs = counted_runs(columns, doc[pick][order])
        none = np.zeros(len(at), np.uint64)
        yield columns[1][at], none, none, columns[0][at].tolist(), n, docs


class TermCounter:
    """Takes batches of `lang`, `source`, `text` and gives batches of counts, one chunk of text at a time."""

    SCHEMA = "lang string, source string, w1 long, w2 long, long_term binary, n long, n_docs long"
    NAMES = ["lang", "source", "w1", "w2", "long_term", "n", "n_docs"]

    def __init__(self) -> None:
        self._groups: dict[tuple[str, str], int] = {}
        self._parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._bytes = 0

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = strings(batch["text"])
        pairs = zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True)
        groups = np.array([self._groups.setdefault(pair, len(self._groups)) for pair in pairs], np.int64)
        i = 0
        while i < len(groups):
            j = int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES - self._bytes, "right")) - 1
            j = min(max(j, i if self._bytes else i + 1), len(groups))
            if j > i:
                self._parts.append((data[offsets[i] : offsets[j]], np.diff(offsets[i : j + 1]), groups[i:j]))
                self._bytes += int(offsets[j] - offsets[i])
            if j < len(groups):
                yield from self.flush()
            i = j

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self._parts:
            return
        data, sizes, groups = (np.concatenate(x) for x in zip(*self._parts, strict=True))
        names = list(self._groups)
        self._groups, self._parts, self._bytes = {pair: i for i, pair in enumerate(names)}, [], 0
        langs, sources = (pa.array([pair[k] for pair in names], pa.string()) for k in (0, 1))
        for group, first, second, longs, n, docs in group_terms(data, np.append(0, np.cumsum(sizes)), groups):
            for at in range(0, len(n), 50_000):
                cut = slice(at, at + 50_000)
                own = pa.array(group[cut].astype(np.int64))
                long_terms = pa.nulls(len(own), pa.binary()) if longs is None else pa.array(longs[cut], pa.binary())
                numbers = [pa.array(x[cut].view(np.int64)) for x in (first, second)]
                counts = [pa.array(x[cut].astype(np.int64)) for x in (n, docs)]
                yield pa.RecordBatch.from_arrays([langs.take(own), sources.take(own), *numbers, long_terms, *counts], self.NAMES)
