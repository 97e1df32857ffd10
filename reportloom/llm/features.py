"""Hashed features of texts, and bounded samples of rows to fit classifiers on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import arrow_step, texts
from .kernels import NOT_ALNUM, mix, slices, strings, words_of

BITS = 18
BUCKETS = 1 << BITS
#: Characters at the end of a word whose kinds (small, capital, digit, or the sign itself) are a feature.
TAIL = 4
_KIND = np.arange(256, dtype=np.uint8)
_KIND[ord("a") : ord("z") + 1] = ord("a")
_KIND[128:] = ord("a")
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("0") : ord("9") + 1] = ord("0")


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _pairs(data: np.ndarray, offsets: np.ndarray, tails: bool) -> np.ndarray:
    """Text number and bucket of each feature occurrence, as text << BITS | bucket."""
    words = words_of(data, offsets, lower=True, gaps=NOT_ALNUM)
    pairs = [(words.owner().astype(np.uint64) << np.uint64(BITS)) | (words.hashes >> np.uint64(64 - BITS))]
    if tails:
        tokens = words_of(data, offsets)
        code = np.zeros(len(tokens.ends), np.uint64)
        for k in range(1, TAIL + 1):
            at = tokens.ends - k
            code = code * np.uint64(256) + np.where(at >= tokens.starts, _KIND[data[np.maximum(at, 0)]], 0).astype(np.uint64)
        pairs.append((tokens.owner().astype(np.uint64) << np.uint64(BITS)) | (mix(code, 1) >> np.uint64(64 - BITS)))
    return np.concatenate(pairs)


def features(column: pa.Array, tails: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For ranges of texts: begin, end, and text (from begin), bucket and count of each feature, sorted by text."""
    data, offsets = strings(column)
    for i, j in slices(offsets):
        own = data[offsets[i] : offsets[j]]
        found, counts = np.unique(_pairs(own, offsets[i : j + 1] - offsets[i], tails), return_counts=True)
        yield i, j, (found >> np.uint64(BITS)).astype(np.int64), (found & np.uint64(BUCKETS - 1)).astype(np.int64), counts


def feature_rows(df: DataFrame, carry: str, tails: bool = False) -> DataFrame:
    """`carry` (a column of longs), and the buckets and counts of each text of `df`."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, j, text, bucket, count in features(batch["text"], tails):
            bounds = pa.array(np.searchsorted(text, np.arange(j - i + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (bucket, count)]
            yield pa.RecordBatch.from_arrays([batch[carry].slice(i, j - i), *lists], [carry, "buckets", "counts"])

    return arrow_step(df, step, f"{carry} long, buckets array<int>, counts array<int>")


def bounded_sample(ids: DataFrame, rows: int) -> DataFrame:
    """At most `rows` rows, chosen by a hash of the id: the same ones in each run."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_texts(docs: DataFrame, sample: DataFrame, carry: str) -> DataFrame:
    """The text of each sampled id; where rows repeat an id, the least of their texts, so that the sample's bound holds for rows too.

    The sample's size is bounded by its parameter, so it is broadcast, and only its texts are shuffled.
    """
    return texts(docs).join(F.broadcast(sample), "doc_id").groupBy("doc_id", carry).agg(F.min("text").alias("text")).select(carry, "text")


class Sparse:
    """Collected feature rows as one sparse matrix, with what a linear model needs of it."""

    def __init__(self, buckets: list, counts: list):
        self.rows = len(buckets)
        lengths = np.array([len(b) for b in buckets], np.int64)
        self.row = np.repeat(np.arange(self.rows), lengths)
        self.column = np.concatenate([np.asarray(b, np.int64) for b in buckets]) if self.rows else np.zeros(0, np.int64)
        self.count = np.concatenate([np.asarray(c, np.float64) for c in counts]) if self.rows else np.zeros(0)
        self.value = np.ones(len(self.column))

    @classmethod
    def collected(cls, table: pa.Table) -> Sparse:
        """From feature rows collected as Arrow; no Python object is made for a number."""
        buckets, counts = (table[name].combine_chunks() for name in ("buckets", "counts"))
        out = cls([], [])
        out.rows = len(buckets)
        out.row = np.repeat(np.arange(out.rows), buckets.value_lengths().to_numpy(zero_copy_only=False))
        out.column = buckets.flatten().to_numpy().astype(np.int64)
        out.count = counts.flatten().to_numpy().astype(np.float64)
        out.value = np.ones(len(out.column))
        return out

    def keep_frequent(self, least: int) -> None:
        self.keep(np.bincount(self.column, minlength=BUCKETS)[self.column] >= least)

    def keep(self, kept: np.ndarray) -> None:
        self.row, self.column, self.count, self.value = self.row[kept], self.column[kept], self.count[kept], self.value[kept]

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column] * self.value, minlength=self.rows)

    def gradient(self, slopes: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, slopes[self.row] * self.value, minlength=BUCKETS)


class Adam:
    """Steps for one parameter vector."""

    def __init__(self, size: int, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, np.zeros(size), np.zeros(size)

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient**2 - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
