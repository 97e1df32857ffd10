"""Substring deduplication by word windows, level by level: windows that repeat are extended to twice their length.

A level looks at windows of half its length, one of each neighbourhood: among the half windows of every full window the
one with the smallest hash is its anchor, so equal full windows have equal anchors. Only anchors found in two documents survive;
they are extended to the full windows around them. Equal surroundings of an anchor (a context) are told apart by
hash alone and pre-aggregated; only where an anchor has several contexts are their full windows compared one by one, again by hash.

The first level goes from half the wanted length to that length, and decides what is removed. Windows that repeat there alone are
extended further: the runs of words they cover are cut out, equal runs become one row that knows its first and last document, and
the levels of twice, four times, ... the length look at what is left of these runs until no candidates survive. They give the
longest repeated length of each text, and never the removal, as a longer window could not remove anything more.

A word goes if a window of `words` words that covers it also starts in a document with a smaller doc_id. Cases: a null text is
empty; texts shorter than a window stay whole; rows that agree in doc_id are one document (neither has the smaller id); a null
doc_id comes after all others; an empty table gives an empty result; further columns are ignored or kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import arrow_step, text_key, texts, written
from .kernels import anchors_of, as_long, mix, running_sums, slices, spans, strings, words_of

WINDOW_WORDS = 50
LAST = 2**63 - 1
_CONTEXT = ["a", "f", "first_rank", "last_rank"]


def _source(docs: DataFrame) -> DataFrame:
    """Texts with the first and the last document they stand in, which are the same at the first level."""
    rank = F.coalesce("doc_id", F.lit(LAST))
    return texts(docs).withColumns({"key": text_key(F.col("text")), "rank": rank, "last": rank})


def _anchors(source: DataFrame, words: int) -> DataFrame:
    """`rank`, `last`, `key`, the anchor's hash `a`, its context's hash `f`, and the first and last full window around it."""
    half = words // 2

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = strings(batch["text"])
        carried = [batch[name].to_numpy() for name in ("rank", "last", "key")]
        for i, j in slices(offsets):
            found = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            at, grams = found.windows(half, 1)
            first = np.searchsorted(at, found.first)
            spots = anchors_of(grams, first, words - half + 1)
            sums = running_sums(found.hashes)
            place, low, high = at[spots.at], at[spots.low], at[spots.high]
            context = mix(spans(sums, low, high + words, 2) + (place - low).astype(np.uint64), 3)
            text = np.searchsorted(found.first, place, "right") - 1
            start = found.first[text]
            columns = [*(c[i + text] for c in carried), as_long(grams[spots.at]), as_long(context), (low - start).astype(np.int32), (high - start).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rank", "last", "key", "a", "f", "low", "high"])

    return arrow_step(source.select("text", "rank", "last", "key"), step, "rank long, last long, key long, a long, f long, low int, high int")


def _windows(wanted: DataFrame, words: int) -> DataFrame:
    """Hashes of the full windows of each listed context: `a`, `f`, its first and last document, `k` (window from the first one) and `h`."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = strings(batch["text"])
        lists = batch["contexts"]
        for i, j in slices(offsets):
            found = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            sums = running_sums(found.hashes)
            rows = lists.slice(i, j - i)
            own = rows.flatten()
            low, high = own.field("low").to_numpy(), own.field("high").to_numpy()
            start = np.repeat(found.first[:-1], rows.value_lengths().to_numpy())
            size = (high - low + 1).astype(np.int64)
            k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = np.repeat(start + low, size) + k
            row = np.repeat(np.arange(len(own)), size)
            take = [own.field(name).take(pa.array(row)) for name in _CONTEXT]
            yield pa.RecordBatch.from_arrays([*take, pa.array(k.astype(np.int32)), pa.array(as_long(spans(sums, at, at + words, 4)))], [*_CONTEXT, "k", "h"])

    return arrow_step(wanted, step, "a long, f long, first_rank long, last_rank long, k int, h long")


def _level(source: DataFrame, words: int) -> DataFrame:
    """Runs of words (first one, one after the last) of texts with any; runs may overlap, and each is a window or several.

    `rank`, `key`, `shared` (windows that another document has) and `runs` (windows that a document before `rank` has).
    """
    every = _anchors(source, words)
    repeated = every.groupBy("a").agg(F.min("rank").alias("least"), F.max("last").alias("most")).where("least < most").select("a")
    survivors = written(every.join(written(repeated, "repeated-keys"), "a"), "repeated-anchors")
    contexts = survivors.groupBy("a", "f").agg(
        F.min("rank").alias("first_rank"), F.max("last").alias("last_rank"), F.min_by(F.struct("rank", "key", "low", "high"), "rank").alias("seen")
    )
    contexts = written(contexts, "contexts")
    several = contexts.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    listed = F.collect_list(F.struct(*_CONTEXT, "seen.low", "seen.high")).alias("contexts")
    lists = contexts.join(written(several, "several-contexts"), "a").groupBy("seen.rank", "seen.key").agg(listed)
    windows = written(_windows(source.select("rank", "key", "text").join(lists, ["rank", "key"]).select("text", "contexts"), words), "context-windows")
    repeats = windows.groupBy("a", "h").agg(F.min("first_rank").alias("least"), F.max("last_rank").alias("most")).where("least < most").select("a", "h", "least")
    places = windows.join(repeats, ["a", "h"]).groupBy("a", "f").agg(
        F.collect_list("k").alias("several"), F.collect_list(F.when(F.col("least") < F.col("first_rank"), F.col("k"))).alias("early")
    )
    # Where the context stands in an earlier document as well, all its windows go; in its first document only the early ones.
    first = contexts.select(*_CONTEXT).join(places, ["a", "f"], "left")
    joined = survivors.join(written(first, "first-places"), ["a", "f"])
    whole = F.array(F.struct(F.col("low").alias("start"), (F.col("high") + words).alias("end")))

    def parts(windows: str) -> Column:
        return F.transform(windows, lambda k: F.struct((F.col("low") + k).alias("start"), (F.col("low") + k + words).alias("end")))

    shared = F.when(F.col("first_rank") < F.col("last_rank"), whole).otherwise(parts("several"))
    runs = F.when(F.col("rank") > F.col("first_rank"), whole).otherwise(parts("early"))
    found = joined.select("rank", "key", shared.alias("shared"), runs.alias("runs")).where("shared is not null")
    return found.groupBy("rank", "key").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("shared", "runs")))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of `n` places lie in any of the runs."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def _inside(n: int, runs: pa.ListScalar) -> np.ndarray:
    return covered(n, runs.values.field("start").to_numpy(), runs.values.field("end").to_numpy())


def _cut(found: DataFrame, words: int, *carry: str) -> DataFrame:
    """The columns in `carry` (longs) and, as `text`, each run of at least `words` words that `shared` covers."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = strings(batch["text"])
        for i, j in slices(offsets):
            row, cut = [], []
            for at in range(i, j):
                own = data[offsets[at] : offsets[at + 1]].tobytes().split()
                inside = _inside(len(own), batch["shared"][at])
                edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
                for start, end in edges.reshape(-1, 2):
                    if end - start >= words:
                        row.append(at)
                        cut.append(b" ".join(own[start:end]))
            columns = [batch[c].take(pa.array(row, pa.int64())) for c in carry]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.binary()).cast(pa.string())], [*carry, "text"])

    kept = found.select(*carry, "text", "shared")
    return arrow_step(kept, step, "".join(f"{c} long, " for c in carry) + "text string").withColumn("piece", text_key(F.col("text")))


def _longest(source: DataFrame, found: DataFrame, words: int) -> DataFrame:
    """`rank`, `key` and `longest`: the length of the last level at which the text has a window that another document has."""
    pieces = written(_cut(source.join(found, ["rank", "key"]), 2 * words, "rank", "key"), "repeated-runs")
    once = pieces.groupBy("piece").agg(F.min("rank").alias("rank"), F.max("rank").alias("last"), F.any_value("text").alias("text"))
    now = written(once.select(F.col("piece").alias("root"), "rank", "last", F.col("piece").alias("key"), "text"), "distinct-runs")
    reached = found.select("rank", "key", F.lit(words).cast("long").alias("longest"))
    levels = []
    while not now.isEmpty():
        words *= 2
        longer = written(_level(now, words).select("rank", "key", "shared"), "longer-runs")
        both = now.join(longer, ["rank", "key"])
        levels.append(both.select("root", F.lit(words).cast("long").alias("longest")))
        now = written(_cut(both, 2 * words, "root", "rank", "last").withColumnRenamed("piece", "key"), "distinct-runs")
    if levels:
        deepest = written(reduce(DataFrame.unionByName, levels).groupBy("root").agg(F.max("longest").alias("longest")), "longest")
        members = pieces.select("rank", "key", F.col("piece").alias("root"))
        reached = reached.unionByName(members.join(deepest, "root").select("rank", "key", "longest"))
    return reached.groupBy("rank", "key").agg(F.max("longest").alias("longest"))


def repeated_passages(docs: DataFrame, words: int = WINDOW_WORDS) -> DataFrame:
    """`rank`, `key`, `runs` (first word, word after the last) that go, and `longest`, for texts with a window of another document.

    Runs may overlap, and the first document of a passage has none. `longest` is `words` times a power of two.
    """
    source = _source(docs)
    found = written(_level(source, words), "repeated-passages")
    longest = _longest(source, found.select("rank", "key", "shared"), words)
    return written(found.select("rank", "key", "runs").join(longest, ["rank", "key"]), "passages-and-lengths")


def without_repeated_passages(docs: DataFrame, words: int = WINDOW_WORDS) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed`, `longest_repeat` (0: no window of `words` words is in another document) and the kept words, joined by one space."""
    found = repeated_passages(docs, words)
    joined = _source(docs).join(found, ["rank", "key"], "left").select("doc_id", "text", "runs", F.coalesce("longest", F.lit(0)).alias("longest"))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = strings(batch["text"])
        for i, j in slices(offsets):
            n_words, n_removed, kept = [], [], []
            for at in range(i, j):
                own = data[offsets[at] : offsets[at + 1]].tobytes().split()
                n_words.append(len(own))
                if batch["runs"][at].is_valid:
                    own = [own[k] for k in np.flatnonzero(~_inside(len(own), batch["runs"][at]))]
                n_removed.append(n_words[-1] - len(own))
                kept.append(b" ".join(own))
            counts = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), batch["longest"].slice(i, j - i)]
            columns = [batch["doc_id"].slice(i, j - i), *counts, pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "longest_repeat", "text"])

    return arrow_step(joined, step, "doc_id long, n_words long, n_removed long, longest_repeat long, text string")


def without_repeated_passages_digest(docs: DataFrame) -> DataFrame:
    kept = without_repeated_passages(docs)
    return kept.select("doc_id", "n_words", "n_removed", "longest_repeat", F.sha2("text", 256).alias("kept_sha256"))
