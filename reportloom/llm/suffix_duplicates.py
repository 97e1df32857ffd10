"""Suffix-array deduplication of byte strings with a common-prefix-aware distributed merge sort.

Which suffixes: in every window of `length` bytes the 64-byte gram with the smallest hash is its anchor, so equal windows have
equal anchors at equal offsets, and only suffixes at anchors that occur twice are sorted. All windows with one anchor form its
context; equal contexts are pre-aggregated, and one suffix stands for each.

How they are sorted: each task sorts its suffixes into runs and front-codes them (common prefix with the one before, and the
rest). Splitters cut the runs into ranges of bounded size, the ranges are exchanged, and a loser tree merges the runs of a
range. The tree knows the common prefix of each head with the last one put out: heads are compared by these lengths, and bytes
only after an equal known prefix.

What follows: in a block of suffixes with one anchor, the common prefix to the right (from the sorted order) and to the left
of the anchor tell which windows two contexts share. A byte goes if a window that covers it starts anywhere else as well.

Cases: a null text is empty; texts shorter than a window stay whole; copies of one document, repeated rows included, remove
each other; null ids stay; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import arrow_step, task_step, text_key, texts, written
from .kernels import anchors_of, as_long, mix, running_sums, slices, spans, strings
from .repeated_passages import covered

LENGTH, GRAM = 400, 64
#: Bytes of suffixes in a run and, about, in a range.
RUN_BYTES = 8 << 20
#: Ranges are cut by the first bytes of a suffix, read as a number.
HEAD = 7


def _source(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("key", text_key(F.col("text")))


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """`doc_id`, `key`, the anchor's hash `a`, its context's hash `f`, its place `at`, and its first and last window."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = strings(batch["text"])
        key, ids = batch["key"].to_numpy(), batch["doc_id"]
        for i, j in slices(offsets):
            own, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            if len(own) < length:
                continue
            sums = running_sums(own)
            n = len(own) - GRAM + 1
            grams = spans(sums, np.arange(n), np.arange(GRAM, n + GRAM), 1)
            # Grams across the end of a text are dropped, so that those of a text are neighbours.
            inside = np.ones(n, bool)
            for end in bounds[1:-1]:
                inside[max(0, end - GRAM + 1) : end] = False
            at = np.flatnonzero(inside)
            spots = anchors_of(grams[at], np.searchsorted(at, bounds), length - GRAM + 1)
            place, low, high = at[spots.at], at[spots.low], at[spots.high]
            context = mix(spans(sums, low, high + length, 2) + (place - low).astype(np.uint64), 3)
            text = np.searchsorted(bounds, place, "right") - 1
            start = bounds[text]
            columns = [ids.take(pa.array(i + text)), key[i + text], as_long(grams[place]), as_long(context), *((x - start).astype(np.int32) for x in (place, low, high))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["doc_id", "key", "a", "f", "at", "low", "high"])

    return arrow_step(_source(docs).select("text", "doc_id", "key"), step, "doc_id long, key long, a long, f long, at int, low int, high int")


SUFFIXES = "a long, f long, alone boolean, near int, far int, suffix binary, before binary"


def _suffixes(wanted: DataFrame, length: int) -> DataFrame:
    """One row for each listed context: the bytes from the anchor on, and those before it, backwards.

    `near` and `far` are the least and the largest distance from a window's start to the anchor.
    """

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for text, contexts in zip(batch["text"].to_pylist(), batch["contexts"].to_pylist(), strict=True):
            raw = text.encode()
            for c in contexts:
                at, low, high = c["at"], c["low"], c["high"]
                rows.append((c["a"], c["f"], c["alone"], at - high, at - low, raw[at : high + length], raw[low:at][::-1]))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "f", "alone", "near", "far", "suffix", "before"])

    return arrow_step(wanted, step, SUFFIXES)


def common_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which `known` bytes are known already."""
    low, high = known, min(len(x), len(y))
    if x[low:high] == y[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return low


RUNS = "range int, run long, position int, prefix int, rest binary, a long, f long, alone boolean, near int, far int, before binary"
_RUN_KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary()]
_RUN_NAMES = [c.split()[0] for c in RUNS.split(", ")]


def head(suffix: bytes) -> int:
    return int.from_bytes(suffix[:HEAD].ljust(HEAD, b"\0"), "big")


def sorted_runs(suffixes: DataFrame, cuts: list[int]) -> DataFrame:
    """Front-coded runs of at most RUN_BYTES, cut at the splitters; the first entry of each range is whole.

    A run is named by its task and its place there: repeated rows bring one context into several runs.
    """

    def flush(rows: list[tuple], number: int) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: r[5])
        out, last_range, last = [], -1, b""
        for position, (a, f, alone, near, far, suffix, before) in enumerate(rows):
            cut = bisect.bisect_right(cuts, head(suffix))
            prefix = common_prefix(last, suffix) if cut == last_range else 0
            out.append((cut, number, position, prefix, suffix[prefix:], a, f, alone, near, far, before))
            last_range, last = cut, suffix
            if len(out) == 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), _RUN_KINDS, strict=True)], _RUN_NAMES)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), _RUN_KINDS, strict=True)], _RUN_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, numbers = [], 0, itertools.count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append(row)
                size += len(row[5]) + len(row[6])
                if size >= RUN_BYTES:
                    yield from flush(rows, next(numbers))
                    rows, size = [], 0
        if rows:
            yield from flush(rows, next(numbers))

    return task_step(suffixes, run, RUNS)


class Run:
    """A front-coded run that is read entry by entry. `prefix` is that of its head with the last entry put out by the merge."""

    def __init__(self, entries: Iterator[tuple]):
        self.entries, self.suffix, self.prefix, self.data = entries, b"", 0, None
        self.advance()

    def advance(self) -> None:
        entry = next(self.entries, None)
        if entry is None:
            self.suffix = None
            return
        prefix, rest, self.data = entry
        self.suffix, self.prefix = self.suffix[:prefix] + rest, prefix


def _loses(x: Run, y: Run) -> bool:
    """Whether x comes after y. The loser's known prefix becomes the one with the winner."""
    if x.suffix is None or y.suffix is None:
        return x.suffix is None
    if x.prefix != y.prefix:  # both come after the last entry: the one that shares more with it comes first
        return x.prefix < y.prefix
    shared = common_prefix(x.suffix, y.suffix, x.prefix)
    after = x.suffix[shared:] > y.suffix[shared:]
    if after:
        x.prefix = shared
    else:
        y.prefix = shared
    return after


def merged(runs: list[Run]) -> Iterator[tuple[int, bytes, tuple]]:
    """Prefix with the entry before, suffix and data of all entries of the runs, in order, by a loser tree."""
    n = len(runs)
    if not n:
        return
    losers = [-1] * n

    def play(player: int) -> None:
        """From its leaf up, the winner goes on and the loser stays; while the tree is built, the first to come waits."""
        node = (player + n) // 2
        while node:
            if losers[node] < 0:
                losers[node] = player
                return
            if _loses(runs[player], runs[losers[node]]):
                player, losers[node] = losers[node], player
            node //= 2
        losers[0] = player

    for i in range(n):
        play(i)
    while runs[losers[0]].suffix is not None:
        winner = runs[losers[0]]
        yield winner.prefix, winner.suffix, winner.data
        winner.advance()
        play(losers[0])


def shared_windows(block: list[tuple], prefixes: list[int], length: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """For the contexts of one anchor in sorted order: a, f and the distances (least, largest) of windows that others share.

    `block`: (suffix, (a, f, alone, near, far, before)); `prefixes[i]`: common prefix of entries i - 1 and i. A context that
    occurs more than once is shared as a whole and only serves the others.

    Neighbours in sorted order are joined to groups, those with the longest common prefix first: at a prefix of x bytes, a group
    holds contexts that agree in x bytes to the right. A group is kept in the order of its left parts, where the longest common left
    part of a context is with a neighbour. The smaller group goes into the larger one, so a context moves and is compared a
    logarithmic number of times, however many share the anchor.
    """
    n = len(block)
    left_order = sorted(range(n), key=lambda i: block[i][1][5])
    rank = [0] * n
    for place, i in enumerate(left_order):
        rank[i] = place
    before = [block[i][1][5] for i in left_order]  # by rank, as are the following
    near, far = ([block[i][1][k] for i in left_order] for k in (3, 4))
    best = [-1] * n
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    group = [[rank[i]] for i in range(n)]
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def meet(x: int, y: int, right: int) -> None:
        """Two contexts that agree in `right` bytes to the right, and are neighbours in their group."""
        left = common_prefix(before[x], before[y])
        for k in (x, y):
            if left > best[k]:
                best[k] = left
                least, most = max(near[k], length - right), min(far[k], left)
                if least <= most:
                    found[k].append((least, most))

    for i in sorted(range(1, n), key=lambda i: -prefixes[i]):
        right = prefixes[i]
        x, y = find(i - 1), find(i)
        if len(group[x]) < len(group[y]):
            x, y = y, x
        into = group[x]
        for k in group[y]:
            at = bisect.bisect(into, k)
            into.insert(at, k)
            if at:
                meet(into[at - 1], k, right)
            if at + 1 < len(into):
                meet(k, into[at + 1], right)
        root[y], group[y] = x, []
    for i in range(n):
        a, f, alone, *_ = block[i][1]
        if alone and found[rank[i]]:
            yield a, f, found[rank[i]]


SHARED = "a long, f long, windows array<struct<near: int, far: int>>"


def merge_ranges(runs: DataFrame, ranges: int, length: int) -> DataFrame:
    """Merge each range and find the windows that contexts share; memory holds the runs of one range."""
    kind = pa.list_(pa.struct([("near", pa.int32()), ("far", pa.int32())]))

    def resolve(entries: list[tuple]) -> Iterator[tuple]:
        sources = [Run(iter([(r[3], r[4], r[5:]) for r in group])) for _, group in itertools.groupby(entries, key=lambda r: r[1])]
        block, prefixes = [], []
        for prefix, suffix, data in merged(sources):
            if prefix < GRAM and block:
                if len(block) > 1:
                    yield from shared_windows(block, prefixes, length)
                block, prefixes = [], []
            block.append((suffix, data))
            prefixes.append(prefix)
        if len(block) > 1:
            yield from shared_windows(block, prefixes, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for _, group in itertools.groupby(rows, key=lambda r: r[0]):
            found = list(resolve(list(group)))
            if found:
                lists = [[{"near": x, "far": y} for x, y in w] for *_, w in found]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.int64()), pa.array(lists, kind)], ["a", "f", "windows"])

    placed = runs.repartition(ranges, "range").sortWithinPartitions("range", "run", "position")
    return task_step(placed, run, SHARED)


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`doc_id`, `key` and `runs` (first byte, byte after the last) that go, for documents with any; runs may overlap."""
    every = _anchors(docs, length)
    repeated = every.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    survivors = written(every.join(written(repeated, "repeated-keys"), "a"), "repeated-anchors")
    place = F.struct("doc_id", "key", "at", "low", "high")
    contexts = survivors.groupBy("a", "f").agg((F.count(F.lit(1)) == 1).alias("alone"), F.min_by(place, F.struct("key", "at")).alias("seen"))
    contexts = written(contexts, "contexts")
    open_ones = contexts.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.bool_or("alone").alias("any")).where("n > 1 and any").select("a")
    seen = contexts.join(written(open_ones, "open-anchors"), "a").select(
        F.col("seen.doc_id").alias("seen_id"), F.col("seen.key").alias("seen_key"), F.struct("a", "f", "alone", "seen.at", "seen.low", "seen.high").alias("context")
    )
    lists = seen.groupBy("seen_id", "seen_key").agg(F.collect_list("context").alias("contexts"))
    source = _source(docs)
    wanted = source.join(lists, F.col("doc_id").eqNullSafe(F.col("seen_id")) & (F.col("key") == F.col("seen_key"))).select("text", "contexts")
    suffixes = written(_suffixes(wanted, length), "suffixes")
    first = F.conv(F.hex(F.rpad(F.substring("suffix", 1, HEAD), HEAD, F.lit(b"\0"))), 16, 10).cast("long")
    size = suffixes.agg(F.coalesce(F.sum(F.octet_length("suffix") + F.octet_length("before")), F.lit(0))).first()[0]
    ranges = 1 + int(size) // RUN_BYTES
    cuts = suffixes.agg(F.percentile_approx(first, [k / ranges for k in range(1, ranges)], 100 * ranges)).first()[0] or [] if ranges > 1 else []
    shared = merge_ranges(sorted_runs(suffixes, sorted(set(cuts))), ranges, length)
    joined = survivors.join(contexts.select("a", "f", "alone"), ["a", "f"]).join(shared, ["a", "f"], "left")
    whole = F.array(F.struct(F.col("low").alias("start"), (F.col("high") + length).alias("end")))
    parts = F.transform("windows", lambda w: F.struct((F.col("at") - w["far"]).alias("start"), (F.col("at") - w["near"] + length).alias("end")))
    runs = F.when(~F.col("alone"), whole).when(F.col("windows").isNotNull(), parts)
    gone = joined.select("doc_id", "key", runs.alias("runs")).where("runs is not null")
    return gone.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def without_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`doc_id`, `n_bytes`, `removed` (maximal runs that go) and `kept` (the other bytes, which may not be whole characters)."""
    gone = repeated_bytes(docs, length).select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key"), "runs")
    joined = _source(docs).join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, removed, kept = [], [], []
        for text, runs in zip(batch["text"], batch["runs"], strict=True):
            raw = np.frombuffer(text.as_buffer(), np.uint8)
            sizes.append(len(raw))
            if runs.is_valid:
                out = covered(len(raw), runs.values.field("start").to_numpy(), runs.values.field("end").to_numpy())
                edges = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
                removed.append([{"start": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
                kept.append(raw[~out].tobytes())
            else:
                removed.append([])
                kept.append(raw.tobytes())
        columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "removed", "kept"])

    return arrow_step(joined.select("doc_id", "text", "runs"), step, "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary")


def without_repeated_bytes_digest(docs: DataFrame) -> DataFrame:
    kept = without_repeated_bytes(docs)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


