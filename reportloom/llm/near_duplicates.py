"""Near duplicates by ProbMinHash over weighted five-word shingles.

A shingle found `c` times weighs `1 + ln c`. Each shingle is a Poisson process whose rate is its weight: arrival after arrival
goes to a random register, which keeps the earliest one, and a shingle stops as soon as its arrivals come later than those in
all registers. Two texts agree in a register with the probability Jaccard similarity of their weights. Registers are cut
into bands; texts that share a band are candidates, and a candidate pair counts if its similarity, computed from both whole
texts, is at least `THRESHOLD`. Classes are the connected components of the verified links.

Texts that are equal are one node, so copies are never paired, and band buckets of the same members are one. Within a bucket each
member is compared with a leader, a linear number of pairs, and in further turns with other leaders as long as it is in another class
than they are. The turns only save work. Buckets that still hold several classes are then cut into blocks of bounded size, and each
two blocks are compared as a whole: shared weights, by products of matrices, bound the similarity of each pair from above, and
pairs that the bound does not exclude are computed from both texts.

No text is shipped before the registers speak for it: the low 16 bits of all registers, 288 bytes for a text, tell in how many of them
two texts agree. A link agrees in each register with a probability of at least `THRESHOLD`, so fewer than `AGREEING` of them come with a
probability of 6e-8, against 1e-3 of sharing no band. Every pair that shares a band is in one class, verified, or excluded by one of the
two bounds.

Cases: a null text is empty; texts without words are one class; texts of fewer than five words have one shingle of all words;
rows that agree in doc_id and text are one document; a null doc_id is the last of its class; an empty table gives an empty
result; further columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .common import arrow_step, maybe_among, task_step, text_key, texts, written
from .components import components
from .kernels import as_long, mix, running_sums, slices, spans, strings, words_of

SHINGLE_WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
#: Registers in which candidates agree at least: fewer have a probability of 5.5e-8 at a similarity of 0.8.
AGREEING = 88
#: Turns of comparison with leaders, and leaders of a bucket in each turn after the first.
TURNS, LEADERS = 3, 3
#: Texts and bytes of a block, about, and shingles in a product of matrices.
BLOCK_TEXTS, BLOCK_BYTES, CHUNK = 512, 4 << 20, 2048
#: Room for the rounding of the products.
ROUNDING = 1e-3


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and weight of each distinct shingle of the texts, by text."""
    words = words_of(data, offsets, lower=True)
    sums = running_sums(words.hashes)
    at = words.window_starts(SHINGLE_WORDS)
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE_WORDS))
    text = np.concatenate([words.owner()[at], short])
    hashes = np.concatenate([spans(sums, at, at + SHINGLE_WORDS), spans(sums, words.first[short], words.first[short + 1])])
    # One sort key for text and hash; equal keys of one text are equal shingles.
    _, index, counts = np.unique(mix(hashes ^ mix(text.astype(np.uint64), 7), 8), return_index=True, return_counts=True)
    order = np.argsort(text[index], kind="stable")
    index, counts = index[order], counts[order]
    return text[index], hashes[index], 1 + np.log(counts)


def registers_of(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """The shingle in each register of each of `n` texts, round by round over the arrivals that may still matter."""
    earliest = np.full(n * REGISTERS, np.inf)
    held = np.zeros(n * REGISTERS, np.uint64)
    time = np.zeros(len(text))
    for arrival in count(1):
        if not len(text):
            return held.reshape(n, REGISTERS)
        noise = mix(hashes, 2 * arrival)
        time = time - np.log(((noise >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights
        place = text * REGISTERS + (mix(hashes, 2 * arrival + 1) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(earliest, place, time)
        won = earliest[place] == time
        held[place[won]] = hashes[won]
        on = time < earliest.reshape(n, REGISTERS).max(1)[text]
        text, hashes, weights, time = text[on], hashes[on], weights[on], time[on]


def signatures(docs: DataFrame) -> DataFrame:
    """`doc_id`, `key` of the text, `bands`: a hash for each band of registers, `codes`: 16 bits of each register, and `size`: bytes of the text."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = strings(batch["text"])
        for i, j in slices(offsets):
            held = registers_of(*shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), j - i)
            values = held.reshape(-1)
            starts = np.arange(0, len(values), ROWS)
            numbers = np.tile(np.arange(BANDS, dtype=np.uint64), j - i)
            bands = mix(spans(running_sums(values), starts, starts + ROWS) + numbers, 3)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(bands) + 1, BANDS), pa.int32()), pa.array(as_long(bands)))
            sizes = pa.array(np.diff(offsets[i : j + 1]))
            codes = pa.array([row.tobytes() for row in mix(held, 9).astype(np.uint16)], pa.binary())
            columns = [batch["doc_id"].slice(i, j - i), batch["key"].slice(i, j - i), lists, codes, sizes]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "bands", "codes", "size"])

    return arrow_step(texts(docs).withColumn("key", text_key(F.col("text"))), step, "doc_id long, key long, bands array<long>, codes binary, size long")


def _codes(column: pa.Array | list[bytes]) -> np.ndarray:
    """Codes of the registers, a row for each text."""
    values = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint16).reshape(len(values), REGISTERS)


def agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The `pairs` (`a`, `b` and more) that agree in enough registers; `sketches` has `key` and `codes`."""
    left = sketches.select(F.col("key").alias("a"), F.col("codes").alias("codes_a"))
    right = sketches.select(F.col("key").alias("b"), F.col("codes").alias("codes_b"))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        enough = (_codes(batch["codes_a"]) == _codes(batch["codes_b"])).sum(1) >= AGREEING
        yield batch.select(names).filter(pa.array(enough))

    names = pairs.columns
    return arrow_step(pairs.join(left, "a").join(right, "b").select(*names, "codes_a", "codes_b"), step, pairs.schema)


def probability_jaccard(a: dict[int, float] | tuple, b: dict[int, float] | tuple) -> float:
    """Sum over shared elements d of 1 / sum over all y of max(a_y / a_d, b_y / b_d). Arguments: hashes and weights, by hash."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return float(len(ha) == len(hb))
    every = np.union1d(ha, hb)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, ha)] = wa
    y[np.searchsorted(every, hb)] = wb
    shared = (x > 0) & (y > 0)
    if not shared.any():
        return 0.0
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio)
    before = np.concatenate([[0.0], np.cumsum(y[order])])  # of elements with smaller ratios, b's side is the larger one
    after = np.concatenate([np.cumsum(x[order][::-1])[::-1], [0.0]])
    k = np.searchsorted(ratio[order], ratio[shared])
    return float(np.sum(x[shared] / (after[k] + ratio[shared] * before[k])))


def _by_text(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = strings(column)
    for i, j in slices(offsets):
        text, hashes, weights = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        bounds = np.searchsorted(text, np.arange(j - i + 1))
        for k in range(j - i):
            yield hashes[bounds[k] : bounds[k + 1]], weights[bounds[k] : bounds[k + 1]]


def similarities(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """`a`, `b` and their `similarity`; `nodes` has `key` and `text`, of which only those in `pairs` are shuffled.

    A hot `a` or `b` is split by adaptive execution.
    """
    left = maybe_among(nodes, "key", pairs.select("a")).select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = maybe_among(nodes, "key", pairs.select("b")).select(F.col("key").alias("b"), F.col("text").alias("text_b"))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = [probability_jaccard(x, y) for x, y in zip(_by_text(batch["text_a"]), _by_text(batch["text_b"]), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(values, pa.float64())], ["a", "b", "similarity"])

    return arrow_step(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"), step, "a long, b long, similarity double")


def upper_bounds(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, split: int) -> np.ndarray:
    """At least the similarity of each text below `split` to each one from there on; with `split` = `n`, of all to all.

    With A and B the whole weights of two texts and a and b the weights of their shared shingles, a term of the similarity is at
    most a concave function of degree 1 of its two weights, so the sum is at most that of the sums: 1 / (A / a + B / b - 1).
    """
    whole = np.bincount(text, weights, n)
    rows, columns = np.arange(split), np.arange(split if split < n else 0, n)
    _, place = np.unique(hashes, return_inverse=True)
    kinds = place.max(initial=-1) + 1
    if split < n:
        shared = (np.bincount(place[text < split], minlength=kinds) > 0) & (np.bincount(place[text >= split], minlength=kinds) > 0)
    else:
        shared = np.bincount(place, minlength=kinds) > 1
    kept = shared[place]
    text, weights, place = text[kept], weights[kept], (np.cumsum(shared) - 1)[place[kept]]
    order = np.argsort(place, kind="stable")
    text, weights, place = text[order], weights[order], place[order]
    left, right = np.zeros((len(rows), len(columns))), np.zeros((len(rows), len(columns)))
    for low in range(0, int(shared.sum()), CHUNK):
        i, j = np.searchsorted(place, [low, low + CHUNK])
        x = np.zeros((n, CHUNK), np.float32)
        x[text[i:j], place[i:j] - low] = weights[i:j]
        held = (x > 0).astype(np.float32)
        left += x[rows] @ held[columns].T
        right += held[rows] @ x[columns].T
    with np.errstate(divide="ignore", invalid="ignore"):
        bounds = 1 / (whole[rows][:, None] / left + whole[columns][None, :] / right - 1)
    return np.where(left > 0, bounds, 0.0)


def links_between(classes: list[int], texts: list[str], split: int, threshold: float) -> list[tuple[int, int]]:
    """Pairs of classes that links join: links of the texts below `split` with the others, or among all if there are no others.

    Of links that join the same classes, directly or by way of others, one is enough.
    """
    n = len(texts)
    each = list(_by_text(pa.array(texts, pa.string())))
    text = np.repeat(np.arange(n), [len(h) for h, _ in each])
    bounds = upper_bounds(text, np.concatenate([h for h, _ in each]), np.concatenate([w for _, w in each]), n, split)
    own = np.array(classes)
    shift = split if split < n else 0
    open_ones = (bounds >= threshold - ROUNDING) & (own[:split, None] != own[None, shift:])
    if not shift:
        open_ones &= np.tri(n, k=-1, dtype=bool).T
    i, j = np.nonzero(open_ones)
    order = np.argsort(-bounds[i, j], kind="stable")
    parent = {c: c for c in classes}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    found = []
    for x, y in zip(i[order].tolist(), (j[order] + shift).tolist(), strict=True):
        a, b = root(classes[x]), root(classes[y])
        if a != b and probability_jaccard(each[x], each[y]) >= threshold:
            parent[b] = a
            found.append((classes[x], classes[y]))
    return found


def promising(classes: list[int], codes: np.ndarray, split: int) -> np.ndarray:
    """Which texts agree in enough registers with a text of another class: texts below `split` with the others, or all if there are no others."""
    n = len(classes)
    shift = split if split < n else 0
    agree = np.zeros((split, n - shift), np.uint8)
    for r in range(REGISTERS):
        agree += codes[:split, r, None] == codes[None, shift:, r]
    own = np.array(classes)
    open_ones = (agree >= AGREEING) & (own[:split, None] != own[None, shift:])
    found = np.zeros(n, bool)
    found[:split] |= open_ones.any(1)
    found[shift:] |= open_ones.any(0)
    return found


def _by_task(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.repartition("task").sortWithinPartitions("task", "side").select("task", "side", *columns)


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The columns of each task's rows, one task after the other; a task's rows are at most two blocks."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for _, group in groupby(rows, key=lambda r: r[0]):
        yield tuple(zip(*group, strict=True))


def remaining_links(now: DataFrame, nodes: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """`a`, `b`: classes that a link within a bucket joins, all of them or as it follows from others.

    Blocks meet by their registers first, and only texts with a partner that agrees in enough of them meet as texts.

    `now` has `bucket`, `key`, `size` of the text and `class`. A class that fills more than one block gets blocks of its own, which
    are not compared with each other; the other classes are dealt into blocks as a whole. So different blocks hold different
    classes, and the work is a product of two classes' sizes, never the square of one.
    """
    parts = lambda n, size: F.ceil(F.greatest(n / BLOCK_TEXTS, size / BLOCK_BYTES)).cast("int")
    totals = now.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("least"), F.max("class").alias("most"))
    # Both members of a pair have met: one of them was the leader.
    still = written(totals.where("least < most and n > 2").select("bucket"), "open-buckets")
    now = now.join(still, "bucket")
    sizes = now.groupBy("bucket", "class").agg(parts(F.count(F.lit(1)), F.sum("size")).alias("own"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    sizes = written(sizes, "class-sizes")
    small = sizes.where("own <= 1").groupBy("bucket").agg(parts(F.sum("n"), F.sum("size")).alias("dealt"))
    dealt = written(sizes.join(small, "bucket", "left").select("bucket", "class", "own", F.greatest(F.coalesce("dealt", F.lit(1)), F.lit(1)).alias("dealt")), "class-blocks")
    owner = F.when(F.col("own") > 1, F.col("class"))
    alone = F.concat(F.col("class"), F.lit(":"), F.pmod(F.xxhash64("key"), F.col("own")))
    block = F.when(F.col("own") > 1, alone).otherwise(F.concat(F.lit(":"), F.pmod(F.xxhash64("class"), F.col("dealt"))))
    placed = written(now.join(dealt, ["bucket", "class"]).select("bucket", "key", "class", owner.alias("owner"), block.alias("block")), "blocks")
    blocks = placed.groupBy("bucket", "block").agg(F.first("owner").alias("owner"), (F.min("class") < F.max("class")).alias("several"))
    blocks = written(blocks, "block-list")
    x, y = (blocks.select("bucket", *(F.col(c).alias(f"{c}_{side}") for c in ("block", "owner", "several"))) for side in "xy")
    two = x.join(y, "bucket").where("block_x < block_y and not coalesce(owner_x = owner_y, false) or block_x = block_y and several_x")
    sides = F.array_distinct(F.array(F.struct(F.lit(0).alias("side"), F.col("block_x").alias("block")), F.struct(F.when(F.col("block_x") < F.col("block_y"), 1).otherwise(0).alias("side"), F.col("block_y").alias("block"))))
    tasks = two.select("bucket", F.xxhash64("bucket", "block_x", "block_y").alias("task"), F.explode(sides).alias("one"))
    tasks = written(tasks.select("bucket", "task", "one.side", "one.block"), "block-pairs")
    members = placed.join(tasks, ["bucket", "block"]).select("task", "side", "key", "class")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, side, key, own, codes in _tasks(batches):
            found = promising(own, _codes(list(codes)), side.count(0))
            if found.any():
                yield pa.RecordBatch.from_arrays([pa.array(c, k).filter(pa.array(found)) for c, k in zip((task, side, key, own), _MEMBER, strict=True)], ["task", "side", "key", "class"])

    open_ones = task_step(_by_task(members.join(sketches, "key"), "key", "class", "codes"), sketched, "task long, side int, key long, class long")
    open_ones = written(open_ones, "open-members")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, side, own, held in _tasks(batches):
            found = links_between(own, held, side.count(0), threshold)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    held = maybe_among(nodes, "key", open_ones.select("key")).select("key", "text")
    return task_step(_by_task(open_ones.join(held, "key"), "class", "text"), compared, "a long, b long")


_MEMBER = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def _relabelled(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """`labels` after classes were joined; `joined` gives the new label of each class that has one."""
    moved = labels.join(joined.select(F.col("key").alias("label"), F.col("label").alias("new")), "label", "left")
    return moved.select("key", F.coalesce("new", "label").alias("label")).unionByName(joined)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """For each row of `docs`: `doc_id`, `key`, `class_id` (least doc_id of its class), `first_key` and `n_rows`.

    `first_key` is the key of the document that stays for the class; `n_rows` counts the rows that agree in doc_id and key.
    """
    rows = written(signatures(docs), "signatures")
    buckets = rows.dropDuplicates(["key"]).select("key", "size", F.explode("bands").alias("bucket"))
    # Of buckets with the same members (told by 128 bits of their keys) one is enough.
    same = [F.bit_xor(F.xxhash64(F.lit(i), "key")).alias(f"same_{i}") for i in range(2)]
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *same).where("n > 1")
    shared = shared.groupBy("n", "same_0", "same_1").agg(F.min("bucket").alias("bucket")).select("bucket")
    shared = written(shared, "shared-buckets")
    members = written(buckets.join(shared, "bucket"), "band-members")
    keys = written(members.select("key").distinct(), "candidate-keys")
    sketches = maybe_among(rows.select("key", "codes"), "key", keys).dropDuplicates(["key"])
    sketches = written(sketches.join(keys, "key", "left_semi"), "sketches")
    source = maybe_among(texts(docs).withColumn("key", text_key(F.col("text"))), "key", keys)
    nodes = written(source.join(keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "candidate-texts")
    tested = labels = None

    def classed() -> DataFrame:
        if labels is None:
            return members.withColumn("class", F.col("key"))
        return members.join(labels, "key", "left").select("bucket", "key", "size", F.coalesce("label", "key").alias("class"))

    for turn in range(TURNS):
        now = classed()
        # The first turn has the least key of a bucket as leader, which is the same one in most buckets of a group.
        orders = [F.xxhash64(F.lit(turn * LEADERS + i), "key") for i in range(LEADERS)] if turn else [F.col("key")]
        chosen = F.array_distinct(F.array(*[F.struct(F.min_by("key", o).alias("key"), F.min_by("class", o).alias("class")) for o in orders]))
        leaders = now.groupBy("bucket").agg(chosen.alias("leaders"), F.min("class").alias("least"), F.max("class").alias("most"))
        leaders = written(leaders.where("least < most").select("bucket", "leaders"), "leaders")
        pairs = now.join(leaders, "bucket").select("key", "class", F.explode("leaders").alias("leader")).where("class <> leader.class")
        first = F.col("key") < F.col("leader.key")
        pairs = pairs.select(
            F.least("key", "leader.key").alias("a"),
            F.greatest("key", "leader.key").alias("b"),
            F.when(first, F.col("class")).otherwise(F.col("leader.class")).alias("class_a"),
            F.when(first, F.col("leader.class")).otherwise(F.col("class")).alias("class_b"),
        ).distinct()
        pairs = written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "candidate-pairs")
        if pairs.isEmpty():
            break
        close = written(agreeing(pairs.select("a", "b"), sketches), "close-pairs")
        found = written(similarities(close, nodes).where(F.col("similarity") >= threshold), "links")
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        if not found.isEmpty():
            joined = components(found.join(pairs, ["a", "b"]).select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
            labels = joined if labels is None else written(_relabelled(labels, joined), "labels")
        elif turn:
            break
    rest = written(remaining_links(classed(), nodes, sketches, threshold), "remaining-links")
    if not rest.isEmpty():
        joined = components(rest)
        labels = joined if labels is None else written(_relabelled(labels, joined), "labels")
    each = rows.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    each = each.withColumn("class", F.col("key")) if labels is None else each.join(labels, "key", "left").withColumn("class", F.coalesce("label", "key"))
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("key"))
    first = each.groupBy("class").agg(F.min(rank).alias("first"))
    named = each.join(written(first, "class-heads"), "class").select("doc_id", "key", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("first_key"), "n_rows")
    return named


def classes(docs: DataFrame) -> DataFrame:
    """`doc_id` and `class_id`, one row for each document."""
    return near_duplicates(docs).select("doc_id", "class_id", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("first_key"))).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay: of each class the document with the least doc_id, once."""
    verdicts = near_duplicates(docs).select(
        F.col("doc_id").alias("own_id"), F.col("key").alias("own_key"), "n_rows", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("first_key"))).alias("stays")
    )
    verdicts = written(verdicts.where("not stays or n_rows > 1"), "near-duplicate-verdicts")  # all others stay as they are
    rows = docs.select(F.struct("*").alias("doc")).withColumn("own_key", text_key(F.coalesce(F.col("doc.text").cast("string"), F.lit(""))))
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("own_id")) & (rows["own_key"] == verdicts["own_key"])
    single = rows.join(verdicts, same, "left_anti").select("doc.*")
    repeated = rows.join(verdicts.where("stays"), same, "left_semi")
    repeated = repeated.groupBy(F.col("doc.doc_id").alias("own_id"), "own_key").agg(F.first("doc").alias("doc")).select("doc.*")
    return single.unionByName(repeated)
