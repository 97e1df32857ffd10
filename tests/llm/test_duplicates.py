"""Near duplicates, repeated bytes, passages and lines against plain versions."""

import collections
import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from fixtures import CLASHING, corpus, frame, sha, words
from reportloom.llm import near_duplicates as near
from reportloom.llm import repeated_lines, repeated_passages
from reportloom.llm import suffix_duplicates as suffix
from reportloom.llm.components import components
from reportloom.llm.kernels import SPACES

SPACE = bytes(i for i in range(256) if SPACES[i]).decode()


def rank(doc_id):
    return 2**63 - 1 if doc_id is None else doc_id


def longest_repeats(rows, size):
    """For each row the greatest length, `size` times a power of two, of a window that a row of another id has too; else 0."""
    out = dict.fromkeys(rows, 0)
    while True:
        holders = collections.defaultdict(set)
        for doc_id, text in rows:
            own = (text or "").encode().split()
            for k in range(len(own) - size + 1):
                holders[tuple(own[k : k + size])].add(rank(doc_id))
        found = False
        for doc_id, text in rows:
            own = (text or "").encode().split()
            if any(len(holders[tuple(own[k : k + size])]) > 1 for k in range(len(own) - size + 1)):
                out[doc_id, text], found = size, True
        if not found:
            return out
        size *= 2


def plain_passages(rows, size):
    first, longest = {}, longest_repeats(rows, size)
    for doc_id, text in rows:
        own = (text or "").encode().split()
        for k in range(len(own) - size + 1):
            key = tuple(own[k : k + size])
            first[key] = min(first.get(key, rank(None)), rank(doc_id))
    out = []
    for doc_id, text in rows:
        own = (text or "").encode().split()
        gone = {j for k in range(len(own) - size + 1) if first[tuple(own[k : k + size])] < rank(doc_id) for j in range(k, k + size)}
        out.append((doc_id, len(own), len(gone), longest[doc_id, text], sha(b" ".join(w for j, w in enumerate(own) if j not in gone))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed):
    rows = corpus(seed)
    got = repeated_passages.without_repeated_passages_digest(frame(spark, rows, clashing=True)).collect()
    assert sorted(map(tuple, got), key=str) == plain_passages(rows, 50)
    assert repeated_passages.without_repeated_passages_digest(frame(spark, rows).limit(0)).count() == 0


def test_passages_of_a_periodic_text(spark):
    rows = [(1, "a b " * 200), (2, "a b " * 60), (3, "b a " * 30), (4, "a " * 51), (5, "a " * 50)]
    got = repeated_passages.without_repeated_passages_digest(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == plain_passages(rows, 50)


def test_levels_of_long_passages(spark):
    """Passages of every level, whole texts and parts, within copies that differ at one place, and twice in one text only."""
    rng = random.Random(11)
    base = words(rng, 900, 5000)
    broken = [*base[:430], "changed", *base[431:]]
    twice = words(rng, 130, 5000) * 2
    rows = [(i, " ".join(own)) for i, own in enumerate([base, base, broken, base[100:310], base[:99], base[300:400], base[851:], words(rng, 500, 5000), twice, twice[:200], base[500:] + base[:450]])]
    rows += [(20, rows[7][1] + " more"), (20, rows[0][1]), (None, rows[8][1]), (21, None)]
    got = sorted(map(tuple, repeated_passages.without_repeated_passages_digest(frame(spark, rows)).collect()), key=str)
    assert got == plain_passages(rows, 50)
    assert {r[3] for r in got} == {0, 50, 100, 200, 400, 800}


def plain_bytes(rows, length):
    counts = collections.Counter(raw[k : k + length] for _, t in rows for raw in [(t or "").encode()] for k in range(len(raw) - length + 1))
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = {j for k in range(len(raw) - length + 1) if counts[raw[k : k + length]] > 1 for j in range(k, k + length)}
        spans = sum(1 for flag, _ in itertools.groupby(range(len(raw)), lambda j: j in gone) if flag)
        out.append((doc_id, len(raw), len(gone), spans, sha(bytes(v for j, v in enumerate(raw) if j not in gone))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix, "RUN_BYTES", 4000)  # many runs and ranges
    rows = [*corpus(seed), (600, "ab" * 700), (601, "ab" * 300), (602, "a" * 399), (603, "a" * 400)]
    got = suffix.without_repeated_bytes_digest(frame(spark, rows, clashing=True)).collect()
    assert sorted(map(tuple, got), key=str) == plain_bytes(rows, 400)
    assert suffix.without_repeated_bytes_digest(frame(spark, rows).limit(0)).count() == 0


def test_bytes_of_many_variants_of_one_text(spark):
    rng = random.Random(9)
    base = [f"word{rng.randrange(900)}" for _ in range(160)]
    rows = []
    for i in range(40):
        own = list(base)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(len(own))] = f"other{rng.randrange(5)}"
        rows.append((i, " ".join(own[rng.randrange(30) :])))
    got = suffix.without_repeated_bytes_digest(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == plain_bytes(rows, 400)


def test_bytes_of_repeated_rows_in_two_tasks(spark):
    """Both tasks have the same least context, so runs named by it would be taken for one."""
    rng = random.Random(4)
    base, rows = words(rng, 160, 900), []
    for i in range(40):
        own = list(base)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(len(own))] = f"other{rng.randrange(5)}"
        rows.append((i, " ".join(own[rng.randrange(30) :])))
    rows += rows[::2]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    got = suffix.without_repeated_bytes_digest(docs).collect()
    assert sorted(map(tuple, got), key=str) == plain_bytes(rows, 400)


def test_runs_of_two_tasks_stay_apart(spark):
    rng = random.Random(5)
    rows = [(1, f, f > 0, 0, 340, b"x" * 64 + bytes(rng.choices(b"ab", k=20)), b"") for f in range(60)]
    rows[30] = rows[0]
    runs = suffix.sorted_runs(spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), suffix.SUFFIXES), [])
    out = []
    for _, own in itertools.groupby(runs.orderBy("run", "position").collect(), key=lambda r: r.run):
        last = b""
        for r in own:
            last = last[: r.prefix] + bytes(r.rest)
            out.append(last)
    assert sorted(out) == sorted(r[5] for r in rows)


def common(x, y):
    return next((k for k, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))


@pytest.mark.parametrize("seed", range(5))
def test_shared_windows_against_all_pairs(seed):
    """Windows of 12 bytes around an anchor of 4: all pairs of contexts, all distances."""
    rng = random.Random(seed)
    length, gram = 12, b"GRAM"
    contexts = set()
    while len(contexts) < 60:
        far, near = rng.randrange(0, 9), 0
        near = rng.randrange(0, far + 1)
        contexts.add((gram + bytes(rng.choices(b"ab", k=length - near - 4)), near, far, bytes(rng.choices(b"ab", k=far))))
    block = sorted((s, (1, i, rng.random() < 0.8, near, far, before)) for i, (s, near, far, before) in enumerate(sorted(contexts)))
    prefixes = [0, *(suffix.common_prefix(x[0], y[0]) for x, y in itertools.pairwise(block))]
    got = {f: {d for least, most in windows for d in range(least, most + 1)} for _, f, windows in suffix.shared_windows(block, prefixes, length)}
    want = {}
    for s, (_, f, alone, near, far, before) in block:
        mine = {d for d in range(near, far + 1) for s2, (_, g, *_, before2) in block if g != f and common(before, before2) >= d and common(s, s2) >= length - d}
        if alone and mine:
            want[f] = mine
    assert got == want


def test_many_contexts_of_one_anchor_take_about_linear_time():
    """A passage of 250 bytes between left parts that occur twice, in 3,000 and in 24,000 documents."""
    import time

    def seconds(n):
        rng = random.Random(n)
        passage = bytes(rng.choices(b"abcdefgh", k=250))
        block = []
        for i in range(n):
            left = random.Random(i // 2).randbytes(300)
            block.append((passage + rng.randbytes(100), (1, i, True, 40, 300, left)))
        block.sort()
        prefixes = [0, *(suffix.common_prefix(x[0], y[0]) for x, y in itertools.pairwise(block))]
        start = time.perf_counter()
        found = list(suffix.shared_windows(block, prefixes, 400))
        assert len(found) == n and all(w == [(150, 300)] or w[0][0] <= 150 for *_, w in found)
        return time.perf_counter() - start

    seconds(500)
    few, many = min(seconds(3000) for _ in range(3)), seconds(24_000)
    assert many < 24 * few  # eight times the contexts; all pairs would take 64 times as long


def test_merge_of_runs_keeps_order_and_prefixes():
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 7, 16):
        runs, every = [], []
        for _ in range(n):
            own = sorted(bytes(rng.choices(b"ab", k=rng.randrange(1, 12))) for _ in range(rng.randrange(1, 30)))
            every += own
            shared = [0, *(suffix.common_prefix(x, y) for x, y in itertools.pairwise(own))]
            runs.append(suffix.Run(iter([(p, s[p:], None) for p, s in zip(shared, own, strict=True)])))
        out = list(suffix.merged(runs))
        assert [s for _, s, _ in out] == sorted(every)
        assert [p for p, _, _ in out] == [0, *(suffix.common_prefix(x, y) for x, y in itertools.pairwise(sorted(every)))][: len(every)]


def shingle_set(text):
    own = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return collections.Counter(tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))) if own else collections.Counter()


def similarity(x, y):
    """Probability Jaccard by its definition."""
    import math

    x, y = ({k: 1 + math.log(v) for k, v in c.items()} for c in (x, y))
    if not x or not y:
        return float(len(x) == len(y))
    both = set(x) | set(y)
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in both) for d in set(x) & set(y))


def plain_classes(rows, threshold=0.8):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if similarity(sets[i], sets[j]) >= threshold:
            parent[find(j)] = find(i)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return {doc_id: min(g, key=rank) for g in groups.values() for doc_id in g}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicate_classes(spark, seed):
    rows = corpus(seed, n=25)
    got = near.classes(frame(spark, rows, clashing=True)).collect()
    assert {r.doc_id: r.class_id for r in got} == plain_classes(rows)
    kept = near.one_of_each(frame(spark, rows, clashing=True))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(set(plain_classes(rows).values()), key=str)
    assert near.classes(frame(spark, rows).limit(0)).count() == 0


def family(rng, n=500, length=100):
    """Variants of one text, mostly a little under the threshold, and to each third one a copy with one more change."""
    base = [f"base{i}" for i in range(length)]
    rows = []
    for i in range(n):
        own = list(base)
        for place in rng.sample(range(8, length - 8), 3):
            own[place] = f"own{i}x{place}"
        rows.append((i, " ".join(own)))
        if i % 3 == 0:
            own[-1] = f"last{i}"
            rows.append((1000 + i, " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [near.BLOCK_TEXTS, 40])
def test_links_in_a_large_family_are_all_met(spark, monkeypatch, block):
    import numpy as np
    import pyarrow as pa

    from reportloom.llm.kernels import strings

    monkeypatch.setattr(near, "BLOCK_TEXTS", block)
    rows = family(random.Random(7))
    data, offsets = strings(pa.array([t for _, t in rows]))
    text, hashes, weights = near.shingles(data, offsets)
    held = near.registers_of(text, hashes, weights, len(rows)).reshape(len(rows), near.BANDS, near.ROWS)
    each = [(hashes[text == i], weights[text == i]) for i in range(len(rows))]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in (np.flatnonzero((held[i + 1 :] == held[i]).all(2).any(1)) + i + 1).tolist():
            if find(i) != find(j) and near.probability_jaccard(each[i], each[j]) >= near.THRESHOLD:
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                parent[b] = a
    want = {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}
    assert 50 < len(set(want.values())) < 0.9 * len(rows)
    assert {r.doc_id: r.class_id for r in near.classes(frame(spark, rows)).collect()} == want


def test_bound_is_never_under_the_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 60).astype(np.uint64)
    each = [(rng.choice(pool, k, replace=False), 1 + np.log(rng.integers(1, 9, k))) for k in rng.integers(1, 60, 30)]
    text = np.repeat(np.arange(30), [len(h) for h, _ in each])
    hashes, weights = (np.concatenate(c) for c in zip(*each, strict=True))
    every, some = near.upper_bounds(text, hashes, weights, 30, 30), near.upper_bounds(text, hashes, weights, 30, 11)
    assert np.allclose(every[:11, 11:], some, atol=1e-4)
    for i, j in itertools.permutations(range(30), 2):
        assert every[i, j] + near.ROUNDING >= near.probability_jaccard(each[i], each[j])


def test_registers_estimate_the_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    agreed, true = [], []
    for _ in range(40):
        hashes = rng.integers(0, 2**63, 120).astype(np.uint64)
        wx, wy = rng.integers(1, 4, 100).astype(float), rng.integers(1, 4, 100).astype(float)
        x, y = (hashes[:100], wx), (hashes[20:], wy)
        text = np.repeat([0, 1], 100)
        held = near.registers_of(text, np.concatenate([x[0], y[0]]), np.concatenate([wx, wy]), 2)
        agreed.append(np.mean(held[0] == held[1]))
        order = [np.argsort(x[0]), np.argsort(y[0])]
        true.append(near.probability_jaccard((x[0][order[0]], wx[order[0]]), (y[0][order[1]], wy[order[1]])))
    assert abs(np.mean(agreed) - np.mean(true)) < 0.02


def test_registers_exclude_pairs_without_a_link(spark):
    """Texts that agree in few registers are told apart without their texts; those over the threshold never are."""
    rng = random.Random(8)
    base = words(rng, 300, 5000)
    texts_of = lambda share: " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in base)
    rows = [(0, " ".join(base)), *((i, texts_of(0.01 if i < 20 else 0.2)) for i in range(1, 40))]
    signed = near.signatures(frame(spark, rows)).select("doc_id", "key", "codes").collect()
    key_of = {r.doc_id: r.key for r in signed}
    sketches = spark.createDataFrame([(r.key, r.codes) for r in signed], "key long, codes binary")
    pairs = spark.createDataFrame([(key_of[0], key_of[i], i) for i in range(1, 40)], "a long, b long, i int")
    kept = {r.i for r in near.agreeing(pairs, sketches).collect()}
    sets = [shingle_set(t) for _, t in rows]
    values = {i: similarity(sets[0], sets[i]) for i in range(1, 40)}
    assert {i for i, v in values.items() if v >= 0.8} <= kept and not {i for i, v in values.items() if v < 0.45} & kept
    codes = near._codes([r.codes for r in sorted(signed, key=lambda r: r.doc_id)])
    assert near.promising([1] * 40, codes, 40).sum() == 0
    found = near.promising(list(range(40)), codes, 40)
    assert found[[i for i, v in values.items() if v >= 0.8]].all()
    assert (near.promising(list(range(40)), codes, 1)[1:] == [i in kept for i in range(1, 40)]).all()


def test_probability_of_losing_a_link_by_its_registers():
    from math import comb

    lost = sum(comb(near.REGISTERS, k) * 0.8**k * 0.2 ** (near.REGISTERS - k) for k in range(near.AGREEING))
    assert lost < 6e-8


def test_key_map_loses_no_key(spark, monkeypatch):
    from reportloom.llm import common as shared

    df = spark.range(3000).selectExpr("xxhash64(id) AS h", "id")
    keys = df.where("id % 10 = 3").select("h")
    for bits in (64, 1 << 12, shared.KEY_BITS):
        monkeypatch.setattr(shared, "KEY_BITS", bits)
        found = {r.id for r in shared.maybe_among(df, "h", keys).collect()}
        assert {i for i in range(3000) if i % 10 == 3} <= found
    assert len(found) < 310
    assert shared.maybe_among(df, "h", keys.limit(0)).count() == 0


def test_recall_against_all_pairs_of_a_generated_table(spark):
    """All links of sf0.01, found by the upper bound over all pairs and computed exactly."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    distinct = sorted({r.text for r in docs})
    each = list(near._by_text(near.pa.array(distinct, near.pa.string())))
    text = np.repeat(np.arange(len(each)), [len(h) for h, _ in each])
    bounds = near.upper_bounds(text, np.concatenate([h for h, _ in each]), np.concatenate([w for _, w in each]), len(each), len(each))
    i, j = np.nonzero(np.triu(bounds >= 0.8 - near.ROUNDING, 1))
    links = [(x, y) for x, y in zip(i, j, strict=True) if near.probability_jaccard(each[x], each[y]) >= 0.8]
    got = {r.doc_id: r.class_id for r in near.classes(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    ids = collections.defaultdict(list)
    for r in docs:
        ids[r.text].append(r.doc_id)
    joined = sum(got[ids[distinct[x]][0]] == got[ids[distinct[y]][0]] for x, y in links)
    assert len(links) >= 5 and joined >= 0.99 * len(links)
    assert all(len({got[d] for d in same}) == 1 for same in ids.values())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    assert {r.key: r.label for r in components(edges).collect()} == {**{i: 0 for i in range(1, 41)}, 101: 100}


def plain_lines(rows):
    seen, out = set(), []
    places = {}
    for doc_id, text in sorted(set(rows), key=lambda r: rank(r[0])):
        lines = (text or "").split("\n")
        filled = [i for i, line in enumerate(lines) if line.strip(SPACE)]
        gone = set()
        for k in range(len(filled) - 2):
            three = filled[k : k + 3]
            key = tuple(lines[i] for i in three)
            if key in seen:
                gone.update(three)
            seen.add(key)
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        places[doc_id, text] = (doc_id, len(filled), len(gone), sha(kept))
    out = [places[r] for r in rows]
    return sorted(out, key=str)


def test_lines(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    block = ["one", "two", "three", "four"]
    rows = [(i, "\n".join(rng.choice([block, block[1:], ["x", "", "y"], [f"own {i} {k}" for k in range(3)], ["", " "]]) [j] for _ in range(4) for j in range(2))) for i in range(30)]
    rows += [(40, "\n".join(block)), (41, "\n".join(block + ["more"])), (42, None), (43, ""), (44, "\n\n"), (None, "\n".join(block)), (40, "\n".join(block)), (45, "a\n" * 500)]
    df = frame(spark, rows, clashing=True)
    got = repeated_lines.without_repeated_lines(df).select(F.col("doc.doc_id"), "n_lines", "n_removed", F.sha2(F.coalesce("doc.text", F.lit("")), 256))
    assert sorted(map(tuple, got.collect()), key=str) == plain_lines(rows)
    assert repeated_lines.without_repeated_lines(frame(spark, rows).limit(0)).count() == 0


def test_anchors_take_little_memory(monkeypatch):
    """Two megabytes of text pass in slices: an executor runs several such steps beside its heap."""
    steps = []

    class Frame:
        def select(self, *names):
            return self

    monkeypatch.setattr(suffix, "_source", lambda docs: Frame())
    monkeypatch.setattr(suffix, "arrow_step", lambda df, step, schema: steps.append(step))
    suffix._anchors(None, 400)
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(97, 122, 2000))) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(1000)), pa.array(range(1000))], ["text", "doc_id", "key"])
    tracemalloc.start()
    found = sum(b.num_rows for b in steps[0](batch))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 5000 and peak < 50_000_000
