import collections
import random
import re

from fixtures import CLASHING, frame
from reportloom.llm import mixture


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight; what is above a source's limit is shared again among the others, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: float(most * sizes[s]) if s in full else rest * weight[s] / free for s in order}
        above = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def rows_of(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a"] * 20 + ["b", "B", "é", "z", None, "", "zz"])
        rows.append((i, "".join(f"w{k}" + rng.choice([" ", "\n", "\x0b", " \t"]) for k in range(rng.choice([0, 1, 7, 7, 7, rng.randrange(200)]))), "en", source))
    tiny = [(n, "one two", "en", "tiny"), (n + 1, None, "en", "empty"), (n + 2, "", "en", "empty"), (None, "a b c", "en", "b")]
    return rows + tiny + [rows[5]] * 150 + [(n + 3, "x " * 30_000, "en", "a")]


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_copies(spark):
    rows = rows_of(1)
    got = mixture.mixture_digest(frame(spark, rows, clashing=True).withColumn("size", mixture.F.lit("clash"))).collect()
    sizes, largest = collections.Counter(), collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += size(text)
        largest[source] = max(largest[source], size(text))
    target = plain_targets(sizes)
    assert sorted((str(r.doc_id), r.size, r.source_size, round(r.target, 6)) for r in got) == sorted(
        (str(i), size(text), sizes[source], round(target[source], 6)) for i, text, _, source in rows
    )
    source_of = {r[0]: r[3] for r in rows}
    taken = collections.Counter()
    for r in got:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source_of[r.doc_id]] += r.taken
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= largest[source] + 1e-3, source
    again = mixture.mixture_digest(frame(spark, rows).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_one_copy_for_each_integer_crossed(spark):
    """Copies from exact fractions in the same order: sizes, then the ids' hashes."""
    import hashlib

    rows = rows_of(2, 200)
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += size(text)
    target = plain_targets(sizes)
    want = collections.Counter()
    for source in sizes:
        own = sorted((r for r in rows if r[3] == source), key=lambda r: (size(r[1]), hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()))
        expected = min(3 * 10**9, int(target[source] / sizes[source] * 10**9 + 0.5)) if sizes[source] else 0
        offset = int(hashlib.md5(("mixture-1:" + ("null" if source is None else "=" + source)).encode()).hexdigest()[:15], 16) % 10**9
        for i, r in enumerate(own):
            want[r[0], (expected * (i + 1) + offset) // 10**9 - (expected * i + offset) // 10**9] += 1
    got = mixture.drawn(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.n_copies) for r in got) == want


def test_mixed_emits_whole_rows(spark):
    rows = rows_of(3, 120)
    docs = frame(spark, rows, clashing=True)
    copies = collections.Counter()
    for r in mixture.drawn(docs).collect():
        copies[r.doc_id] += r.n_copies
    got = mixture.mixed(docs)
    assert got.columns == [*docs.columns, "copy"]
    emitted = got.collect()
    assert collections.Counter(r.doc_id for r in emitted) == +copies
    assert {(r.doc_id, r.text, r.source) for r in emitted} <= {(r[0], r[1], r[3]) for r in rows}
    assert max(r.copy for r in emitted) <= 3 and all(r.asDict()[name] == i for r in emitted for i, name in enumerate(CLASHING))


def test_empty_and_wordless(spark):
    assert mixture.mixture_digest(frame(spark, rows_of(1)).limit(0)).count() == 0
    got = mixture.mixture_digest(frame(spark, [(1, None, "en", "a"), (2, " \n", "en", None)])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_hot_source_of_one_size_is_spread(spark):
    """A third of all rows in one source and of one size: no window group holds more than a few of them."""
    docs = spark.range(40_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'one two', concat('a ', repeat('b ', cast(id % 50 as int)))) AS text", "if(id % 3 = 0, 'hot', concat('s', id % 9)) AS source")
    own = docs.selectExpr("source", "text", "substring(md5(cast(doc_id as string)), 1, 3) AS salt")
    assert own.groupBy("source", "text", "salt").count().agg({"count": "max"}).first()[0] < 20
    got = mixture.mixture_digest(docs).groupBy("source_size", "target").agg(mixture.F.sum("taken").alias("taken"), mixture.F.max("size").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= r.most + 1 for r in got)
