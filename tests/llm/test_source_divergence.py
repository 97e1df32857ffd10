import collections
import random
import re
import tracemalloc

import numpy as np
import pytest

from fixtures import frame
from reportloom.llm import common, source_divergence, term_counts

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain(rows, min_docs=3, top=200):
    counts, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    groups = collections.defaultdict(set)
    for _, text, lang, source in rows:
        lang, source, terms = lang or "", source or "", terms_of(text)
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(own):
            total = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), collections.Counter()))
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            best = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(best)[:top])):
                out |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)}
    return out


def rows_of(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "The", "the", "École", "écoLE", "x" * 8, "y" * 9, "z" * 16, "Q" * 17, "ß" * 20, "日本語" * 9, "日本語" * 9 + "é", "w" * 64, "w" * 65, "\x80", "ÀÀ"]
    words += [f"{c}{d}" for c in "abcdefgh" for d in ("", "b", "bc", "é")]
    rows = []
    for i in range(n):
        source = rng.choice(["s1"] * 8 + ["s2", "s3", None, "", "é"])
        own = [rng.choice(words[rng.randrange(len(words)) :]) for _ in range(rng.randrange(40))]
        rows.append((i, "".join(w + rng.choice([" ", ", ", "1", "\n", "_", "@"]) for w in own), rng.choice(["en", "en", "de", None]), source))
    rows += [(n, None, "en", "only null"), (n + 1, "", "en", "s9"), (n + 2, "one two", "fr", "alone"), (n + 3, "b c", "it", "x"), (n + 4, "c d", "it", "y")]
    return rows + [(None, "the the", "en", "s2"), (n + 5, "Long" * 30_000 + " the", "de", "s1"), rows[0], rows[0], rows[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_version(spark, seed):
    rows = rows_of(seed)
    got = source_divergence.divergence(frame(spark, rows, clashing=True), top=7)
    assert [t for _, t in got.dtypes] == ["string"] * 4 + ["bigint", "int"]
    assert {tuple(r) for r in got.collect()} == plain(rows, top=7)


def test_number_of_blocks_does_not_change_the_result(spark):
    rows = rows_of(3, 60)
    docs = frame(spark, rows)
    terms = source_divergence.written(source_divergence.kept_terms(docs), "t")
    groups = source_divergence.groups_of(docs, terms)
    want = {tuple(r) for r in source_divergence.pair_sums(terms, groups, 1).collect()}
    assert {tuple(r) for r in source_divergence.pair_sums(terms, groups, 7).collect()} == want
    assert {r[:3] for r in want} == {r[:2] + r[3:4] for r in plain(rows) if r[2] == "pair"}


def test_empty_table(spark):
    assert source_divergence.divergence(frame(spark, rows_of(1, 5)).limit(0)).count() == 0


def test_packed_counts_against_python():
    rng = random.Random(5)
    texts = [r[1] or "" for r in rows_of(5, 80)]
    groups = np.array([rng.randrange(3) for _ in texts])
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(b) for b in raw]))
    got = {}
    for group, first, second, longs, n, docs in term_counts.group_terms(np.frombuffer(b"".join(raw), np.uint8), offsets, groups):
        for i in range(len(n)):
            term = longs[i] if longs is not None else (int(first[i]).to_bytes(8, "big") + int(second[i]).to_bytes(8, "big")).rstrip(b"\0")
            assert (int(group[i]), term) not in got
            got[int(group[i]), term] = (int(n[i]), int(docs[i]))
    count, docs = collections.Counter(), collections.Counter()
    for text, g in zip(texts, groups, strict=True):
        own = collections.Counter(terms_of(text))
        count.update({(int(g), t.encode()): n for t, n in own.items()})
        docs.update((int(g), t.encode()) for t in own)
    assert got == {key: (count[key], docs[key]) for key in count}


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 5, 1000, np.uint32), rng.integers(0, 1 << 63, 1000, np.uint64) % np.uint64(70_000)
    assert (term_counts.radix_order([low, high]) == np.lexsort((low, high))).all()
    assert term_counts.radix_order([low[:0], high[:0]]).tolist() == []


def test_shares_beyond_64_bits():
    n, total = np.array([0, 10**15, 9 * 10**15 - 2], np.int64), np.array([1, 10**15 + 7, 9 * 10**15], np.int64)
    assert source_divergence._shares(n, total).tolist() == [1 + 10**9 * (int(a) + 1) // int(b) for a, b in zip(n, total, strict=True)]


def test_counting_takes_little_memory_for_its_text():
    """Places, documents and orders of terms are 32-bit numbers: an executor runs several counters beside its heap."""
    text = np.frombuffer(b" ".join(b"w%da" % (i % 5000) for i in range(200_000)).replace(b"0", b"x"), np.uint8)
    offsets = np.linspace(0, len(text), 101).astype(np.int64)
    groups = np.zeros(100, np.int64)
    tracemalloc.start()
    list(term_counts.group_terms(text, offsets, groups))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * len(text)


def test_a_task_gives_back_its_memory(monkeypatch):
    """Also one that ends early, as below a limit."""
    class Frame:
        def mapInArrow(self, run, schema):
            return run

    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    run = common.task_step(Frame(), iter, "x long")
    assert list(run(iter([1, 2]))) == [1, 2] and given == [1]
    early = run(iter([1, 2]))
    assert next(early) == 1
    early.close()
    assert given == [1, 1]
