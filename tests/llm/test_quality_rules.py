import collections
import random
import re

import numpy as np

from fixtures import frame
from reportloom.llm import quality_rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def rows_of(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        own = [rng.choice(["alpha", "beta", "Gamma,", "delté", "of", "x"]) + str(rng.randrange(200)) for _ in range(rng.randrange(3, 120))]
        if i % 9 == 0:
            own = [w + rng.choice(["%%%", "***"]) for w in own]
        if i % 11 == 0:
            own = own[:5] * 20
        text = "".join(w + rng.choice([" ", "\n", "\x0b", "\t ", "\n\n"]) for w in own)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", None])))
    return [*rows, (1000, None, "en", "s1"), (1001, "", None, None), (None, " \n ", "xx", "rare"), (1002, "word " * 30_000, "en", "s1"), rows[0], rows[0]]


def test_counts_against_a_plain_version(spark):
    rows = rows_of(1)
    got = quality_rules.judged(frame(spark, rows, clashing=True))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert [t for c, t in got.dtypes if c in columns] == ["bigint"] * 6 + ["boolean"]
    want = sorted(((r[0], *plain_counts(r[1])) for r in rows), key=str)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == want
    assert all(not (r.base_failed and r.kept) for r in got.collect())
    assert quality_rules.judged(frame(spark, rows).limit(0)).count() == 0


def test_verdicts_against_exact_quartiles(spark):
    rows = rows_of(2, 900)
    got = quality_rules.judged(frame(spark, rows)).collect()
    measures = list(quality_rules.MEASURES)

    def measured(text):
        words, chars, symbols, dup_lines, repeat, _ = plain_counts(text)
        lines = len([x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
        marks = sum(c in "!?" for c in text or "")
        w, n = max(words, 1), max(lines, 1)
        return dict(zip(measures, (symbols / w, marks / w, dup_lines / n, repeat / w, chars / w), strict=True))

    groups = collections.defaultdict(list)
    for _, text, lang, source in rows:
        for key in ((lang, source), (lang,), ()):
            groups[key].append(measured(text))

    def kept(text, lang, source):
        if plain_counts(text)[-1]:
            return False
        for name, value in measured(text).items():
            floor, both = quality_rules.MEASURES[name]
            quartiles = np.zeros(2)
            for key in ((), (lang,), (lang, source)):
                n = len(groups[key])
                own = np.quantile([m[name] for m in groups[key]], [0.25, 0.75], method="inverted_cdf")
                quartiles = own if key == () else (n * own + quality_rules.PRIOR * quartiles) / (n + quality_rules.PRIOR)
            q1, q3 = quartiles
            reach = max(floor, quality_rules.FENCE_WIDTH * (q3 - q1))
            if value > q3 + reach or both and value < q1 - reach:
                return False
        return True

    want = collections.Counter((r[0], kept(*r[1:])) for r in rows)
    have = collections.Counter((r.doc_id, r.kept) for r in got)
    # The sketches are exact for small groups; a quartile may be the neighbouring value.
    assert sum((want - have).values()) <= 0.01 * len(rows)
    assert 0.2 < np.mean([r.kept for r in got]) < 0.95


def test_one_document_more_moves_thresholds_a_little(spark):
    """Around the size of the prior as at any other size: no threshold jumps from one sketch to another."""
    rng = random.Random(4)

    def row(i, source, symbol):
        return i, " ".join(f"w{rng.randrange(500)}" + "%" * (rng.random() < symbol) for _ in range(60)), "en", source

    noisy, plain = [row(i, "noisy", 0.6) for i in range(103)], [row(1000 + i, "plain", 0.02) for i in range(900)]

    def high(n):
        fences = quality_rules.group_fences(quality_rules.word_counts(frame(spark, noisy[:n] + plain)))
        return fences.where("source = 'noisy'").first().high_symbols_per_word

    at = [high(n) for n in (97, 98, 99, 100, 101, 102)]
    # Values lie 1/60 apart; each quartile may move by one of them, at half weight: 0.5 * (4 + 3) / 60 in the fence.
    assert max(abs(a - b) for a, b in zip(at, at[1:], strict=False)) < 0.06
    assert high(5) < at[0] < 3
