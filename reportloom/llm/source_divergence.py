"""Divergence of sources: which sources of a language use its terms how differently, and by which terms a source stands out.

Terms are counted per language and source by `term_counts` (length-bucketed packing, radix sort, run counts). A language keeps the
terms that enough of its documents hold; every group, a source within a language, gives each of them a smoothed share in
billionths, and the language as a whole does as well. A part `pair` row tells how far a group is from another source of its
language, summed over all kept terms; a part `term` row is a term that the group uses more than its language. All whole numbers.

Terms that neither of two groups has add the same amount each, so a term costs work for the groups that hold it only. Terms are
dealt over `BLOCKS` blocks of each language; a block has the table of the language's sources in front and gives one partial sum
for each pair. Memory of a block's task follows the number of pairs of sources, which is the size of the result as well.

Cases: null texts, languages and sources are empty strings; a group without terms gives all terms the same share; without kept
terms pairs have the value 0; a language with one source has no pairs; repeated rows are documents like any others and null
ids are not looked at; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from .common import prepare, task_step, written
from .term_counts import TermCounter

#: A term is kept if so many documents of its language have it; so many terms of a group are reported.
MIN_DOCS, TOP_TERMS = 3, 200
UNIT = 1_000_000_000
BLOCKS = 64
#: Pairs of groups worked on at a time, and numbers of a group remembered before equal ones are joined.
PAIRS, REMEMBERED = 1 << 20, 1 << 20
TERM = ["w1", "w2", "long_term"]


def _plain(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(*(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """`lang`, `source`, the packed term, its occurrences `n` and documents `n_docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter()
        for batch in batches:
            yield from counter.take(batch)
        yield from counter.flush()

    counts = task_step(_plain(docs), run, TermCounter.SCHEMA)
    return counts.groupBy("lang", "source", *TERM).agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _unpacked() -> Column:
    """The text of a packed term: its first byte is never zero, the filling is."""
    second = F.when(F.col("w2") == 0, F.lit("")).otherwise(F.hex("w2"))
    short = F.unhex(F.regexp_replace(F.concat(F.hex("w1"), second), "(00)+$", ""))
    return F.decode(F.coalesce("long_term", short), "UTF-8")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """`lang`, `term`, `n` in the language, and `own`: (source, n) of each source that has it."""
    by_term = term_counts(docs).groupBy("lang", *TERM).agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"), F.collect_list(F.struct("source", "n")).alias("own")
    )
    return by_term.where(F.col("n_docs") >= min_docs).select("lang", _unpacked().alias("term"), "n", "own")


def _share(n: Column, total: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / total), exact."""
    number = lambda c, digits: c.cast(f"decimal({digits},0)")
    return F.lit(1).cast("long") + F.call_function("div", number(F.lit(UNIT), 10) * number(n + 1, 19), number(total, 19))


def groups_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """`lang`, `source` of each group that occurs, `total` and `lang_total` (occurrences and terms, the divisors of shares), `n_terms`."""
    groups = _plain(docs).select("lang", "source").distinct()
    own = terms.select("lang", F.inline("own")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("lang_n"))
    joined = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["n", "n_terms", "lang_n"])
    return joined.select("lang", "source", "n_terms", (F.col("n") + F.col("n_terms")).alias("total"), (F.col("lang_n") + F.col("n_terms")).alias("lang_total"))


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """`_share` in whole 64-bit numbers: long division, a thousand at a time."""
    if len(total) and total.max() > 9 * 10**15:
        raise ValueError("more than 9 * 10**15 terms in a group")
    whole, rest = np.divmod(n + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def _gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class PairSums:
    """Sums over the terms of one block of a language, for all pairs of its sources."""

    def __init__(self, lang: str, block: int) -> None:
        self.lang, self.block, self.n_terms = lang, block, 0
        self.sources: list[str] = []
        self._totals: list[np.ndarray] = []
        self._seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._sums: np.ndarray | None = None

    def add_groups(self, batch: pa.RecordBatch) -> None:
        self.sources += batch["source"].to_pylist()
        self._totals.append(batch["total"].to_numpy())
        self.n_terms = batch["n_terms"][0].as_py()

    def _start(self) -> None:
        if self._sums is None:
            self.total = np.concatenate(self._totals)
            m = len(self.total)
            # Without kept terms there is no share, and nothing to add up.
            self.zero = _shares(np.zeros(m, np.int64), self.total) if self.n_terms else np.ones(m, np.int64)
            self.value_set = pa.array(self.sources, pa.string())
            self._sums = np.zeros((m, m), np.int64)

    def add_terms(self, own: pa.ListArray) -> None:
        """Terms by the sources that have them."""
        self._start()
        flat, sizes = own.flatten(), own.value_lengths().to_numpy()
        at = pc.index_in(flat.field("source"), value_set=self.value_set).to_numpy().astype(np.int64)
        p = _shares(flat.field("n").to_numpy(), self.total[at])
        first = np.cumsum(sizes) - sizes
        for k in np.unique(sizes):
            rows = first[sizes == k][:, None] + np.arange(k)
            step = max(1, PAIRS // int(k) ** 2)
            for i in range(0, len(rows), step):
                self._add_pairs(at[rows[i : i + step]], p[rows[i : i + step]])
        self._remember(at, p, np.ones(len(at), np.int64))

    def _add_pairs(self, at: np.ndarray, p: np.ndarray) -> None:
        """What the pairs that both have a term add beyond the one-sided parts."""
        z = self.zero[at]
        a, b = (slice(None), slice(None), None), (slice(None), None, slice(None))
        value = _gain(p[a], p[b]) - _gain(p[a], z[b]) - _gain(z[a], p[b]) + _gain(z[a], z[b])
        np.add.at(self._sums.reshape(-1), (at[a] * len(self.zero) + at[b]).reshape(-1), value.reshape(-1))

    def _remember(self, at: np.ndarray, p: np.ndarray, times: np.ndarray) -> None:
        self._seen.append((at, p, times))
        if sum(len(x[0]) for x in self._seen) > REMEMBERED:
            self._seen = [self._joined()]
            if len(self._seen[0][0]) > REMEMBERED // 2:
                self._add_one_sided()

    def _joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, p, times = (np.concatenate(x) for x in zip(*self._seen, strict=True))
        order = np.lexsort((p, at))
        at, p, times = at[order], p[order], times[order]
        new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (p[1:] != p[:-1])))
        return at[new], p[new], np.add.reduceat(times, new)

    def _add_one_sided(self) -> None:
        """What a term of one group adds to its pairs with all groups, as if they had it not."""
        if not self._seen:
            return
        at, p, times = self._joined()
        m = len(self.zero)
        for i in range(0, len(at), max(1, PAIRS // m)):
            cut = slice(i, i + max(1, PAIRS // m))
            a, own, n, z = at[cut], p[cut][:, None], times[cut][:, None], self.zero[None, :]
            base = self.zero[a][:, None]
            np.add.at(self._sums, a, (_gain(own, z) - _gain(base, z)) * n)
            np.add.at(self._sums.T, a, (_gain(z, own) - _gain(z, base)) * n)
        self._seen = []

    def result(self) -> Iterator[pa.RecordBatch]:
        """Partial sums of the pairs; block 0 has all of them, with what the terms that neither group has add."""
        self._start()
        self._add_one_sided()
        m = len(self.zero)
        for i in range(m):
            value = self._sums[i]
            if self.block == 0:
                value = value + self.n_terms * _gain(self.zero[i : i + 1], self.zero)
            others = np.flatnonzero((value != 0) | (self.block == 0))
            others = pa.array(others[others != i])
            count = len(others)
            names = [pa.array([self.lang] * count, pa.string()), pa.array([self.sources[i]] * count, pa.string()), self.value_set.take(others)]
            yield pa.RecordBatch.from_arrays([*names, pa.array(value).take(others)], ["lang", "source", "item", "value"])


def pair_sums(terms: DataFrame, groups: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """`lang`, `source`, `item` (another source of the language) and `value` for every pair of groups of a language."""
    none = F.lit(None).cast(terms.schema["own"].dataType)
    tables = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("kind"), "source", "total", "n_terms", none.alias("own"))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    rows = terms.select("lang", block.alias("block"), F.lit(1).alias("kind"), F.lit("").alias("source"), F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("n_terms"), "own")
    ordered = tables.unionByName(rows).repartition("lang", "block").sortWithinPartitions("lang", "block", "kind", "source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: PairSums | None = None
        for batch in batches:
            langs, numbers, kinds = batch["lang"].to_pylist(), batch["block"].to_pylist(), batch["kind"].to_pylist()
            keys = list(zip(langs, numbers, kinds, strict=True))
            i = 0
            while i < len(keys):
                j = i
                while j < len(keys) and keys[j] == keys[i]:
                    j += 1
                if state is None or (state.lang, state.block) != keys[i][:2]:
                    if state is not None:
                        yield from state.result()
                    state = PairSums(*keys[i][:2])
                if keys[i][2] == 0:
                    state.add_groups(batch.slice(i, j - i))
                else:
                    state.add_terms(batch.slice(i, j - i)["own"])
                i = j
        if state is not None:
            yield from state.result()

    partial = task_step(ordered, run, "lang string, source string, item string, value long")
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_gains(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """`lang`, `source`, `item` (a term that the group uses more than its language) and `value`."""
    own = terms.select("lang", F.col("term").alias("item"), F.col("n").alias("lang_n"), F.inline("own"))
    shares = own.join(groups, ["lang", "source"]).select(
        "lang", "source", "item", _share(F.col("n"), F.col("total")).alias("p"), _share(F.col("lang_n"), F.col("lang_total")).alias("q")
    )
    return shares.where("p > q").selectExpr("lang", "source", "item", "(p - q) * (p - q) div q AS value")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank`: all other sources of each group, and its `top` terms."""
    terms = written(kept_terms(docs, min_docs), "kept-terms")
    groups = written(groups_of(docs, terms), "term-groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_sums(terms, groups).withColumn("rank", F.row_number().over(order))
    best = term_gains(terms, groups).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    parts = [df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, df in (("pair", pairs), ("term", best))]
    return parts[0].unionByName(parts[1])
