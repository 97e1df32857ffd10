"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target over its size. Within a source the
documents stand in order of size; a document's expected copies are added to the prefix sum before it and to one random offset
of the source, and it is emitted once for each integer that the sum crosses. So the copies of any run of documents differ from
their expectation by less than one, and, as the sizes ascend, the words of a source from its target by at most its largest
document (and a rounding of half a billionth of a copy for each document). Sums are whole numbers of billionths: nothing drifts.

Prefix sums need no window over a source: documents are numbered within (size, first digits of the id's hash), and the counts of
those groups and of the sizes are summed up separately. A source of one size for all is spread over 4,096 groups.

DataFrame operations only, no Python code. Cases: a null text has size 0 and documents of size 0 take no words; the null source
is a source of its own and comes last; rows that agree in id and text are documents that may be told apart by nothing, each with
its own copies; null ids are allowed; an empty table gives an empty result; further columns are ignored, or kept in `mixed`.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from .common import prepare, text_key, written
from .quality_rules import SPACES, WORD_GAP

#: Weights of the sources in order of their names, repeated, and how often a source may be used.
WEIGHTS, MOST = (1, 2, 3), 3
SEED = "mixture-1"
#: Expected copies are counted in billionths.
UNIT = 1_000_000_000
SALT_DIGITS = 3


def n_words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, WORD_GAP))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """`source`, `source_size`, `target` for rows of `source`, `size`: one row for each source.

    The targets fill `share` of all sizes by weight like water in vessels of `most` times the source's size. Sorted by the level at
    which they are full, each vessel has the level that the water would have if the ones before it were full; the highest of
    these levels is the true one.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    full = F.col("source_size") * most
    weighed = sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (place - 1) % len(weights)).cast("long"))
    every = Window.partitionBy()
    fuller = Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    water = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum(full).over(fuller), F.lit(0))
    room = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(fuller), F.lit(0))
    level = F.max("level").over(every)
    levels = weighed.withColumn("level", water.cast("double") / room)
    return levels.select("source", "source_size", F.least(full.cast("double"), level * F.col("weight")).alias("target"))


def _offset(seed: str) -> Column:
    """One number below `UNIT` for each source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % UNIT


def drawn(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, share: float = 1.0, seed: str = SEED, whole: bool = False) -> DataFrame:
    """`doc_id`, `source`, `size`, `source_size`, `target`, `n_copies` of each row, and with `whole` the row itself as `doc`."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(text).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("hash"),
        *([text_key(text).alias("key"), F.struct(*docs.columns).alias("doc")] if whole else []),
    )
    own = written(own.withColumn("salt", F.substring("hash", 1, SALT_DIGITS)), "document-sizes")
    targets = written(source_targets(own, weights, most, share), "source-targets").select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.least(F.lit(most * UNIT), F.floor(F.try_divide("target", "source_size") * UNIT + 0.5))).otherwise(F.lit(0)).alias("expected"),
        _offset(seed).alias("offset"),
    )

    def before(by: list[str], order: str, count: Column) -> Column:
        return F.coalesce(F.sum(count).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = own.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n"))
    sizes = groups.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = sizes.select("source", "size", before(["source"], "size", F.col("n")).alias("smaller"))
    groups = groups.select("source", "size", "salt", before(["source", "size"], "salt", F.col("n")).alias("ahead"))

    def joined(left: DataFrame, right: DataFrame, *by: str) -> DataFrame:
        right = right.withColumnsRenamed({name: f"{name}_2" for name in by})
        same = [F.col(name).eqNullSafe(F.col(f"{name}_2")) for name in by]
        return left.join(right, same, "inner").drop(*(f"{name}_2" for name in by))

    in_group = Window.partitionBy("source", "size", "salt").orderBy("hash", *(["key"] if whole else []))
    numbered = own.withColumn("place", F.row_number().over(in_group))
    known = joined(groups, written(joined(sizes, targets, "source"), "size-offsets"), "source", "size")
    placed = joined(numbered, known, "source", "size", "salt").withColumn("place", (F.col("smaller") + F.col("ahead") + F.col("place")).cast("decimal(19,0)"))

    def crossed(place: Column) -> Column:
        total = F.col("expected").cast("decimal(18,0)") * place + F.col("offset").cast("decimal(10,0)")
        return F.call_function("div", total, F.lit(UNIT).cast("decimal(10,0)"))  # `/` would round the quotient before it is cut

    copies = crossed(F.col("place")) - crossed(F.col("place") - 1)
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("n_copies"), *(["doc"] if whole else []))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, share: float = 1.0, seed: str = SEED) -> DataFrame:
    """The mixture itself: each row of `docs` as often as it is drawn, with `copy` from 1 (`copy_of_mix` where `docs` has such a column)."""
    name = "copy" if "copy" not in docs.columns else "copy_of_mix"
    taken = drawn(docs, weights, most, share, seed, whole=True).where("n_copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))).alias(name)).select("doc.*", name)


def mixture_digest(docs: DataFrame) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target`, `taken` of each row."""
    return drawn(docs).select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"))
