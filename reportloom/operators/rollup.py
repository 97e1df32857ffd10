"""Aggregations. Sums that end a report frame give 0 for all-null input and skip null keys; SQL sums do not."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reportloom.functions.dates import in_month
LEVEL_ALL, LEVEL_GROUP, LEVEL_DAY = 1, 2, 3


def daily_by_category(
    fact: DataFrame,
    products: DataFrame,
    keys: Sequence[str],
    product: str,
    category: str,
    measures: Sequence[str],
) -> DataFrame:
    """Sums by the keys (day, group, ...) and product category; facts without a known product drop out.

    The fact is summed per product before the join, so a hot product shuffles one row per task and key. A sum has the type
    of one sum over the fact, however often it is summed on the way.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    kinds = {f.name: f.dataType for f in fact.agg(*sums).schema}
    joined = fact.groupBy(*keys, product).agg(*sums).join(products.select(product, category), product)
    return joined.groupBy(*keys, category).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in measures])


def three_levels(
    daily: DataFrame, day: str, group: str, category: str, measures: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Level 1 (day, group, category), level 2 (day, group) and level 3 (day) in one pass, per `within` columns.

    Levels 2 and 3 are report sums: null keys of the level drop out and an all-null sum is 0.
    """
    within = list(within)
    sets = [[*within, day, group, category], [*within, day, group], [*within, day]]
    code = F.grouping_id()
    levels = daily.groupingSets(sets, *within, day, group, category).agg(
        F.when(code == 0, LEVEL_ALL).when(code == 1, LEVEL_GROUP).otherwise(LEVEL_DAY).alias("level"),
        *[F.sum(m).alias(m) for m in measures],
    )
    top = F.col("level") != LEVEL_ALL
    known = (F.col("level") == LEVEL_ALL) | (
        F.col(day).isNotNull() & ((F.col("level") == LEVEL_DAY) | F.col(group).isNotNull())
    )
    return levels.where(known).withColumns(
        {m: F.when(top, F.coalesce(F.col(m), F.lit(0))).otherwise(F.col(m)) for m in measures}
    )


def report_sums(df: DataFrame, keys: str | Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums of a report frame: rows with a null key are skipped and an all-null sum is 0."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    )


def latest_known(value: Column, moment: Column, where: Column | None = None) -> Column:
    """The non-null value with the latest moment; equal moments are settled by the greater value."""
    known = value.isNotNull() if where is None else value.isNotNull() & where
    return F.max_by(value, F.when(known, F.struct(moment, value)))


def _month_pair(day: str, as_of: date) -> tuple[Column, Column, Column]:
    """This month, last month, and both as one range for the scan."""
    c = F.col(day)
    return in_month(c, as_of), in_month(c, as_of, 1), in_month(c, as_of, 1, months=2)


def month_pair_orders(
    orders: DataFrame, key: str, day: str, amount: str, representative: str, as_of: date
) -> DataFrame:
    """This and last month's order total and latest known representative per customer, from one scan.

    A month without rows gives nulls; a month with only null amounts gives 0. Null customers drop out.
    """
    this, last, either = _month_pair(day, as_of)
    amounts = {
        f"{label}_month_order_amount": F.when(F.count_if(hit) > 0, F.coalesce(F.sum(F.when(hit, F.col(amount))), F.lit(0)))
        for label, hit in (("this", this), ("last", last))
    }
    people = {
        f"{label}_month_representative": latest_known(F.col(representative), F.col(day), hit)
        for label, hit in (("this", this), ("last", last))
    }
    return (
        orders.where(either)
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[c.alias(n) for n, c in {**amounts, **people}.items()])
    )


def month_pair_sums(df: DataFrame, key: str, day: str, amount: str, as_of: date, suffix: str) -> DataFrame:
    """This and last month's SQL sum per key from one scan; the null key stays a group."""
    this, last, either = _month_pair(day, as_of)
    return (
        df.where(either)
        .groupBy(key)
        .agg(
            F.sum(F.when(last, F.col(amount))).alias(f"last_month_{suffix}"),
            F.sum(F.when(this, F.col(amount))).alias(f"this_month_{suffix}"),
        )
    )


def occurrences(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per non-null key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def occurrences_where(df: DataFrame, key: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Several conditional counts per non-null key in one pass; keys that meet none drop out."""
    any_hit = None
    for hit in conditions.values():
        any_hit = hit if any_hit is None else any_hit | hit
    return (
        df.where(F.col(key).isNotNull() & any_hit)
        .groupBy(key)
        .agg(*[F.count_if(hit).alias(n) for n, hit in conditions.items()])
    )


#: A cell holds at most this many bytes.
MOST_CELL_BYTES = (1 << 31) - 64


def joined_text(df: DataFrame, key: str, text: str, order_by: str, separator: str = "\r\n", most_bytes: int = MOST_CELL_BYTES) -> DataFrame:
    """All texts of a key as one text in `order_by` order; null texts and null keys are skipped.

    The rows are range-partitioned by key and order, so a key with very many texts lies in several ranges, one after the other. Each
    range joins its texts of a key to a block, then the blocks of a key are joined in order of the ranges. A key's result is one cell: the
    sizes are summed up before any text is joined, and more than `most_bytes` raise.
    """
    known = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, F.col(order_by).alias("__order"), F.col(text).alias("__text"))
    sizes = known.groupBy(key).agg(F.sum(F.octet_length("__text") + len(separator.encode())).alias("bytes"))
    largest = sizes.agg(F.coalesce(F.max("bytes"), F.lit(0)) - len(separator.encode())).scalar()
    message = F.concat(F.lit("the texts of one key have "), largest.cast("string"), F.lit(f" bytes, more than {most_bytes} that fit one cell"))
    checked = known.where(F.assert_true(largest <= most_bytes, message).isNull())
    ranged = checked.repartitionByRange(key, "__order").withColumn("__range", F.spark_partition_id())
    parts = F.transform(F.array_sort(F.collect_list(F.struct("__order", "__text"))), lambda x: x["__text"])
    blocks = ranged.groupBy(key, "__range").agg(F.array_join(parts, separator).alias("__text"))
    joined = F.transform(F.array_sort(F.collect_list(F.struct("__range", "__text"))), lambda x: x["__text"])
    return blocks.groupBy(key).agg(F.array_join(joined, separator).alias(text))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass by, without a pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
