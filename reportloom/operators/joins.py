"""Enrichment joins under the two null rules, and their forms for large or skewed sides.

SQL joins never match null keys; merges of report frames match null with null. Broadcasting is left to
the size statistics Spark has. Adaptive skew handling splits hot keys on the left of a left join and on both sides of
an inner join; a membership test only sees the distinct keys of its right side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _renamed_keys(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return right.withColumnsRenamed({k: f"__right_{k}" for k in keys})


def _null_safe(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])


#: Rows that null keys may give in a merge: left rows without a key times right rows without one. More of them are an error.
MAX_NULL_MATCHES = 100_000


def merged_rows(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """`matches`, the exact number of matching pairs of a null-safe merge, one row: for each key left rows times right rows.

    Both sides are counted per key first, so a frequent key is one row on either side and no pair is formed.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    count = F.count(F.lit(1)).cast("decimal(19,0)")
    lefts = left.groupBy(*keys).agg(count.alias("__left"))
    rights = _renamed_keys(right.groupBy(*keys).agg(count.alias("__right")), keys)
    both = lefts.join(rights, _null_safe(keys))
    return both.agg(F.coalesce(F.sum(F.col("__left") * F.col("__right")), F.lit(0)).alias("matches"))


def _with_guard(left: DataFrame, right: DataFrame, keys: Sequence[str], max_null_matches: int | None, max_matches: int | None) -> DataFrame:
    """`right`, which fails when read if the merge would have more matches by null keys, or in all, than are allowed."""
    with_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    for most, rows, what in ((max_null_matches, with_null, "null keys"), (max_matches, None, "keys")):
        if most is None:
            continue
        sides = (left, right) if rows is None else (left.where(rows), right.where(rows))
        matches = merged_rows(*sides, keys).scalar()
        message = F.concat(F.lit(f"{what} match in "), matches.cast("string"), F.lit(f" pairs of rows, more than {most}; clean the keys or raise the bound"))
        checked = F.lit(True) if rows is None else rows
        right = right.where(F.assert_true(~checked | (matches <= most), message).isNull())
    return right


def left_lookup(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """SQL left join: a null key finds nothing."""
    return left.join(right, on, "left")


def left_lookup_where(left: DataFrame, right: DataFrame, on: str, condition: Column) -> DataFrame:
    """Left join with a condition on the right side in ON: the left rows all stay."""
    return left.join(right.where(condition), on, "left")


def left_merge(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    max_null_matches: int | None = MAX_NULL_MATCHES,
    max_matches: int | None = None,
) -> DataFrame:
    """Left join in which a null key matches null keys.

    Before any pair is formed, the matches of null keys are counted exactly, and more than `max_null_matches` raise; so do more than
    `max_matches` by any keys. None spares the count, as for a right side with one row per key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    right = _renamed_keys(_with_guard(left, right, keys, max_null_matches, max_matches), keys)
    return left.join(right, _null_safe(keys), "left").drop(*[f"__right_{k}" for k in keys])


def left_merge_large_right(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    right_keys: DataFrame | None = None,
    max_null_matches: int | None = MAX_NULL_MATCHES,
    max_matches: int | None = None,
) -> DataFrame:
    """`left_merge` for a large right side that may hold hot keys.

    A left outer join can neither broadcast its left side nor split a hot key on its right. The inner part can
    do both, and the unmatched left rows only need the distinct right keys. `right_keys` may give a cheaper frame
    with the same keys as `right`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    hidden = [f"__right_{k}" for k in keys]
    renamed = _renamed_keys(_with_guard(left, right, keys, max_null_matches, max_matches), keys)
    matched = left.join(renamed, _null_safe(keys), "inner").drop(*hidden)
    present = _renamed_keys((right if right_keys is None else right_keys).select(*keys), keys).distinct()
    unmatched = left.join(present, _null_safe(keys), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def attribute_joins(
    header: DataFrame,
    cells: DataFrame,
    key: str,
    attributes: Mapping[str, str],
    name: str = "name",
    value: str = "value",
) -> DataFrame:
    """Each attribute as a column, as by one left join per attribute: `{column: attribute name}`.

    One conditional aggregate gives the forms without a repeated attribute. Repeated attributes multiply rows, so only the forms
    that have one are joined attribute by attribute; a form with very many cells can then be split on either side.
    """
    wanted = cells.where(F.col(name).isin(list(attributes.values()))).select(key, F.col(name).alias("__name"), F.col(value).alias("__value"))
    hits = {column: F.col("__name") == attribute for column, attribute in attributes.items()}
    most = F.greatest(*[F.count_if(hit) for hit in hits.values()], F.lit(0)).alias("__most")
    once = wanted.groupBy(key).agg(most, *[F.max(F.when(hit, F.col("__value"))).alias(c) for c, hit in hits.items()])
    single = header.join(once, key, "left").where(F.coalesce(F.col("__most"), F.lit(0)) <= 1).drop("__most")
    repeated = once.where("__most > 1").select(key)
    # The key inside a struct is another partitioning than the one of the semi-join, so the joins shuffle by themselves and
    # adaptive execution can split their hot keys.
    boxed = F.struct(F.col(key).alias("key"))
    several = header.join(repeated, key, "left_semi").withColumn(key, boxed)
    several = _joined_attributes(several, wanted.withColumn(key, boxed), key, hits).withColumn(key, F.col(key)["key"])
    return single.unionByName(several)


def _joined_attributes(header: DataFrame, cells: DataFrame, key: str, hits: Mapping[str, Column]) -> DataFrame:
    """One join per attribute. A form that lacks an attribute gets a null row for it first, so all joins are inner."""
    # One bit per attribute, so that every branch below needs the same columns and Spark reuses their shuffle.
    bits = {column: 1 << i for i, column in enumerate(hits)}
    found = cells.groupBy(key).agg(F.bit_or(F.coalesce(*[F.when(hit, bits[c]) for c, hit in hits.items()])).alias("__found"))
    flagged = header.select(key).join(found, key, "left").withColumn("__found", F.coalesce("__found", F.lit(0)))
    out = header
    for column, hit in hits.items():
        given = cells.where(hit).select(key, F.col("__value").alias(column))
        lacking = flagged.where(F.col("__found").bitwiseAND(F.lit(bits[column])) == 0).select(key, F.lit(None).alias(column))
        out = out.join(given.union(lacking), key)
    return out


def snowflake(fact: DataFrame, *steps: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """Chain of left joins; later filters on dimension columns make Catalyst turn them into inner joins."""
    return reduce(lambda df, step: df.join(step[0], step[1], "left"), steps, fact)


def in_use(df: DataFrame, parts: DataFrame, on: str) -> DataFrame:
    return df.join(parts.select(on).distinct(), on, "left_semi")


def not_in_use(df: DataFrame, parts: DataFrame, on: str) -> DataFrame:
    """Rows whose part is not in use. Rows repeated in the input stay, one copy per input row."""
    return df.join(parts.select(on).distinct(), on, "left_anti")
