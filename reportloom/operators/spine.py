"""Date spine, named slices of a frame, and filling of missing days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Slice:
    """A named subset of a frame: equality filters, and the columns the slice shows besides the day."""

    slice_id: str
    columns: Sequence[str]
    filters: Mapping[str, object] = field(default_factory=dict)


def spine_days(as_of: date, days: int = 14) -> Column:
    """Array of the `days` days that end yesterday."""
    return F.sequence(F.lit(as_of - timedelta(days=days)), F.lit(as_of - timedelta(days=1)))


def date_spine(spark: SparkSession, as_of: date, days: int = 14, name: str = "Date") -> DataFrame:
    return spark.range(1).select(F.explode(spine_days(as_of, days)).alias(name))


def _literal(value: object) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if value is None or isinstance(value, (bool, int, float, Decimal)):
        return "NULL" if value is None else str(value)
    raise TypeError(f"a slice filter takes text, numbers and booleans, not {value!r}")


def _owned(slices: Sequence[Slice], column: str, expression: str) -> Column:
    """The expression in slices that show the column, null in the others."""
    owners = [s.slice_id for s in slices if column in s.columns]
    if len(owners) == len(slices):
        return F.expr(expression)
    listed = ", ".join(_literal(o) for o in owners)
    return F.expr(f"CASE WHEN slice_id IN ({listed}) THEN {expression} END")


def cut_slices(frame: DataFrame, slices: Sequence[Slice], day: str) -> DataFrame:
    """Long frame of (slice, row): each row once per slice it belongs to, in one narrow pass.

    The conditions are one SQL text, since a report has dozens of them and every Column call costs a round trip.
    """
    hits = []
    for s in slices:
        condition = " AND ".join(f"`{c}` {'IS' if v is None else '='} {_literal(v)}" for c, v in s.filters.items()) or "true"
        hits.append(f"CASE WHEN {condition} THEN {_literal(s.slice_id)} END")
    cut = frame.withColumn("slice_id", F.expr(f"explode(array_compact(array({', '.join(hits)})))"))
    shown = sorted({c for s in slices for c in s.columns}, key=frame.columns.index)
    return cut.select("slice_id", day, *[_owned(slices, c, f"`{c}`").alias(c) for c in shown])


def _wanted_days(spark: SparkSession, slices: Sequence[Slice], as_of: date, day: str, days: int) -> DataFrame:
    ids = ", ".join(_literal(s.slice_id) for s in slices)
    wanted = spark.range(1).select(F.expr(f"explode(array({ids}))").alias("slice_id"))
    return wanted.select("slice_id", F.explode(spine_days(as_of, days)).alias(day))


def fill_missing_days(
    cut: DataFrame, slices: Sequence[Slice], as_of: date, day: str, days: int = 14, row_level: bool = False
) -> DataFrame:
    """Add a zero row for each day a slice lacks. Nulls on present days stay; text columns get `'0'`.

    An aggregated frame has few rows per slice and day and is evaluated once, by a full join with the spine.
    For a `row_level` frame, where one day of a slice may hold most rows, only the distinct (slice, day) pairs
    meet the spine and the rows themselves are not shuffled.
    """
    wanted = _wanted_days(cut.sparkSession, slices, as_of, day, days)
    zeros = {f.name: _zero(f, slices) for f in cut.schema.fields if f.name not in ("slice_id", day)}
    if row_level:
        missing = wanted.join(cut.select("slice_id", day).distinct(), ["slice_id", day], "left_anti")
        return cut.unionByName(missing.withColumns(zeros))
    joined = wanted.join(cut.withColumn("__present", F.lit(True)), ["slice_id", day], "full")
    filled = [F.when(F.col("__present"), F.col(c)).otherwise(zero).alias(c) for c, zero in zeros.items()]
    return joined.select("slice_id", day, *filled)


def _zero(f: T.StructField, slices: Sequence[Slice]) -> Column:
    zero = "'0'" if isinstance(f.dataType, T.StringType) else f"CAST(0 AS {f.dataType.simpleString()})"
    return _owned(slices, f.name, zero)


def rows_and_sums(
    frame: DataFrame, shown: Sequence[Slice], summed: Sequence[Slice], measures: Sequence[str], as_of: date, day: str, days: int = 14
) -> DataFrame:
    """The rows of the `shown` slices and the daily sums of the `summed` ones, both with a zero row for each day that they lack.

    One aggregate over the rows tagged with all slices gives the sums (0 for all-null measures) and tells which days are there;
    the rows themselves are not shuffled.
    """
    rows = cut_slices(frame, shown, day)
    totals = cut_slices(frame, [*shown, *summed], day).where(F.col(day).isNotNull()).groupBy("slice_id", day).agg(*[F.sum(m).alias(m) for m in measures])
    joined = _wanted_days(frame.sparkSession, [*shown, *summed], as_of, day, days).join(totals.withColumn("__present", F.lit(True)), ["slice_id", day], "full")
    is_sum = F.col("slice_id").isin([s.slice_id for s in summed])
    kept = joined.where(F.col("__present").isNull() | is_sum)
    columns = []
    for f in rows.schema.fields:
        if f.name in ("slice_id", day):
            continue
        zero = _zero(f, [*shown, *summed])
        if f.name in measures:
            own = F.col("slice_id").isin([s.slice_id for s in summed if f.name in s.columns])
            zero = F.when(F.col("__present"), F.when(own, F.coalesce(F.col(f.name), F.lit(0)).cast(f.dataType))).otherwise(zero)
        else:
            zero = F.when(F.col("__present").isNull(), zero)
        columns.append(zero.alias(f.name))
    return rows.unionByName(kept.select("slice_id", day, *columns))
