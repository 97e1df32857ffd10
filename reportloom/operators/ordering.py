"""Report order, row positions and runs of equal cells.

A report may hold one sheet, so positions and runs never use a window per sheet. An index holds the keys of the rows only: they are
range-partitioned and sorted in report order, numbered within their range, and the counts of the ranges before are
added; then it is joined back to the rows by key. Runs of equal cells are summed up per range in the same way. What crosses ranges is
one summary row for each of them. A key that is not unique has no order, which is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reportloom.session import materialise

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def category_rank(c: Column, order: Sequence[str]) -> Column:
    """Position in a given order, null for a value outside it."""
    position = F.array_position(F.array(*[F.lit(v) for v in order]), c)
    return F.when(position > 0, position - 1)


def in_category_order(df: DataFrame, column: str, order: Sequence, *rest: Column | str) -> DataFrame:
    """Sorted by the position of `column` in a given order, values outside it last, then by `rest`; the rank itself is dropped."""
    ranked = df.withColumn("__rank", category_rank(F.col(column), order))
    return ranked.orderBy(F.col("__rank").asc_nulls_last(), *rest).drop("__rank")


def urgency_order(days: Column) -> list[Column]:
    """Expired first, -1 before -2, then valid ones ascending."""
    return [(days >= 0).asc_nulls_last(), F.abs(days).asc_nulls_last()]


def _key_names(order: Sequence[Column | str], key: Sequence[str] | None) -> list[str]:
    names = [o for o in order if isinstance(o, str)] if key is None else list(key)
    if not names:
        raise ValueError("name the key: no column of the order is given by its name")
    return names


def _in_ranges(df: DataFrame, order: Sequence[Column | str], columns: Sequence[Column]) -> DataFrame:
    """The columns in report order: `__part` is a row's range and `__local` its number there. Stored, so that both stay as they are.

    The other columns only serve the order, or are dropped before anything is shuffled.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = materialise(ranged.select(*columns, F.monotonically_increasing_id().alias("__mark")))
    return fixed.withColumns(
        {
            "__part": F.shiftright("__mark", _LOCAL_BITS).cast("int"),
            "__local": F.col("__mark").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
        }
    ).drop("__mark")


def _order_index(df: DataFrame, order: Sequence[Column | str], key: list[str], within: Sequence[str] = ()) -> DataFrame:
    """`__key` and `__place`, the row's number from 0 among the rows that agree in `within`, which has to lead the order.

    Keys are structs, in which null equals null.
    """
    group = F.struct(*within) if within else F.struct(F.lit(0))
    placed = _in_ranges(df, order, [F.struct(*key).alias("__key"), group.alias("__group")])
    # One row per range and group that it holds.
    parts = placed.groupBy("__part", "__group").agg(F.count(F.lit(1)).alias("__rows"), F.min("__local").alias("__first"))
    before = W.partitionBy("__group").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("__start", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    numbered = placed.join(parts, ["__part", "__group"]).withColumn("__place", F.col("__start") + F.col("__local") - F.col("__first"))
    once = numbered.groupBy("__key").agg(F.max("__place").alias("__place"), F.count(F.lit(1)).alias("__n"))
    message = F.concat(F.lit(f"several rows have one key ({', '.join(key)}): "), F.col("__key").cast("string"))
    return once.where(F.assert_true(F.col("__n") == 1, message).isNull()).drop("__n")


def _with_place(df: DataFrame, index: DataFrame, key: list[str]) -> DataFrame:
    return df.withColumn("__own", F.struct(*key)).join(index, F.col("__own") == F.col("__key")).drop("__own", "__key")


def with_dense_index(df: DataFrame, *order: Column | str, name: str = "row_index", key: Sequence[str] | None = None) -> DataFrame:
    """Index 0, 1, 2, ... in the given order, which ends in a unique key: `key`, or the columns of the order that are given by name."""
    key = _key_names(order, key)
    return _with_place(df, _order_index(df, order, key), key).withColumnRenamed("__place", name)


def with_position(df: DataFrame, sheet: str, *order: Column | str, first_row: int = 3, name: str = "position", key: Sequence[str] | None = None) -> DataFrame:
    """Row number of each record within its sheet; data starts at `first_row`. The key is unique over all sheets."""
    key = _key_names(order, key)
    placed = _with_place(df, _order_index(df, [F.col(sheet), *order], key, [sheet]), key)
    return placed.select(*df.columns, (F.col("__place") + F.lit(first_row)).alias(name))


def _segments(rows: DataFrame) -> DataFrame:
    """Runs of equal cells within each range: `__run` to `__last` are their rows there, `__head` is the first row of the sheet and
    `__gap` the last empty cell up to the run, as far as they lie in the range."""
    ordered = W.partitionBy("__part").orderBy("__local")
    rows = rows.withColumns({"__before": F.lag("__cell").over(ordered), "__key_before": F.lag("__key").over(ordered)})
    same_sheet = F.col("__before")["sheet"].eqNullSafe(F.col("__cell")["sheet"]) & F.col("__before").isNotNull()
    same_cell = same_sheet & F.col("__before")["value"].eqNullSafe(F.col("__cell")["value"])
    value = F.col("__cell")["value"]
    upto = ordered.rowsBetween(W.unboundedPreceding, 0)
    marks = {"__head": ~same_sheet, "__run": ~same_cell, "__gap": value.isNull() | (value == "")}
    tie = same_sheet & ~same_cell & (F.col("__key_before") == F.col("__key"))
    message = F.concat(F.lit("rows of one key have different values: "), F.col("__key").cast("string"))
    rows = rows.withColumns({name: F.max(F.when(hit, F.col("__local"))).over(upto) for name, hit in marks.items()} | {"__tie": tie})
    rows = rows.where(F.assert_true(~F.col("__tie"), message).isNull())
    return rows.groupBy("__part", "__run").agg(
        F.any_value("__cell").alias("__cell"), F.max("__local").alias("__last"), F.max("__head").alias("__head"), F.max("__gap").alias("__gap")
    )


def _open_segments(segments: DataFrame) -> DataFrame:
    """What each range takes over from those before it: their rows, the run, sheet and empty cell that are open at its beginning.

    A range is summed up by its rows, first and last cell, the run and sheet begun last, and the last empty cell; summaries of
    neighbouring ranges combine to one of the same kind, here by running sums and maxima over one row per range.
    """
    parts = segments.groupBy("__part").agg(
        (F.max("__last") + 1).alias("rows"),
        F.min_by("__cell", "__run").alias("first"),
        F.max_by("__cell", "__run").alias("last"),
        F.max("__run").alias("run"),
        F.max("__head").alias("head"),
        F.max("__gap").alias("gap"),
    )
    ordered = W.orderBy("__part")
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumns({"start": F.coalesce(F.sum("rows").over(earlier), F.lit(0)), "left": F.lag("last").over(ordered)})
    same_sheet = F.col("left").isNotNull() & F.col("left")["sheet"].eqNullSafe(F.col("first")["sheet"])
    parts = parts.withColumns({"same_sheet": same_sheet, "same_run": same_sheet & F.col("left")["value"].eqNullSafe(F.col("first")["value"])})
    begun = {
        "open_run": F.when((F.col("run") > 0) | ~F.col("same_run"), F.col("start") + F.col("run")),
        "open_sheet": F.when((F.col("head") > 0) | ~F.col("same_sheet"), F.col("start") + F.col("head")),
        "open_gap": F.col("start") + F.col("gap"),
    }
    return parts.select("__part", "start", "same_run", "same_sheet", *[F.max(c).over(earlier).alias(name) for name, c in begun.items()])


def value_spans(df: DataFrame, sheet: str, value: str, *order: Column | str, first_row: int = 3, key: Sequence[str] | None = None) -> DataFrame:
    """(sheet, value, first_row, last_row) for each run of equal consecutive values in report order.

    Reading a sheet stops at its first empty value, as for merged report cells. `key` names columns in which no two rows of different
    values agree that stand next to each other; by default those of the order that are given by name.
    """
    key = _key_names(order, key)
    cell = F.struct(F.struct(sheet).alias("sheet"), F.col(value).alias("value"))
    rows = _in_ranges(df, [F.col(sheet), *order], [F.struct(*key).alias("__key"), cell.alias("__cell")])
    segments = _segments(rows)
    # One row per range: bounded by the number of ranges, not by the data.
    joined = segments.join(F.broadcast(_open_segments(segments)), "__part")
    at = lambda column: F.col("start") + F.col(column)
    head = F.when((F.col("__head") == 0) & F.col("same_sheet"), F.col("open_sheet")).otherwise(at("__head"))
    run = F.when((F.col("__run") == 0) & F.col("same_run"), F.col("open_run")).otherwise(at("__run"))
    gap = F.greatest(at("__gap"), F.col("open_gap"))
    read = joined.select("__cell", head.alias("__head"), run.alias("__run"), at("__last").alias("__last"), gap.alias("__gap"))
    read = read.where(F.col("__gap").isNull() | (F.col("__gap") < F.col("__head")))
    return (
        read.groupBy("__run", "__head", "__cell")
        .agg(F.max("__last").alias("__last"))
        .select(
            F.col("__cell")["sheet"][sheet].alias(sheet),
            F.col("__cell")["value"].alias(value),
            (F.col("__run") - F.col("__head") + F.lit(first_row)).alias("first_row"),
            (F.col("__last") - F.col("__head") + F.lit(first_row)).alias("last_row"),
        )
    )
