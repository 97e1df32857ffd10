"""Equal-depth ranges of a split column: parts of a table with about as many rows each, whatever the values are.

Ranges of equal width, as a JDBC read makes them from two bounds, leave most rows to a few tasks when values are dense in places. Here one
aggregate sums up the column in quantiles, and neighbouring quantiles become a range. A value that is several quantiles at once is hot: it gets a
part of its own, or several by a second column. Nulls get a part as well. The predicates take each row exactly once, also rows that came after
the summary, so it may be taken from an older copy of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPLITTABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
#: Precision of quantiles against the number of parts: a range has its share of rows within 1 / `_PRECISION` of it.
_PRECISION = 100


class Depths(NamedTuple):
    """Quantiles of a column in order, its rows and nulls."""

    column: str
    quantiles: tuple
    rows: int
    nulls: int


def depths(df: DataFrame, column: str, parts: int) -> Depths:
    """Sum up a column in one aggregate; its quantile sketches are merged, and `parts` values reach the driver."""
    if not isinstance(df.schema[column].dataType, _SPLITTABLE):
        raise TypeError(f"{column} is no number, date or time")
    steps = [i / parts for i in range(1, parts)]
    value = F.col(column)
    found = df.agg(
        F.percentile_approx(value, F.array(*map(F.lit, steps)), _PRECISION * parts).alias("q") if steps else F.array().alias("q"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("nulls"),
    ).first()
    return Depths(column, tuple(found.q or ()), found.rows, found.nulls)


def _literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return repr(value) if isinstance(value, float) else str(value)
    raise TypeError(f"no range can end at {value!r}")


def hot_values(summary: Depths) -> list:
    """Values that are two quantiles or more: each holds at least about one part's rows."""
    return [a for i, a in enumerate(summary.quantiles) if summary.quantiles.count(a) > 1 and summary.quantiles.index(a) == i]


def range_predicates(summary: Depths) -> list[str]:
    """Conditions that share out all rows: ranges between quantiles, hot values for themselves, nulls."""
    column, hot = summary.column, set(hot_values(summary))
    points = sorted(set(summary.quantiles))
    out = []
    low = None
    for point in points:
        low_part = "" if low is None else f"{column} {low[0]} {_literal(low[1])} AND "
        out.append(f"{low_part}{column} < {_literal(point)}")
        if point in hot:
            out.append(f"{column} = {_literal(point)}")
        low = (">", point) if point in hot else (">=", point)
    out.append(f"{column} {low[0]} {_literal(low[1])}" if low else f"{column} IS NOT NULL")
    return [*out, f"{column} IS NULL"]


def equal_depth_predicates(df: DataFrame, column: str, parts: int, second: str | None = None) -> list[str]:
    """`range_predicates` for about `parts` parts. With a `second` column, hot values and nulls are cut further by it.

    There is one job for the column and one for each hot value, of which there are at most half as many as parts.
    """
    summary = depths(df, column, parts)
    out = range_predicates(summary)
    if second is None:
        return out
    heavy = {f"{column} = {_literal(v)}": F.col(column) == F.lit(v) for v in hot_values(summary)}
    if summary.rows and summary.nulls * parts > summary.rows:
        heavy[f"{column} IS NULL"] = F.col(column).isNull()
    cut: list[str] = []
    for predicate in out:
        if predicate not in heavy:
            cut.append(predicate)
            continue
        own = df.where(heavy[predicate])
        share = max(2, -(-own.count() * parts // max(1, summary.rows)))
        cut += [f"{predicate} AND ({inner})" for inner in range_predicates(depths(own, second, share))]
    return cut


def union_of(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """A frame read part by part, as a database would be."""
    out = df.where(predicates[0])
    for predicate in predicates[1:]:
        out = out.union(df.where(predicate))
    return out
