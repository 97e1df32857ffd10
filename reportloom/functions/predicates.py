"""Predicates whose treatment of nulls matters."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs_or_null(c: Column, value) -> Column:
    """Inequality that keeps null rows."""
    return ~c.eqNullSafe(F.lit(value))


def text_contains(c: Column, part: str) -> Column:
    """Substring test in which null counts as no match."""
    return F.coalesce(c.contains(F.lit(part)), F.lit(False))


def lot_open(status: Column, strict_status: bool = False) -> Column:
    """Lot status test. The report keeps every lot; `strict_status` drops statuses 0 and 2."""
    if not strict_status:
        return F.lit(True)
    return status.isNull() | ~status.isin(0, 2)


def all_equal(filters: Mapping[str, object]) -> Column:
    """Conjunction of `column = value`, true for an empty mapping."""
    return reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in filters.items()], F.lit(True))
