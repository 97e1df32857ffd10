"""Queries over the generated tables, each with the SQL it must agree with."""

from reportloom.queries import calendars, columns, filters, joins, ordering, projections, reports, reshaping, rollups, tables_in_out  # noqa: F401
from reportloom.queries.registry import ORACLE, QUERIES  # noqa: F401
