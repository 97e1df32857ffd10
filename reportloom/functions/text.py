"""Text and display expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_BREAK = "\r\n"


def decode(c: Column, labels: Mapping[str, str]) -> Column:
    """Replace known codes by labels; unknown codes pass through."""
    out = None
    for code, label in labels.items():
        out = F.when(c == code, label) if out is None else out.when(c == code, label)
    return c if out is None else out.otherwise(c)


def display(c: Column, filler: str = "--") -> Column:
    return F.coalesce(c.cast("string"), F.lit(filler))


def first_known(*columns: Column) -> Column:
    return F.coalesce(*columns)


def day_prefix(c: Column) -> Column:
    """The first ten characters, which hold the day of a timestamp text."""
    return F.substring(c.cast("string"), 1, 10)


def without_quotes(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit(""))


def contact_lines(phone: Column, mail: Column) -> Column:
    """Both contacts on two lines, the known one alone, or null. An empty text counts as known."""
    both = F.concat(phone, F.lit(LINE_BREAK), mail)
    return F.coalesce(both, phone, mail)


def week_digits(c: Column) -> Column:
    """Drop brackets, quotes and hyphens, then turn `, ` into `-`."""
    return F.replace(F.regexp_replace(c, r"[()'\-]", ""), F.lit(", "), F.lit("-"))


def sheet_title(moment: Column, kind: str, form_id: Column) -> Column:
    """Sheet name of one form: day, kind and id; null if a part is null."""
    return F.concat(day_prefix(moment), F.lit(kind), F.lit(" "), form_id.cast("string"))


def workbook_link(book: str, title: Column, caption: str = "查看报告") -> Column:
    return F.concat(F.lit(f"=HYPERLINK(\"[{book}]'"), title, F.lit(f"'!A1\",\"{caption}\")"))


def style_code(c: Column) -> Column:
    """The `[[...]]` mark inside a cell text, from the first `[[` to the last `]]` of a line; null if none."""
    return F.nullif(F.regexp_extract(c, r"\[\[[^\n]*\]\]", 0), F.lit(""))


def without_style(c: Column) -> Column:
    return F.coalesce(F.replace(c, style_code(c), F.lit("")), c)


def expiry_style(days: Column) -> Column:
    return F.when(days < 0, "BG:H").otherwise("BG:I")


def with_style(style: Column, c: Column) -> Column:
    return F.concat(F.lit("[["), style, F.lit("]]"), c.cast("string"))


def none_to_dashes(c: Column) -> Column:
    return F.when(c == "None", "--").otherwise(c)


def row_height(c: Column) -> Column:
    """Twenty points for each line of the text."""
    return 20 * (1 + F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))))
