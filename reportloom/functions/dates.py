"""Calendar expressions. Every function takes an explicit `as_of` day instead of the wall clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _day(as_of: date | datetime) -> date:
    return as_of.date() if isinstance(as_of, datetime) else as_of


def month_start(day: date, back: int = 0) -> date:
    months = day.year * 12 + day.month - 1 - back
    return date(months // 12, months % 12 + 1, 1)


def yesterday(as_of: date | datetime) -> date:
    return _day(as_of) - timedelta(days=1)


def in_last_days(c: Column, as_of: date | datetime, days: int = 14) -> Column:
    """The `days` full days before `as_of`, as a half-open range that reaches the scan."""
    end = _day(as_of)
    return (c >= F.lit(end - timedelta(days=days))) & (c < F.lit(end))


def in_last_days_int(c: Column, as_of: date | datetime, days: int = 14) -> Column:
    """`in_last_days` for integer `yyyyMMdd` dates."""
    end = _day(as_of)
    return (c >= F.lit(int(f"{end - timedelta(days=days):%Y%m%d}"))) & (c < F.lit(int(f"{end:%Y%m%d}")))


def in_last_days_text(c: Column, as_of: date | datetime, days: int = 14) -> Column:
    """`in_last_days` for `yyyy-MM-dd` text, whose text order is its date order."""
    end = _day(as_of)
    return (c >= F.lit(str(end - timedelta(days=days)))) & (c < F.lit(str(end)))


def in_month(c: Column, as_of: date | datetime, back: int = 0, months: int = 1) -> Column:
    """Calendar month of `as_of`, or `months` of them from `back` months earlier, as a range so that it prunes."""
    day = _day(as_of)
    return (c >= F.lit(month_start(day, back))) & (c < F.lit(month_start(day, back - months)))


def month_to_yesterday(c: Column, as_of: date | datetime, inclusive_day: bool = False) -> Column:
    """From the first of yesterday's month up to yesterday 23:59:59.

    The last second of yesterday is left out as in the report definition; `inclusive_day` takes it in.
    """
    last = yesterday(as_of)
    end = datetime.combine(last, datetime.min.time()) + (
        timedelta(days=1) if inclusive_day else timedelta(hours=23, minutes=59, seconds=59)
    )
    return (c >= F.lit(month_start(last))) & (c < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))


def before_day(c: Column, as_of: date | datetime) -> Column:
    return c < F.lit(_day(as_of))


def int_date(c: Column) -> Column:
    """A date as the integer yyyyMMdd."""
    d = c.cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def text_date_to_int(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit("")).cast("int")


def day_label(c: Column) -> Column:
    return F.concat(F.month(c).cast("string"), F.lit("月"), F.dayofmonth(c).cast("string"), F.lit("号"))


def weekend_style(c: Column) -> Column:
    """Style code of a header day: Saturday G, Sunday E, otherwise none."""
    weekday = F.weekday(c)
    return F.when(weekday == 5, "BG:G").when(weekday == 6, "BG:E")


def week_start(c: Column) -> Column:
    """Saturday on or before the day: business weeks run from Saturday to Friday."""
    return F.next_day(F.date_sub(c, 7), "SAT")


def week_end(c: Column) -> Column:
    return F.date_add(week_start(c), 6)


def week_text(c: Column) -> Column:
    """Both ends of the business week as sixteen digits."""
    return F.concat(F.date_format(week_start(c), "yyyyMMdd"), F.date_format(week_end(c), "yyyyMMdd"))


def month_texts(as_of: date | datetime, legacy: bool = False) -> tuple[str, str]:
    """This and the previous month as yyyy-MM; `legacy` takes the month of `as_of` minus 30 days."""
    day = _day(as_of)
    previous = day - timedelta(days=30) if legacy else month_start(day, 1)
    return f"{day:%Y-%m}", f"{previous:%Y-%m}"


def whole_days_left(validity: Column, entry: Column, now: datetime) -> Column:
    """Validity minus the number of complete 24-hour spans since entry; negative once expired."""
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    elapsed = F.unix_micros(moment.cast("timestamp")) - F.unix_micros(entry.cast("timestamp"))
    return (validity - F.floor(elapsed / F.lit(MICROS_PER_DAY))).cast("int")


def report_header(now: datetime, sheet_name: str, fixed_time: str | None = None) -> dict[str, Column]:
    """Header values of a report; `fixed_time` replaces the time part of `data_time`."""
    last = yesterday(now)
    stamp = f"{now:%Y-%m-%d} {fixed_time or f'{now:%H:%M:%S}'}"
    return {
        "data_time": F.lit(stamp),
        "report_date": F.lit(str(last)),
        "report_year": F.lit(last.year),
        "report_month": F.lit(last.month),
        "sheet_name": F.lit(sheet_name),
    }
