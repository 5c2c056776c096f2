"""Date and time expressions. Every rule takes an explicit ``as_of``; nothing reads the clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Named date formats and the pattern each one stands for.
DATE_PATTERNS = {
    "D": "EEEE, MMMM d, yyyy",
    "t": "h:mm a",
    "ddd MM/dd": "EEE MM/dd",
    "yyyy-MM-dd HH:mm:ss.fff": "yyyy-MM-dd HH:mm:ss.SSS",
}


def day(value: date | datetime | str) -> Column:
    return F.lit(str(value)[:10]).cast("date")


def moment(value: date | datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def days_between(a: Column | str, b: Column | str) -> Column:
    return F.date_diff(col(b), col(a))


def _boundaries(unit: str, a: Column | str, b: Column | str) -> Column:
    seconds = {"minute": 60, "hour": 3600}[unit]

    def whole(c: Column) -> Column:
        c = F.date_trunc(unit, col(c)).cast("timestamp_ntz")
        day_number = F.date_diff(c.cast("date"), F.lit("1900-01-01").cast("date")).cast("long")
        in_day = F.hour(c) * 3600 + F.minute(c) * 60
        return (day_number * 86400 + in_day) / seconds

    return (whole(b) - whole(a)).cast("long")


def minutes_between(a: Column | str, b: Column | str) -> Column:
    """Minute boundaries crossed from ``a`` to ``b``."""
    return _boundaries("minute", a, b)


def hours_between(a: Column | str, b: Column | str) -> Column:
    """Hour boundaries crossed from ``a`` to ``b``."""
    return _boundaries("hour", a, b)


def on_date(date_col: Column | str, time_col: Column | str) -> Column:
    """Moment on ``date_col`` at the time of day carried by ``time_col``."""
    d, t = col(date_col).cast("date"), col(time_col).cast("timestamp_ntz")
    return F.make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d), F.hour(t), F.minute(t), F.second(t).cast("decimal(8,6)")
    )


def format_date(c: Column | str, name: str) -> Column:
    return F.date_format(col(c), DATE_PATTERNS.get(name, name))


def week_number(start: Column | str, as_of: Column) -> Column:
    """Week of a term: whole weeks since its start, plus one (truncated toward zero)."""
    return (F.date_diff(as_of, col(start)) / 7).cast("int") + 1


def same_month_and_day(c: Column | str, as_of: date) -> Column:
    return (F.month(col(c)) == as_of.month) & (F.dayofmonth(col(c)) == as_of.day)


def duration_text(start: Column | str, end: Column | str) -> Column:
    """Three blanks, then hours and minutes right-aligned in two characters each; blank when zero."""
    minutes, hours = minutes_between(start, end), hours_between(start, end)
    whole_hours = F.floor(minutes / 60).cast("string")
    rest = (minutes % 60).cast("string")
    return F.concat(
        F.lit("   "),
        F.when(hours > 0, F.lpad(whole_hours, 2, " ")).otherwise("  "),
        F.when(minutes > 0, F.lpad(rest, 2, " ")).otherwise("  "),
    )


def stamp_key(prefix: Column | str, at: datetime) -> Column:
    """Prefix followed by the unpadded date and time parts of ``at``."""
    parts = (at.year, at.month, at.day, at.hour, at.minute, at.microsecond // 1000)
    return F.concat(col(prefix), F.lit("".join(str(p) for p in parts)))


def is_weekday(as_of: date, iso_weekday: int) -> bool:
    return as_of.isoweekday() == iso_weekday
