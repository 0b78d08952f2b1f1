"""Date parsing and slicing as Column functions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierhouse.functions.text import _col, ws_trim

# Accepted date formats, in the order they are tried.
DATE_FORMATS = ("y-M-d", "d-M-y", "y/M/d")


def as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def date_from_number(c: Column | str, strict: bool = True) -> Column:
    """A yyyymmdd number as a date.

    0 and anything not eight characters long give NULL. Eight characters that
    are no calendar day fail the job, or give NULL with `strict=False`.
    """
    number = _col(c)
    text = number.cast("string")
    iso = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    # Casting ISO text is several times faster than a format-driven parse.
    day = iso.try_cast("date")
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a yyyymmdd date: "), text)).cast("date")
        day = F.coalesce(day, bad)
    return F.when((number != 0) & (F.length(text) == 8), day)


def date_shape(fmt: str) -> str:
    """Pattern of the text a format of y, M and d can parse (a year is 1 to 9999)."""
    digits = {"y": "(?!0+(?![0-9]))[0-9]{1,4}", "M": "[0-9]{1,2}", "d": "[0-9]{1,2}"}
    return "^" + "".join(digits.get(ch, re.escape(ch)) for ch in fmt) + "$"


def parse_date(c: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First of `formats` that parses the trimmed text, else NULL.

    A failed parse costs an exception inside Spark, many times a good one, so
    a format is only tried on text of its shape.
    """
    text = ws_trim(c)
    return F.coalesce(*[F.when(F.rlike(text, F.lit(date_shape(f))), F.try_to_date(text, f)) for f in formats])


def future_to_null(c: Column | str, as_of: dt.date | str) -> Column:
    """Dates after `as_of` become NULL."""
    day = _col(c)
    return F.when(day <= F.lit(as_date(as_of)), day)


def in_month(c: Column | str, as_of: dt.date | str) -> Column:
    """The month of `as_of`, as a half-open range so that scans can be pruned."""
    first = as_date(as_of).replace(day=1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    day = _col(c)
    return (day >= F.lit(first)) & (day < F.lit(following))


def on_day(c: Column | str, as_of: dt.date | str) -> Column:
    """A timestamp on the day `as_of` (session zone), as a half-open range."""
    start = as_date(as_of)
    ts = _col(c)
    lower = F.lit(start.isoformat()).cast("timestamp")
    upper = F.lit((start + dt.timedelta(days=1)).isoformat()).cast("timestamp")
    return (ts >= lower) & (ts < upper)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))
