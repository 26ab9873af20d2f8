"""Guarded date parsing and calendar keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted source formats. Each one has the shape a text must
# have and the Spark pattern that parses it (None: plain cast).
ISO_DATE = "YYYY-MM-DD"
ISO_TIMESTAMP = "YYYY-MM-DD HH24:MI:SS"
_SLASHED = "^[0-9]{2}/[0-9]{2}/[0-9]{4}$"
_STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?$"
DATE_FORMATS = {
    ISO_DATE: ("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "date"),
    "DD/MM/YYYY": (_SLASHED, "dd/MM/yyyy"),
    "MM/DD/YYYY": (_SLASHED, "MM/dd/yyyy"),
    "DD-MM-YYYY": ("^[0-9]{2}-[0-9]{2}-[0-9]{4}$", "dd-MM-yyyy"),
    ISO_TIMESTAMP: (_STAMP, "timestamp_ntz"),
    ISO_TIMESTAMP + ".FFF": (_STAMP, "timestamp_ntz"),
}


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The given day as a literal; today when none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def guarded_date(c: Column, date_format: str = ISO_DATE, as_of: dt.date | str | None = None) -> Column:
    """Date parsed under ``date_format``, no later than ``as_of``.

    Text of another shape and impossible days give NULL. A format that is not
    in ``DATE_FORMATS`` is taken as a Spark datetime pattern without a shape check.
    """
    text = F.trim(c)
    shape, parser = DATE_FORMATS.get(date_format, ("^.+$", date_format))
    if parser in ("date", "timestamp_ntz"):
        parsed = text.try_cast(parser).cast("date")
    else:
        parsed = F.try_to_timestamp(text, F.lit(parser)).cast("date")
    return F.when(text.rlike(shape) & parsed.isNotNull(), F.least(parsed, as_of_date(as_of)))


def date_key(c: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic instead of text formatting."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def month_key(c: Column) -> Column:
    """yyyyMM as an integer."""
    return F.year(c) * 100 + F.month(c)


def week_start(c: Column) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(c, "week")
