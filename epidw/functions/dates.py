"""Date parsing, calendar keys and month buckets."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, functions as F

from epidw import domain as d

# year-month-day with one separator throughout, alone or followed by a time of day
_TIME = (
    r"(?:(?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d*)?)?|24:00(?::00)?)"
    r"\s*(?:Z|UTC|[+-]\d{1,2}(?::?\d{2})?)?\s*"
)
_DATE = rf"^\s*(\d{{1,6}}([-/\\ ])\d{{1,2}}\2\d{{1,2}})(?:\s*|[ T]\s*{_TIME})$"


def try_date(text: Column) -> Column:
    """Parse a date; anything that is not a full year-month-day date becomes NULL.

    ISO dates take the plain cast. Other separators, short parts and a trailing
    time go through one regular expression that normalizes them first.
    """
    dashes = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    iso = F.when((F.octet_length(text) == 10) & dashes, text.try_cast("date"))
    found = F.translate(F.regexp_extract(text, _DATE, 1), "/\\ ", "---")
    missing_year_digits = F.greatest(F.lit(0), 5 - F.instr(found, "-"))
    padded = F.concat(F.substring(F.lit("000"), F.lit(1), missing_year_digits), found)
    return F.coalesce(iso, padded.try_cast("date"))


def strict_date(text: Column) -> Column:
    """Parse a date and fail the job on text that is not one (NULL stays NULL)."""
    return F.when(text.isNotNull(), F.coalesce(try_date(text), F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")))


def first_collection_date(*texts: Column) -> Column:
    """Date of the first value that is present.

    The choice falls before parsing: an unparsable first value hides a good second one.
    """
    return try_date(F.coalesce(*texts))


def date_key(date: Column, start: dt.date = d.CALENDAR_START, end: dt.date = d.CALENDAR_END) -> Column:
    """Calendar key ``yyyymmdd`` of a date, -1 for a missing date or one outside the calendar.

    The calendar is dense, so this equals a left join with it, without the join.
    """
    key = F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
    inside = date.between(F.lit(start), F.lit(end))
    return F.when(inside, key).otherwise(F.lit(d.UNKNOWN_KEY)).cast("int")


def month_of_key(key: Column) -> Column:
    """Calendar key -> ``yyyy-MM`` label, or the unknown label."""
    month = F.concat_ws(
        "-",
        F.lpad((key / 10000).cast("int").cast("string"), 4, "0"),
        F.lpad(((key / 100).cast("int") % 100).cast("string"), 2, "0"),
    )
    return F.when(key == d.UNKNOWN_KEY, F.lit(d.UNKNOWN)).otherwise(month)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def month_from_label(label: Column) -> Column:
    """``yyyy-MM`` label -> first day of the month; the unknown label becomes NULL."""
    return F.concat(label, F.lit("-01")).try_cast("date")


def day_gap(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``; NULL if either is missing, negative if reversed."""
    return F.datediff(end, start)


def day_before(date: Column | dt.date) -> Column:
    return F.date_sub(date if isinstance(date, Column) else F.lit(date), 1)


def pick_label(position: Column, labels: tuple[str, ...]) -> Column:
    """Label number ``position`` (from 1)."""
    return F.element_at(F.array(*map(F.lit, labels)), position)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
