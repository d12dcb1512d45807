"""Date expressions. All of them are built-in column expressions and return null for text they cannot read.

Each accepted spelling is a regular expression plus a parse. The expression is tested first because a
failed parse costs an exception per row, which is several times the price of a failed match.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T


class Spelling(NamedTuple):
    shape: str
    parse: Callable[[Column], Column]


_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"

YEAR_FIRST_DASHES = Spelling(rf"^{_DAY}$", lambda c: c.try_cast("date"))
YEAR_FIRST_SLASHES = Spelling(
    r"^\d{4}/\d{1,2}/\d{1,2}$", lambda c: F.translate(c, "/", "-").try_cast("date")
)
# The two above in one: the separators only have to be the same.
YEAR_FIRST = Spelling(
    r"^\d{4}([-/])\d{1,2}\1\d{1,2}$", lambda c: F.translate(c, "/", "-").try_cast("date")
)
MONTH_FIRST_SLASHES = Spelling(r"^\d{1,2}/\d{1,2}/\d{4}$", lambda c: F.try_to_date(c, "M/d/yyyy"))
DAY_AND_CLOCK = Spelling(rf"^{_DAY} {_CLOCK}$", lambda c: c.try_cast("timestamp_ntz").cast("date"))
DAY_AND_CLOCK_FRACTION = Spelling(
    rf"^{_DAY} {_CLOCK}(\.\d+)?$", lambda c: c.try_cast("timestamp_ntz").cast("date")
)
ANY_ISO = Spelling(rf"^\s*{_DAY}([ T].*)?$", lambda c: c.try_cast("timestamp_ntz").cast("date"))

_DAY_AND_CLOCK_ANYWHERE = (
    r"\d{4}-(?:1[0-2]|0?[1-9])-(?:3[01]|[12]\d|0?[1-9]) (?:2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d"
)


def parse_date(col: Column, *spellings: Spelling) -> Column:
    """Date under the first spelling whose shape fits and whose value exists on the calendar."""
    return F.coalesce(*[F.when(col.rlike(s.shape), s.parse(col)) for s in spellings])


def parse_common_date(col: Column, *, lenient: bool = False) -> Column:
    """Dates as ``2025-06-01``, ``2025/06/01`` or ``06/01/2025``; ``lenient`` also takes ISO timestamps."""
    return parse_date(col, YEAR_FIRST, MONTH_FIRST_SLASHES, *([ANY_ISO] if lenient else []))


def parse_report_date(name: str) -> Column:
    """Date column of the hires reports; which spellings are accepted depends on the column."""
    if name == "offer_accepted_date":
        accepted = [YEAR_FIRST_SLASHES]
    elif name in ("job_application_date", "ready_for_hire_date"):
        accepted = [DAY_AND_CLOCK_FRACTION]
    else:
        accepted = [DAY_AND_CLOCK, YEAR_FIRST_DASHES]
    return parse_date(F.col(name).cast("string"), *accepted)


def parse_embedded_date(col: Column) -> Column:
    """Date of the first ``yyyy-MM-dd HH:mm:ss`` found anywhere in the text, else of the text as a whole."""
    found = F.regexp_extract(col, _DAY_AND_CLOCK_ANYWHERE, 0).try_cast("timestamp_ntz").cast("date")
    return F.coalesce(found, parse_date(col, ANY_ISO))


def as_date(df: DataFrame, name: str, *, lenient: bool = True) -> Column:
    """Column as a date whatever its type: date, timestamp or text in a common spelling."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return parse_common_date(F.col(name), lenient=lenient)


def years_back(as_of: date, years: int) -> Column:
    """1 January, ``years`` years before the year of ``as_of``."""
    return F.lit(date(as_of.year - years, 1, 1))


def months_back(as_of: date, months: int) -> Column:
    """First day of the month ``months`` months before the month of ``as_of``."""
    return F.add_months(F.trunc(F.lit(as_of), "month"), -months)


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def month_end(col: Column) -> Column:
    return F.last_day(col)


def year_month(col: Column, *, dash: bool = True) -> Column:
    """``2025-01`` or, without the dash, ``202501``."""
    return F.date_format(col, "yyyy-MM" if dash else "yyyyMM")
