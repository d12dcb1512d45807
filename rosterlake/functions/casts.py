"""Lenient casts: a value that does not fit becomes null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from rosterlake.functions.dates import YEAR_FIRST, parse_date

_WHOLE_NUMBER = r"^[+-]?\d+$"


def lenient_cast(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """``col`` of type ``source`` as ``target``, null where that fails.

    Text is tested before it is read as a whole number: a failed numeric cast raises and catches an exception
    per row, some thirty times the price of the test. Text is a date only as a whole: year, month and day, with dashes
    or slashes between. A cast would also take a bare year, a serial number for a year, or a date with text after it.
    """
    if source == target:
        return col
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        return F.when(col.rlike(_WHOLE_NUMBER), col.try_cast(target))
    if isinstance(source, T.StringType) and isinstance(target, T.DateType):
        return parse_date(col, YEAR_FIRST)
    return col.try_cast(target)
