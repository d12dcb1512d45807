"""Text expressions. ``(?U)`` makes digit and space classes cover all of Unicode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip(col: Column) -> Column:
    """Text without white space of any kind at either end (``trim`` takes off spaces only)."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def first_step(col: Column) -> Column:
    """``Hire`` from ``Hire > External``."""
    return F.substring_index(col, " > ", 1)


def name_without_id(col: Column) -> Column:
    """``Ana Lund`` from ``Ana Lund (731)``."""
    return strip(F.substring_index(col, "(", 1))


def bracketed_number(col: Column) -> Column:
    """``8140`` from ``Q8 (8140)``; null where no number stands in brackets."""
    return F.nullif(F.regexp_extract(col, r"(?U)\((\d+)\)", 1), F.lit(""))


def digits_or(col: Column, sentinel: str) -> Column:
    """All digits of the text run together; ``sentinel`` where there are none, null where text is null."""
    digits = F.regexp_replace(col, r"(?U)\D+", "")
    return F.when(digits == "", F.lit(sentinel)).otherwise(digits)


def says(col: Column, phrase: str) -> Column:
    """Whether the text is ``phrase`` up to case and outer white space; null for null."""
    return F.lower(strip(col)) == phrase
