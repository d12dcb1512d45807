"""Composite keys and code tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def composite_id(*parts: Column | str) -> Column:
    """Parts joined by ``_``. A null part makes the whole id null, so it never matches in a join."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    pieces = reduce(add, [[F.lit("_"), c.cast("string")] for c in columns])
    return F.concat(*pieces[1:])


def recode(col: Column, codes: Mapping) -> Column:
    """Value of ``codes`` for each entry; null where it is not listed."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.create_map(*pairs)[col]
