"""Digests of rows and of groups of rows, to tell what has changed between two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def row_digests(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's flat columns in their order. Hashes pass over null, so which columns are null is hashed beside
    them: a value that has moved to the next column is a change."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = [c.isNull() for c in columns]
    return tuple(F.xxhash64(F.lit(salt), *nulls, *columns) for salt in (1, 2))


def table_digests(df: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Per group ``digest``: the number of its rows and the sums of both hashes, whatever their order. Repeated rows count as often as
    they are there. Sums are formed before the shuffle."""
    first, second = (h.cast("decimal(20,0)") for h in row_digests(df))
    return df.groupBy(*by).agg(F.concat_ws(":", F.count(F.lit(1)), F.sum(first), F.sum(second)).alias("digest"))
