"""One row per key, distinct flags and duplicate rows.

Every operator here reduces on the map side, so a key that holds a large share of the rows reaches the
shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def keep_one(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = (), *, nulls_win: bool = False
) -> DataFrame:
    """The row of each key with the greatest values in ``prefer``; a null key is a key like any other.

    Equal rows are told apart by the other columns from left to right, so the choice does not depend
    on the order of arrival. It is one ``max`` over a struct, with partial maxima before the single shuffle and
    no window. Spark aggregates structs by sorting, so every task sorts its input by key, in full width, before the
    shuffle and spills what does not fit. A null counts as least, with ``nulls_win`` as greatest.
    """
    keys, prefer = list(keys), list(prefer)
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    rank = [p for c in prefer for p in ([F.col(c).isNull().alias(f"{c}__null")] if nulls_win else []) + [F.col(c)]]
    if not rank and not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.max(F.struct(*rank, *[F.col(c) for c in rest])).alias("__best"))
    return picked.select([F.col(c) if c in keys else F.col("__best").getField(c).alias(c) for c in df.columns])


def distinct_flag(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Each value of ``key`` once (null too) with the constant ``flag`` 1."""
    return df.select(key).distinct().withColumn(flag, F.lit(1).cast("byte"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], copies: str = "copies") -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(copies)).where(F.col(copies) > 1)


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once. Null keys count as equal.

    A semi join with the repeated keys and not a window, which would bring all copies into one task; adaptive
    execution splits a key with many rows.
    """
    repeated = duplicate_keys(df, keys).drop("copies").alias("b")
    same = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
    return df.alias("a").join(repeated, same, "left_semi")
