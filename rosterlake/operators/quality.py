"""Data-quality reports: one row (check, column, violations) per check, one pass per table.

All checks of a table are counters of one aggregation, so the table is scanned once and only one row of
counters per task is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.operators.dedupe import duplicate_keys

Checks = Mapping[tuple[str, str], Column]


def not_null(columns: Sequence[str], among: Sequence[str] | None = None) -> Checks:
    """Nulls in ``columns``; with ``among``, the columns a table has, those it lacks are passed over."""
    return {("not_null", c): F.col(c).isNull() for c in columns if among is None or c in among}


def in_domain(domains: Mapping[str, Sequence]) -> Checks:
    """Values outside the listed ones. Null is not a violation."""
    return {("in_domain", c): ~F.col(c).isin(*values) for c, values in domains.items()}


def in_range(column: str, low=None, high=None) -> Checks:
    outside = [F.col(column) < low] if low is not None else []
    outside += [F.col(column) > high] if high is not None else []
    return {("in_range", column): outside[0] if len(outside) == 1 else outside[0] | outside[1]}


def not_after(column: str, as_of: date) -> Checks:
    return {("not_after", column): F.col(column) > F.lit(as_of)}


def matches(column: str, pattern: str) -> Checks:
    return {("matches", column): ~F.col(column).rlike(pattern)}


def implies(name: str, column: str, given: Column, then: Column) -> Checks:
    """Rows for which ``given`` holds and ``then`` does not."""
    return {(name, column): given & ~then}


def violations(df: DataFrame, checks: Checks) -> DataFrame:
    """The checks' violation counts. A check whose outcome is null is not violated."""
    names = [f"c{i}" for i in range(len(checks))]
    return report_rows(df.agg(*(F.count_if(test).alias(c) for c, test in zip(names, checks.values(), strict=True))), checks, names)


def report_rows(counters: DataFrame, checks: Iterable[tuple[str, str]], names: Sequence[str]) -> DataFrame:
    """One row of counters in the columns ``names`` as one row per check."""
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(name).alias("violations"))
        for (check, column), name in zip(checks, names, strict=True)
    ]
    return counters.select(F.inline(F.array(*rows)))


def duplicate_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows whose key is not theirs alone; aggregated twice, rows never meet in a group."""
    repeated = duplicate_keys(df, keys).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("violations"))
    return repeated.select(F.lit("unique").alias("check"), F.lit(", ".join(keys)).alias("column"), "violations")
