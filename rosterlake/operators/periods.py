"""Month-end snapshot series."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from rosterlake.functions.dates import as_date, month_end


def last_of_month(day: date) -> date:
    return day.replace(day=monthrange(day.year, day.month)[1])


def extend_latest_period(df: DataFrame, period: str, as_of: date) -> DataFrame:
    """Carry the latest period over to the month-end of ``as_of`` where that month-end is absent.

    Nothing is added when the month-end is present, when the latest period is later, or when the table is
    empty; months in between stay absent. The latest period is a scalar subquery over one column, which
    Spark also pushes into file scans; the copies come from an explode, so the rows are read once.
    """
    df = df.withColumn(period, as_date(df, period))
    target = month_end(F.lit(as_of))
    latest = F.max(period)
    present = F.coalesce(F.bool_or(F.col(period) == target), F.lit(False))
    carried = df.select(F.when(~present & (latest <= target), latest).alias("carried")).scalar()
    own = F.col(period)
    periods = F.when(own == carried, F.array(own, target)).otherwise(F.array(own))
    return df.withColumn("__period", F.explode(periods)).select(
        [F.col("__period").alias(period) if c == period else F.col(c) for c in df.columns]
    )


def sort_by_period(df: DataFrame, period: str, within: Sequence[str]) -> DataFrame:
    """Rows in order of period. The columns in ``within`` break the period up, since a range shuffle
    cannot split rows that sort as equal and a month would otherwise be one task."""
    return df.orderBy(period, *within)
