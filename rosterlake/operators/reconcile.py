"""Declared counts against counted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def reconcile_counts(
    declared: DataFrame,
    declared_count: str,
    observed: DataFrame,
    key: str,
    *,
    declared_as: str = "declared_count",
    observed_as: str = "observed_count",
    difference_as: str = "discrepancy",
) -> DataFrame:
    """Keys of ``declared`` whose count differs from their number of rows in ``observed``.

    A null count is 0, and so is a key without rows; keys found only in ``observed`` are not listed. Of
    several declared counts per key the largest one holds. Both sides are aggregated before they meet, to
    one row per key, and the join uses the partitioning of the two aggregations.
    """
    counted = observed.groupBy(key).agg(F.count(F.lit(1)).alias(observed_as))
    stated = declared.groupBy(key).agg(
        F.coalesce(F.max(F.col(declared_count)), F.lit(0)).cast("int").alias(declared_as)
    )
    both = stated.join(counted, key, "left").withColumn(observed_as, F.coalesce(observed_as, F.lit(0)))
    return (
        both.withColumn(difference_as, F.abs(F.col(declared_as) - F.col(observed_as)))
        .where(F.col(difference_as) != 0)
        .select(key, declared_as, observed_as, difference_as)
    )
