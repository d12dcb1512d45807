"""What several operators need of tables: staging, order with running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.sources.tables import stage

__all__ = ["free", "in_order", "stage", "swept"]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def swept(df: DataFrame, label: str) -> DataFrame:
    """``df`` staged; the shuffle files of that go at once and not when the driver next collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return stage(df, label)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def free(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``df`` has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def in_order(df: DataFrame, by: list[Column], label: str, size: Column | None = None) -> DataFrame:
    """``df`` staged in the order of ``by``, with ``_part`` and ``_place`` (from 0) and, for a ``size``, ``_before``: the
    sum of the sizes of all earlier rows.

    Rows are dealt to sorted ranges; only one sum and count per range meets in one place, so no task sees more than its
    range.
    """
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = df.repartitionByRange(int(n), *by).sortWithinPartitions(*by)
    size = F.lit(0) if size is None else size
    staged = stage(
        ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_in"), size.cast("long").alias("_size")),
        label,
    )
    # One row per range, as many as there are shuffle partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        staged.groupBy("_part")
        .agg(F.count("*").alias("_rows"), F.sum("_size").alias("_sum"))
        .select("_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_rows", "_sum")))
    )
    within = Window.partitionBy("_part").orderBy("_in")
    return (
        staged.join(F.broadcast(parts), "_part")
        .withColumn("_place", F.row_number().over(within) - 1 + F.col("_rows_before"))
        .withColumn("_before", F.sum("_size").over(within) - F.col("_size") + F.col("_sum_before"))
        .drop("_rows_before", "_sum_before", "_in", "_size")
    )
