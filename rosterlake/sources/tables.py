"""Parquet tables and staging."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake.operators.shape import select_present


#: Stands for a quoted empty field while CSV is read; Spark would make it null.
EMPTY = "\x01empty\x01"


def empty_text(column: str) -> Column:
    return F.when(F.col(column) == EMPTY, "").otherwise(F.col(column)).alias(column)


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Those of ``columns`` that the table has, for the rows that pass ``where``; both reach the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df if columns is None else select_present(df, columns)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` or ``setCheckpointDir`` names; an error without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/rosterlake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to scratch and read back: computed once, of known size, and safe against lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
