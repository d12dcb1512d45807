"""Flag columns looked up by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterlake.operators.joins import keyed_join


def flag_from(df: DataFrame, flags: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` with the byte ``flag`` of its key, 0 where there is none. ``flags`` has each key once."""
    joined = keyed_join(df, flags.select(key, flag), [key], "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(0)).cast("byte"))
