"""One row per stage passed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F


def expand_stages(
    df: DataFrame,
    last: Column,
    unfinished: Column,
    stages: Mapping[str, int],
    *,
    number_as: str = "stage_number",
    label_as: str = "stage",
) -> DataFrame:
    """Each row once per stage up to ``last``, or before it where ``unfinished``; null counts as finished.

    ``stages`` is a literal of a handful of entries in ascending order. The passed ones are its head, so the
    row's list is a slice of the literal, and the labels ride along: no Python, no lookup join, no
    shuffle. Rows without a passed stage, or without a last stage, drop out in the explode.
    """
    listed = F.array(
        *[
            F.struct(F.lit(n).cast("short").alias(number_as), F.lit(label).alias(label_as))
            for label, n in stages.items()
        ]
    )
    bound = last.cast("int") - F.coalesce(unfinished, F.lit(False)).cast("int")
    count = reduce(add, [(F.lit(n) <= F.col("__bound")).cast("int") for n in stages.values()])
    return (
        df.withColumn("__bound", bound)
        .withColumn("__passed", F.explode(F.slice(listed, F.lit(1), count)))
        .select(*df.columns, f"__passed.{number_as}", f"__passed.{label_as}")
    )
