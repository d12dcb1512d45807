"""Export drops in a landing folder. A drop is a file, or a folder that Spark wrote as one data set."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from rosterlake import fixed_values as fv


def list_drops(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Drops whose name matches the glob ``pattern``: drop, path, modified, files.

    A distributed listing; file contents are pruned and never read.
    """
    root = folder.rstrip("/")
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/{pattern}")
        ).select("path", "modificationTime")
    except AnalysisException as error:
        raise FileNotFoundError(f"no drop matches {pattern!r} in {folder}") from error
    inside = re.sub(r"^[A-Za-z0-9]+:(//[^/]*)?", "", root)
    named = files.withColumn("drop", F.regexp_extract("path", rf"\Q{inside}\E/([^/]+)", 1)).withColumn(
        "drop_path", F.concat(F.lit(root + "/"), "drop")
    )
    return named.groupBy("drop", F.col("drop_path").alias("path")).agg(
        F.max("modificationTime").alias("modified"), F.count(F.lit(1)).alias("files")
    )


def newest_drop(spark: SparkSession, folder: str, pattern: str) -> Row:
    """The most recently modified matching drop; of several, the last by name. Fails if there is none."""
    newest = list_drops(spark, folder, pattern).orderBy(F.desc("modified"), F.desc("drop")).first()
    if newest is None:
        raise FileNotFoundError(f"no drop matches {pattern!r} in {folder}")
    return newest


def feed_date(name: Column, pattern: str = fv.FEED_DATE, spelled: str = "yyyy-MM-dd") -> Column:
    """First date in a drop's name, null if there is none."""
    return F.try_to_date(F.regexp_extract(name, pattern, 0), spelled)


def require_feed_date(name: str) -> date:
    """First date in ``name``; fails if there is none."""
    found = re.search(fv.FEED_DATE, name)
    try:
        return date.fromisoformat(found[0])
    except (TypeError, ValueError):
        raise ValueError(f"no date matching {fv.FEED_DATE!r} in {name!r}") from None
