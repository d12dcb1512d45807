"""Table sinks: parquet, CSV and dated snapshots; versioned tables are in ``versions``."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rosterlake.sinks.versions import (  # noqa: F401
    COMPRESSION,
    Conflict,
    Version,
    current_version,
    read_current,
    read_version,
    remove_unnamed,
    replace_table,
    share_version,
    version_of,
)
from rosterlake.sources.tables import EMPTY, empty_text


def write_table(df: DataFrame, path: str, *, compression: str = COMPRESSION) -> None:
    """Replace the parquet table at ``path``. Not for a table that ``df`` reads; see ``replace_table``."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


#: Text comes back as it was: quotes are doubled, blanks at the ends stay, a quoted line break is part of its field, null is
#: nothing and the empty text a pair of quotes.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table that ``write_csv`` wrote; a row that does not fit ``schema`` fails the job."""
    read = spark.read.schema(schema).options(**CSV, emptyValue=EMPTY, multiLine=True, mode="FAILFAST").csv(path)
    return read.select([empty_text(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in read.schema])


def write_refresh_date(spark: SparkSession, refreshed: date, path: str) -> None:
    """One-row CSV with the date of the feed."""
    write_csv(spark.range(1).select(F.lit(refreshed).alias("refresh_date")), path)


# --- snapshots ---------------------------------------------------------------------------------------


def snapshot_table(df: DataFrame, path: str, as_of: date) -> None:
    """Keep ``df`` as the snapshot of ``as_of``. A rerun replaces that day and leaves the others alone."""
    (
        df.withColumn("snapshot_date", F.lit(as_of))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def read_snapshot(spark: SparkSession, path: str, as_of: date) -> DataFrame:
    """The snapshot of one day as it was written; other days are neither listed nor asked for their schema."""
    return spark.read.parquet(f"{path}/snapshot_date={as_of.isoformat()}")


def snapshot_tables(tables: Mapping[str, DataFrame], folder: str, as_of: date) -> None:
    for name, df in tables.items():
        snapshot_table(df, f"{folder}/{name}", as_of)


# --- snapshots of versioned tables -------------------------------------------------------------------
#
# A snapshot names the version that each table had; nothing is copied.


def name_versions(
    spark: SparkSession, tables: Mapping[str, str], folder: str, as_of: date, numbers: Mapping[str, int] | None = None
) -> None:
    """Keep versions of ``tables`` (name -> path), the current ones if no ``numbers`` are given, as the snapshot of ``as_of``; a rerun
    replaces that day."""
    chosen = numbers or {name: current_version(spark, path).number for name, path in tables.items()}
    rows = [(name, path, chosen[name]) for name, path in tables.items()]
    snapshot_table(spark.createDataFrame(rows, "table string, path string, version long").coalesce(1), folder, as_of)


def read_named(spark: SparkSession, folder: str, as_of: date, name: str) -> DataFrame:
    """A table as the snapshot of ``as_of`` names it."""
    found = read_snapshot(spark, folder, as_of).where(F.col("table") == name).first()
    if found is None:
        raise FileNotFoundError(f"no {name} in the snapshot of {as_of}")
    return read_version(spark, found["path"], version_of(spark, found["path"], found["version"]))


def named_paths(spark: SparkSession, snapshots: str) -> set[str]:
    """All data that the snapshots under a folder name."""
    rows = spark.read.parquet(snapshots).select("path", "version").distinct().collect()
    return {p for r in rows for p in version_of(spark, r["path"], r["version"]).paths}


def vacuum(spark: SparkSession, path: str, snapshots: str | None = None) -> list[str]:
    """Remove the data of a table that neither its current version nor a snapshot under ``snapshots`` names; what was removed."""
    current = current_version(spark, path)
    if current is None:
        raise FileNotFoundError(f"no version of table {path}")
    return remove_unnamed(spark, path, {*current.paths, *(named_paths(spark, snapshots) if snapshots else ())})
