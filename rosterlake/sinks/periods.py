"""Versioned tables in one folder per period.

The paths of such a version are folders ``of_period=2025-01-31``, so that its periods are known without reading anything, and one is
read without the others. The period also stays a column of the files: the folders of a version come from several writes, of
which Spark could not find the value by itself.

A version notes a digest of each period's rows, or of the rows that they are made from. The next version writes the periods with
another digest only and names the folders of the others again. A version also notes the schema and the library's version; with
another one all periods are written.

Rows without a period have a folder of their own. An empty table is one folder without rows.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rosterlake import __version__
from rosterlake.operators.digests import table_digests
from rosterlake.operators.periods import last_of_month
from rosterlake.sinks import versions
from rosterlake.sinks.versions import Version

FOLDER = "of_period"
#: Spark's name of the folder for null.
_NULL = "__HIVE_DEFAULT_PARTITION__"


def period_of(path: str) -> str | None:
    """The period of a folder of a version, ``""`` for rows without one; None for the folder of an empty table."""
    found = re.search(rf"/{FOLDER}=([^/]+)$", path)
    return None if found is None else found[1].replace(_NULL, "")


def periods_of(version: Version) -> list[date]:
    """The periods of a version in order, from its paths."""
    return sorted(date.fromisoformat(p) for p in map(period_of, version.paths) if p)


def read_periods(spark: SparkSession, path: str, version: Version, periods: Collection[date]) -> DataFrame:
    """The rows of some periods, at least one; the files of others are not listed."""
    wanted = {p.isoformat() for p in periods}
    return versions.read_version(spark, path, version._replace(paths=tuple(p for p in version.paths if period_of(p) in wanted)))


def digests(df: DataFrame, period: Column | str) -> dict[str, str]:
    """Period (``""`` for null) -> digest of its rows; the driver gets one row per period."""
    found = table_digests(df, [_column(period).cast("string").alias(FOLDER)]).collect()
    return {r[FOLDER] or "": r["digest"] for r in found}


def _column(period: Column | str) -> Column:
    return F.col(period) if isinstance(period, str) else period


def _write(df: DataFrame, path: str, base: Version | None, within: Sequence[str], gather: bool) -> dict[str, str]:
    """``df`` in folders by its column ``FOLDER``; period -> folder."""
    dealt = df.hint("rebalance", F.col(FOLDER)) if gather else df
    # Without ``within`` Spark's writer sorts by folder itself, unless it may keep a file open for each, see ``session.small_tasks``.
    ordered = dealt.sortWithinPartitions(FOLDER, *within) if within else dealt
    folder = versions.write_data(ordered, path, base, by=[FOLDER])
    written = [f"{folder}/{n}" for n in versions.names_in(df.sparkSession, f"{path.rstrip('/').rpartition('/')[0]}/{folder}") if "=" in n]
    return {period_of(p): p for p in written}


def replace_periods(
    df: DataFrame, path: str, period: Column | str, *, known: Mapping[str, str] | None = None, within: Sequence[str] = (), gather: bool = True,
    notes: Mapping[str, Any] | None = None,
) -> Version:
    """Make ``df`` the next version of the table, in which periods whose rows are the same keep their files.

    ``period`` is a date, of the rows of ``df``. ``known`` are the digests of what ``df`` is made from, by the same periods, if a period of
    ``df`` comes from that period alone: then of ``df`` only periods with another digest are computed. Without it ``df`` is computed once
    for the digests and again for the periods to write, and the first version once. ``gather`` brings the rows of a period
    together in files of an even size: adaptive execution puts small periods into one task and splits large ones. That is a
    shuffle of what is written, and not needed where the rows come from a table by the same periods. ``within`` sorts a file.
    """
    if df.select(_column(period)).schema[0].dataType != T.DateType() or FOLDER in df.columns:
        raise ValueError(f"{period} has to be a date, and no column may be called {FOLDER}")
    spark, made_by = df.sparkSession, {"schema": df.schema.simpleString(), "library": __version__}
    base = versions.current_version(spark, path)
    same = base is not None and "digests" in base.notes and all(base.notes.get(k) == v for k, v in made_by.items())
    before = base.notes["digests"] if same else {}
    now = known if known is not None else digests(df, period) if before else None
    unchanged = {p for p, digest in now.items() if before.get(p) == digest} if before else set()
    folders = {period_of(p): p for p in base.paths if period_of(p) in unchanged} if unchanged else {}
    changed = None if now is None else now.keys() - unchanged
    rows = df.withColumn(FOLDER, _column(period).cast("string"))
    if unchanged and changed:
        # A literal per period that changed.
        some = _column(period).isin([date.fromisoformat(p) for p in changed if p])
        rows = rows.where(some | _column(period).isNull() if "" in changed else some)
    if changed is None or changed:
        folders |= _write(rows, path, base, within, gather)
    if now is None:
        whole = Version(0, tuple(folders.values()), {})
        now = digests(versions.read_version(spark, path, whole), period) if folders else {}
    paths = [folders[p] for p in sorted(folders)] or [versions.write_data(df.limit(0), path, base)]
    return versions.commit(spark, path, paths, base, {**(notes or {}), "digests": dict(now), **made_by})


def carried_on(spark: SparkSession, path: str, version: Version, period: str, as_of: date) -> DataFrame:
    """The rows of a version, with those of its latest period once more under the month-end of ``as_of`` where that is absent and the
    latest period is not later: ``extend_latest_period`` of the table. The copies are read from one folder."""
    table = versions.read_version(spark, path, version)
    target, there = last_of_month(as_of), periods_of(version)
    if not there or there[-1] >= target:
        return table
    return table.unionByName(read_periods(spark, path, version, there[-1:]).withColumn(period, F.lit(target)))
