"""What is counted of every data file of a versioned table, kept beside it, so that a new version is checked by its new files alone.

Versions share files that have not changed, and counts of files add up: violations of checks, rows by value, greatest dates. They
are kept in a versioned table of their own, ``counts/<table>-<digest>.parquet`` in the folder that the table is in, one row per
file and combination of values. The digest is that of what is counted, as Spark prints it, and of the library's version;
something else is counted from the start. Counts of files that are gone stay and are not asked for.

Duplicate keys are not among them, since a key's rows may lie in several files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake import __version__
from rosterlake.operators.quality import Checks, not_after, report_rows, violations
from rosterlake.sinks import versions
from rosterlake.sinks.versions import Version

_FILE, _ROWS = "__file", "__rows"


@dataclass(frozen=True)
class FileCounts:
    """``checks``: violations to count. ``by``: columns of few values, by which rows are counted. ``latest``: date columns that no
    day of a run may lie before, of which a file's greatest value is kept."""

    checks: Checks = field(default_factory=dict)
    by: tuple[str, ...] = ()
    latest: tuple[str, ...] = ()

    def _sums(self) -> list[str]:
        return [_ROWS, *(f"__c{i}" for i in range(len(self.checks)))]

    def _measures(self) -> list[Column]:
        counted = [F.count(F.lit(1)), *(F.count_if(test) for test in self.checks.values())]
        greatest = [F.max(c).alias(f"__m{i}") for i, c in enumerate(self.latest)]
        return [c.alias(name) for c, name in zip(counted, self._sums(), strict=True)] + greatest

    def folder(self, path: str) -> str:
        """The table of the counts of the table at ``path``."""
        what = [__version__, *self.by, *map(str, self._measures())]
        root, _, name = path.rstrip("/").removesuffix(".parquet").rpartition("/")
        return f"{root}/counts/{name}-{sha256(repr(what).encode()).hexdigest()[:16]}.parquet"

    def by_file(self, spark: SparkSession, path: str, version: Version) -> DataFrame:
        """The counts of the files of a version. Files that have none yet are read, and their counts kept for later; of another writer
        who does so at the same time the first one's are taken."""
        kept_at, files = self.folder(path), versions.files_of(spark, path, version)
        while True:
            base = versions.current_version(spark, kept_at)
            kept = versions.read_version(spark, kept_at, base) if base else None
            known = {r[0] for r in kept.select(_FILE).distinct().collect()} if base else set()
            missing = [f for f in files if f not in known]
            if not missing:
                return kept.join(_names(spark, files), _FILE, "left_semi")
            written = versions.write_data(self._counted(spark, path, version, missing, files), kept_at, base)
            try:
                versions.commit(spark, kept_at, [*(base.paths if base else ()), written], base)
            except versions.Conflict:
                continue

    def _counted(self, spark: SparkSession, path: str, version: Version, wanted: list[str], files: list[str]) -> DataFrame:
        """Counts of some files; a file without rows has a row of zeros."""
        rows = versions.read_version(spark, path, version._replace(paths=versions.paths_of(version, wanted, files)))
        file = F.regexp_extract("_metadata.file_path", versions.FILE, 0)
        counted = rows.groupBy(file.alias(_FILE), *self.by).agg(*self._measures())
        return _names(spark, wanted).join(counted, _FILE, "left").na.fill(0, self._sums())

    def violations(self, spark: SparkSession, path: str, version: Version, as_of: date | None = None) -> DataFrame:
        """One row (check, column, violations) per check, and per date column the rows later than ``as_of``: these are counted in files
        whose greatest date is later, so in none as a rule."""
        counts = self.by_file(spark, path, version)
        totals = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in self._sums()[1:]), F.lit(0).alias(_ROWS))
        report = report_rows(totals, list(self.checks), self._sums()[1:]) if self.checks else None
        for i, column in enumerate(self.latest if as_of else ()):
            late = [r[0] for r in counts.where(F.col(f"__m{i}") > F.lit(as_of)).select(_FILE).distinct().collect()]
            rows = versions.read_version(spark, path, version._replace(paths=tuple(late)) if late else version)
            part = violations(rows if late else rows.limit(0), not_after(column, as_of))
            report = report.unionByName(part) if report is not None else part
        return report

    def rows_by(self, spark: SparkSession, path: str, version: Version, *columns: str) -> DataFrame:
        """``rows`` by some of the columns ``by``, or by all of them; null is a value."""
        counts = self.by_file(spark, path, version).where(F.col(_ROWS) > 0)
        return counts.groupBy(*(columns or self.by)).agg(F.sum(_ROWS).alias("rows"))


def _names(spark: SparkSession, files: list[str]) -> DataFrame:
    """Files as rows; the driver has their names of any table that it reads."""
    return spark.createDataFrame([(f,) for f in files], f"{_FILE} string")


def violations_by_table(
    spark: SparkSession, root: str, counted: Mapping[str, FileCounts], numbers: Mapping[str, int], as_of: date | None = None
) -> DataFrame:
    """Rows (table, check, column, violations) of several tables under ``root``, each at the version that ``numbers`` gives."""
    report = None
    for name, counts in counted.items():
        path = f"{root}/{name}.parquet"
        part = counts.violations(spark, path, versions.version_of(spark, path, numbers[name]), as_of).withColumn("table", F.lit(name))
        report = part if report is None else report.unionByName(part)
    return report.select("table", "check", "column", "violations")
