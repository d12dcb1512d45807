"""Counts by data file: equal to a full pass, and only files without counts are read."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import quality as dq
from rosterlake.sinks import periods, tables as sinks, versions
from rosterlake.sinks.counts import FileCounts
from tests.conftest import values

JAN, FEB, MAR = date(2031, 1, 31), date(2031, 2, 28), date(2031, 3, 31)
SCHEMA = "month date, who string, stage int"
ROWS = [(JAN, "a", 1), (JAN, None, 9), (FEB, "b", None), (FEB, "b", 0), (None, "c", 3), (MAR, None, 12)]


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/of the month/heads.parquet"


def counts():
    return FileCounts({**dq.not_null(["who"]), **dq.in_range("stage", 1, 8)}, by=("who", "stage"), latest=("month",))


@pytest.fixture
def read(monkeypatch):
    """The files that were counted, call by call."""
    seen, counted = [], FileCounts._counted

    def spy(self, spark, path, version, wanted, files):
        seen.append(list(wanted))
        return counted(self, spark, path, version, wanted, files)

    monkeypatch.setattr(FileCounts, "_counted", spy)
    return seen


def full_pass(df, as_of):
    return values(dq.violations(df, {**counts().checks, **dq.not_after("month", as_of)}))


def test_a_new_version_is_checked_by_its_new_files(spark, table, path, read):
    sinks.replace_table(table(SCHEMA, *ROWS[:4]).repartition(2), path)
    base = sinks.current_version(spark, path)
    assert values(counts().violations(spark, path, base, FEB)) == full_pass(table(SCHEMA, *ROWS[:4]), FEB)
    # Files of the first version beside those of another write, one of the old ones left out.
    old = versions.files_of(spark, path, base)
    added = versions.write_data(table(SCHEMA, *ROWS[4:]), path, base)
    second = versions.commit(spark, path, [*old[1:], added], base)
    assert values(counts().violations(spark, path, second, FEB)) == full_pass(versions.read_version(spark, path, second), FEB)
    assert len(read) == 2 and read[0] == old and all(f.startswith(added) for f in read[1])
    # Whatever has been counted is not read again, of an older version either, and another day needs no other counts.
    for version, as_of in ((base, JAN), (second, JAN), (second, MAR)):
        assert values(counts().violations(spark, path, version, as_of)) == full_pass(versions.read_version(spark, path, version), as_of)
    assert len(read) == 2
    # Something else is counted from the start.
    other = FileCounts(dq.not_null(["stage"]))
    assert values(other.violations(spark, path, second)) == values(dq.violations(versions.read_version(spark, path, second), other.checks))
    assert len(read) == 3 and read[2] == versions.files_of(spark, path, second)


def test_rows_by_value(spark, table, path):
    sinks.replace_table(table(SCHEMA, *ROWS).repartition(3), path)
    version = sinks.current_version(spark, path)
    want = lambda *c: values(table(SCHEMA, *ROWS).groupBy(*c).agg(F.count("*").alias("rows")))
    assert values(counts().rows_by(spark, path, version, "who")) == want("who")
    assert values(counts().rows_by(spark, path, version)) == want("who", "stage")


def test_tables_by_period(spark, table, path, read):
    """A month that changes is counted again, the others are not; rows without a month have a folder too."""
    put = lambda *rows: periods.replace_periods(table(SCHEMA, *rows), path, "month")
    first = put(*ROWS)
    assert values(counts().violations(spark, path, first, MAR)) == full_pass(table(SCHEMA, *ROWS), MAR)
    changed = [*ROWS[:-1], (MAR, "d", 4)]
    second = put(*changed)
    assert values(counts().violations(spark, path, second, FEB)) == full_pass(table(SCHEMA, *changed), FEB)
    assert len(read) == 2 and len(read[1]) == 1 and "of_period=2031-03-31" in read[1][0]


def test_an_empty_table_and_no_check(spark, table, path, read):
    sinks.replace_table(table(SCHEMA), path)
    version = sinks.current_version(spark, path)
    for _ in range(2):
        assert values(counts().violations(spark, path, version, JAN)) == full_pass(table(SCHEMA), JAN)
        assert values(counts().rows_by(spark, path, version)) == []
    assert len(read) == 1
    only_dates = FileCounts(latest=("month",))
    assert values(only_dates.violations(spark, path, version, JAN)) == [("not_after", "month", 0)]


def test_two_who_count_at_once(spark, table, path, monkeypatch):
    """The second takes the first one's counts: nothing is counted twice."""
    sinks.replace_table(table(SCHEMA, *ROWS), path)
    version, counted = sinks.current_version(spark, path), FileCounts._counted
    states = []

    def slow(self, spark, path, version, wanted, files):
        if not states:
            states.append("first")
            self.by_file(spark, path, version)
        return counted(self, spark, path, version, wanted, files)

    monkeypatch.setattr(FileCounts, "_counted", slow)
    assert values(counts().violations(spark, path, version, FEB)) == full_pass(table(SCHEMA, *ROWS), FEB)
    kept = counts().folder(path)
    assert versions.current_version(spark, kept).number == 1 and len(os.listdir(f"{kept}/data")) == 2


def test_paths_of():
    version = versions.Version(1, ("t.parquet/data/a", "t.parquet/data/b/x", "t.parquet/data/c/p=1"), {})
    files = ["t.parquet/data/a/1", "t.parquet/data/a/2", "t.parquet/data/b/x", "t.parquet/data/c/p=1/1"]
    assert versions.paths_of(version, files, files) == ("t.parquet/data/a", "t.parquet/data/b/x", "t.parquet/data/c/p=1")
    assert versions.paths_of(version, files[1:], files) == ("t.parquet/data/a/2", "t.parquet/data/b/x", "t.parquet/data/c/p=1")
    assert [versions.relative_file(f"file:/r/{f}") for f in files] == files
