from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rosterlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", app="tests", spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def table(spark):
    """``table("a int, b string", (1, "x"), ...)``"""

    def make(schema: str, *rows):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return make


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(df, *columns):
    """Rows as sorted tuples; nulls sort first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
