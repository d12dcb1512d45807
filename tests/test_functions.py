from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rosterlake import fixed_values as fv
from rosterlake.functions import dates, keys, text
from rosterlake.functions.casts import lenient_cast

JUNE = date(2025, 6, 1)


def answers(table, function, kind, *inputs):
    df = table(f"i int, v {kind}", *enumerate(inputs))
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_common_date_spellings(table):
    given = ["2025-06-01", "2025/06/01", "06/01/2025", "6/1/2025", "2025-6-1", None, "not-a-date", "", "2025-02-30",
             "2025-06-01 00:00:00", "2025", "2025-06/01", "01-06-2025", "13/01/2025"]
    assert answers(table, dates.parse_common_date, "string", *given) == [JUNE] * 5 + [None] * 9


def test_common_dates_against_the_standard_library(table):
    rng = random.Random(11)
    forms = ["{y:04d}-{m:02d}-{d:02d}", "{y:04d}/{m:02d}/{d:02d}", "{m:02d}/{d:02d}/{y:04d}", "{y}-{m}-{d}", "{m}/{d}/{y}",
             "{d:02d}.{m:02d}.{y}", "{y:04d}-{m:02d}/{d:02d}", "{y:04d}-{m:02d}-{d:02d}x"]
    given = [
        rng.choice(forms).format(y=rng.randint(1900, 2100), m=rng.randint(0, 13), d=rng.randint(0, 32))
        for _ in range(1500)
    ]

    def expected(text):
        for form in ("%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y"):
            try:
                return datetime.strptime(text, form).date()
            except ValueError:
                pass
        return None

    assert answers(table, dates.parse_common_date, "string", *given) == [expected(t) for t in given]


def test_lenient_common_date_also_takes_iso_timestamps(table):
    given = ["2025-06-01 00:00:00", "2025-06-01T10:11:12", "06/01/2025", "2025", "2025-06", "n/a"]
    parse = lambda c: dates.parse_common_date(c, lenient=True)
    assert answers(table, parse, "string", *given) == [JUNE] * 3 + [None] * 3


@pytest.mark.parametrize(
    "column, accepted, refused",
    [
        ("offer_accepted_date", ["2025/06/01"], ["2025-06-01", "2025-06-01 00:00:00", "06/01/2025"]),
        ("job_application_date", ["2025-06-01 10:20:30", "2025-06-01 10:20:30.125"], ["2025-06-01", "2025/06/01"]),
        ("ready_for_hire_date", ["2025-06-01 00:00:00", "2025-06-01 23:59:59.999999"], ["2025-06-01 24:61:00"]),
        ("added_date", ["2025-06-01", "2025-06-01 10:20:30"], ["2025-06-01 10:20:30.5", "2025/06/01", "x"]),
        ("candidate_start_date", ["2025-06-01", "2025-06-01 00:00:00"], ["06/01/2025"]),
    ],
)
def test_report_date_depends_on_the_column(table, column, accepted, refused):
    df = table(f"i int, {column} string", *enumerate([*accepted, *refused, None]))
    got = [r[0] for r in df.orderBy("i").select(dates.parse_report_date(column)).collect()]
    assert got == [JUNE] * len(accepted) + [None] * (len(refused) + 1)


def test_embedded_date(table):
    given = ["2025-06-01 00:00:00", "as of 2025-06-01 10:11:12 (nightly)", "2025-06-01", "x12025-06-01 00:00:00",
             "at 2025-13-01 00:00:00 then 2025-06-01 00:00:00", "nothing", "", None]
    assert answers(table, dates.parse_embedded_date, "string", *given) == [JUNE] * 5 + [None] * 3


@pytest.mark.parametrize(
    "kind, value", [("date", JUNE), ("timestamp_ntz", datetime(2025, 6, 1, 23)), ("string", "2025-06-01")]
)
def test_as_date_by_type(table, kind, value):
    df = table(f"d {kind}", value)
    assert df.select(dates.as_date(df, "d").alias("d")).collect()[0][0] == JUNE


def test_cutoffs_months_and_periods(spark):
    d = F.lit(date(2024, 2, 15))
    row = spark.range(1).select(
        dates.years_back(date(2025, 6, 1), 3),
        dates.months_back(date(2025, 1, 31), 3),
        dates.month_start(d),
        dates.month_end(d),
        dates.year_month(d),
        dates.year_month(d, dash=False),
    )
    expected = (date(2022, 1, 1), date(2024, 10, 1), date(2024, 2, 1), date(2024, 2, 29), "2024-02", "202402")
    assert tuple(row.first()) == expected


def test_names_lose_their_id(table):
    given = ["Ana Lund (731)", "\t Jane ", "(5) x", "Al (1) (2)", "", None]
    assert answers(table, text.name_without_id, "string", *given) == ["Ana Lund", "Jane", "", "Al", "", None]


def test_bracketed_number(table):
    given = ["Q55 (50505)", "Q55", "(a1)", "(1) (2)", "", None]
    assert answers(table, text.bracketed_number, "string", *given) == ["50505", None, None, "1", None, None]


def test_digits_or_sentinel(table):
    given = ["Q55 (50505)", "none", "", None, "7"]
    digits = lambda c: text.digits_or(c, fv.BLANK_RECRUITER)
    assert answers(table, digits, "string", *given) == ["5550505", "zzz_blank", "zzz_blank", None, "7"]


def test_first_step_and_says(table):
    assert answers(table, text.first_step, "string", "Hire > External > X", "Hire", "a>b", None) == [
        "Hire", "Hire", "a>b", None]
    says = lambda c: text.says(c, "application in process")
    given = [" Application In Process\n", "Application in  process", None]
    assert answers(table, says, "string", *given) == [True, False, None]


def test_composite_id_is_null_when_a_part_is(table):
    df = table("a string, b int", ("x", 1), (None, 1), ("x", None), ("", 2))
    got = [r[0] for r in df.select(keys.composite_id("a", F.col("b"))).collect()]
    assert got == ["x_1", None, None, "_2"]


def test_recode_unknown_is_null(table):
    recode = lambda c: keys.recode(c, fv.STAGES)
    given = ["Review", "Ready for Hire", "Background Check", "review", None]
    assert answers(table, recode, "string", *given) == [1, 8, 7, None, None]


def test_lenient_cast(table):
    df = table("i int, v string", *enumerate(["12", "-3", "+4", "2.0", "40000", "x", "", None]))
    source = df.schema["v"].dataType
    short = [r[0] for r in df.orderBy("i").select(lenient_cast(F.col("v"), source, fv.layout(v="short")["v"].dataType)).collect()]
    assert short == [12, -3, 4, None, None, None, None, None]


def test_text_is_a_date_only_as_a_whole(table):
    given = ["2031-05-06", "2031/5/6", "45800", "12345", "2025", "2025-06", "2025-06-01 junk", "2031-13-01", " 2031-05-06", "", None]
    df = table("i int, v string", *enumerate(given))
    day = lenient_cast(F.col("v"), df.schema["v"].dataType, fv.layout(v="date")["v"].dataType)
    assert [r[0] for r in df.orderBy("i").select(day).collect()] == [date(2031, 5, 6)] * 2 + [None] * 9
