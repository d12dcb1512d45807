"""Monthly headcount with a referral flag."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from rosterlake import fixed_values as fv
from rosterlake.functions.dates import parse_embedded_date, year_month
from rosterlake.functions.keys import composite_id
from rosterlake.operators.flags import flag_from
from rosterlake.operators.periods import extend_latest_period
from rosterlake.operators.shape import select_rename

PERIOD = "reporting_date"


def read_headcount(report: DataFrame) -> DataFrame:
    """Headcount report under column names, with its date parsed."""
    named = select_rename(report, fv.HEADCOUNT_NAMES)
    return named.withColumn(PERIOD, parse_embedded_date(F.col(PERIOD)))


def headcount_with_referrals(headcount: DataFrame, referrals: DataFrame, as_of: date) -> DataFrame:
    """Headcount carried on to the month of ``as_of``, keyed by employee and month, with ``has_referral``.

    ``referrals`` holds each ``headcount_id`` once with its flag.
    """
    return with_referrals(extend_latest_period(headcount, PERIOD, as_of), referrals)


def with_referrals(current: DataFrame, referrals: DataFrame) -> DataFrame:
    """``headcount_with_referrals`` of a headcount that has been carried on."""
    keyed = current.withColumns(
        {
            "job_grade": F.concat(F.lit("Level "), F.col("job_grade").cast("string")),
            "headcount_id": composite_id("employee_id", year_month(F.col(PERIOD))),
        }
    )
    return flag_from(keyed, referrals, "headcount_id", "has_referral")
