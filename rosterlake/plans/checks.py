"""What is checked of the published tables after a run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake import fixed_values as fv
from rosterlake.operators import quality as dq
from rosterlake.plans.full_run import last_run
from rosterlake.sinks import versions
from rosterlake.sinks.counts import FileCounts, violations_by_table


def published_checks() -> dict[str, FileCounts]:
    """Table -> what is counted of its files."""
    status, openings, requested = (F.col(c) for c in ("jobreq_status", "positions_openings_available", "positions_requested_new"))
    counted = [n for n in fv.STAGES.values() if n not in fv.MERGED_STAGES]
    return {
        "requisitions": FileCounts(
            {
                **dq.not_null(["job_requisition_id", "target_hire_date"]),
                **dq.implies("cancelled_requests_nothing", "positions_requested_new", status == "CAN", requested == 0),
                **dq.implies("open_has_openings", "positions_openings_available", status == "OPEN", openings > 0),
                **dq.implies("filled_has_no_openings", "positions_openings_available", status == "FILLED", openings == 0),
                **dq.in_range("positions_requested_new", 0),
            },
            by=("jobreq_status",),
        ),
        "hires": FileCounts(dq.not_null(["jrpos_id", "eehire_id", "candidate_id"])),
        "applications": FileCounts(
            {
                **dq.not_null(["disposition_reason", "last_stage_number"]),
                **dq.in_domain({"compensation_grade": fv.GRADES_IN_SCOPE}),
                **dq.in_range("last_stage_number", 1, 8),
            },
            latest=("job_application_date",),
        ),
        "funnel": FileCounts(dq.in_domain({"stage_number": counted}), by=("stage",)),
        "referrals": FileCounts(dq.in_range("last_stage_number", 0), latest=("added_date",)),
        "headcount": FileCounts(
            {**dq.matches("headcount_id", r"^.+_\d{4}-\d{2}$"), **dq.matches("job_grade", "^Level [1-9]")}, by=("has_referral",)
        ),
    }


def check_run(spark: SparkSession, out: str, as_of: date) -> DataFrame:
    """Rows (table, check, column, violations) for the tables of the last finished run. Only files that no earlier check has counted
    are read, and files with a date after ``as_of``."""
    return violations_by_table(spark, out, published_checks(), _tables(spark, out), as_of)


def run_rows(spark: SparkSession, out: str, name: str) -> DataFrame:
    """``rows`` of a table of the last finished run by the columns that are counted of it: requisitions by status, the funnel by stage,
    headcount by flag."""
    path = f"{out}/{name}.parquet"
    return published_checks()[name].rows_by(spark, path, versions.version_of(spark, path, _tables(spark, out)[name]))


def _tables(spark: SparkSession, out: str) -> dict[str, int]:
    found = last_run(spark, out)
    if found is None:
        raise FileNotFoundError(f"no run under {out}")
    return found[1]["tables"]
