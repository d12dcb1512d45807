"""Hires: two reports into one incoming table, upsert into the master, reconciliation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from rosterlake import fixed_values as fv
from rosterlake.functions.dates import months_back, parse_report_date, year_month
from rosterlake.functions.keys import composite_id
from rosterlake.functions.text import bracketed_number, first_step
from rosterlake.operators.dedupe import keep_one
from rosterlake.operators.reconcile import reconcile_counts
from rosterlake.operators.shape import align_schema, select_rename
from rosterlake.operators.upsert import has_hot_key, upsert_with_overrides

MASTER_KEY = "jrpos_id"


def _with_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: parse_report_date(c) for c in df.columns if c.endswith("_date")})


def _started_since(as_of: date):
    return F.col("candidate_start_date") >= months_back(as_of, fv.HIRE_SCOPE_MONTHS)


def employee_month_id():
    return composite_id("employee_id", year_month(F.col("candidate_start_date"), dash=False))


def fulfilled_positions(report: DataFrame, as_of: date) -> DataFrame:
    """Fulfillment report: typed, in scope, keyed. An unknown grade is out of scope."""
    typed = _with_dates(select_rename(report, fv.FULFILLMENT_NAMES))
    return typed.where(_started_since(as_of) & ~F.col("grade_proposed").isin(*fv.GRADES_OUT_OF_SCOPE)).withColumns(
        {
            "business_process_reason": first_step(F.col("business_process_reason")),
            "jrpos_id": composite_id("job_requisition_id", "position_id"),
            "eehire_id": employee_month_id(),
            "jree_id": composite_id("job_requisition_id", "employee_id"),
        }
    )


def hired_candidates(report: DataFrame, as_of: date) -> DataFrame:
    """Internal and external hires report: typed, in scope, keyed, without what fulfillment has already."""
    typed = _with_dates(select_rename(report, fv.HIRES_NAMES)).where(_started_since(as_of))
    return typed.withColumns(
        {
            "rfh_recruiter_id": F.coalesce(
                bracketed_number(F.col("recruiter_completed_offer")), F.col("recruiter_employee_id")
            ),
            "days_frozen": F.when(F.col("jr_unfreeze_date").isNull(), "0").otherwise(F.col("days_frozen")),
            "offer_accepted_date": F.coalesce("offer_accepted_date", "ready_for_hire_date"),
            "eehire_id": employee_month_id(),
        }
    ).drop("candidate_start_date", "employee_id", "recruiter_employee_id")


def incoming_hires(fulfillment: DataFrame, hires: DataFrame, as_of: date) -> DataFrame:
    """Fulfillment rows with their hire details, the last one per employee and start month.

    The row kept has the latest start date, then the greatest employee id; both come from fulfillment. Each
    side can therefore be reduced to one row per employee-month before the join, which gives the row that
    joining first would have given, without multiplying repeated employee-months. The join uses the
    partitioning of the two reductions.
    """
    left = keep_one(fulfilled_positions(fulfillment, as_of), ["eehire_id"], ["candidate_start_date", "employee_id"])
    right = keep_one(hired_candidates(hires, as_of).where(F.col("eehire_id").isNotNull()), ["eehire_id"])
    joined = left.join(right, "eehire_id", "left")
    return joined.select(*left.columns, *[c for c in right.columns if c != "eehire_id"])


def merge_hires(master: DataFrame, incoming: DataFrame, *, one_per_key: bool = False) -> DataFrame:
    """Master hires brought up to date with ``incoming``, a stored or staged table. A job over its key tells whether one key holds
    so many rows that they have to be dealt out."""
    aligned = align_schema(master, fv.MASTER_HIRES, "master hires")
    repeated = not one_per_key and has_hot_key(incoming, MASTER_KEY)
    return upsert_with_overrides(aligned, incoming, MASTER_KEY, fv.MASTER_HIRES, one_per_key=one_per_key, repeated=repeated)


def hire_discrepancies(hires: DataFrame, requisitions: DataFrame) -> DataFrame:
    """Requisitions whose declared number of filled positions differs from their number of hires."""
    return reconcile_counts(
        align_schema(requisitions, fv.DECLARED_FILLED, "requisitions"),
        "positions_filled_hire_selected",
        hires,
        "job_requisition_id",
        declared_as="jobreq_filled_count",
        observed_as="hires_count",
    )
