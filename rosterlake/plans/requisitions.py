"""Requisitions: scope, one row per id, status."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, functions as F, types as T

from rosterlake import fixed_values as fv
from rosterlake.functions.dates import years_back
from rosterlake.operators.dedupe import keep_one
from rosterlake.operators.shape import align_schema, cast_strict


def requisitions_in_scope(
    raw: DataFrame, refreshed: date, scope_years: int = fv.REQUISITION_SCOPE_YEARS
) -> DataFrame:
    """Input columns that exist, leniently typed, from 1 January ``scope_years`` before the refresh year."""
    present = T.StructType([f for f in fv.REQUISITION_INPUT if f.name in raw.columns])
    typed = align_schema(raw, present, "requisitions")
    return typed.where(F.col("target_hire_date") >= years_back(refreshed, scope_years))


def latest_requisitions(requisitions: DataFrame, choose: Callable[..., DataFrame] = keep_one) -> DataFrame:
    """The latest version of each requisition, with the positions requested and the status.

    A missing target date counts as latest. Sums beyond 16 bits fail. ``choose`` is ``keep_one``, or ``keep_one_late`` for
    requisitions that come straight from Parquet files.
    """
    latest = choose(requisitions, ["job_requisition_id"], ["target_hire_date"], nulls_win=True)
    openings, filled = F.col("positions_openings_available"), F.col("positions_filled_hire_selected")
    requested = (openings.cast("int") + filled.cast("int")).cast("short")
    status = (
        F.when(F.col("positions_requested_new") == 0, "CAN").when(openings > 0, "OPEN").otherwise("FILLED")
    )
    rated = latest.withColumn("positions_requested_new", requested).withColumn("jobreq_status", status)
    return cast_strict(rated, fv.REQUISITIONS)


def clean_requisitions(
    raw: DataFrame, refreshed: date, scope_years: int = fv.REQUISITION_SCOPE_YEARS, choose: Callable[..., DataFrame] = keep_one
) -> DataFrame:
    return latest_requisitions(requisitions_in_scope(raw, refreshed, scope_years), choose)


def status_counts(requisitions: DataFrame) -> DataFrame:
    return requisitions.groupBy("jobreq_status").agg(F.count(F.lit(1)).alias("requisitions"))
