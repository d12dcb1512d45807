"""The five stages in order, from report drops to published tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake import fixed_values as fv
from rosterlake.plans.applications import (
    application_month,
    corrected_applications,
    offer_accepts,
    read_applications,
    stage_funnel,
)
from rosterlake.plans.headcount import PERIOD, read_headcount, with_referrals
from rosterlake.plans.hires import MASTER_KEY, hire_discrepancies, incoming_hires
from rosterlake.plans.referrals import (
    REFERRER_COLUMNS,
    read_prospects,
    referral_funnel,
    referred_only,
    unique_referrals,
)
from rosterlake.plans.requisitions import clean_requisitions
from rosterlake.session import small_tasks
from rosterlake.sinks import tables as sinks
from rosterlake.sinks.merge import merge_table
from rosterlake.sinks.periods import carried_on, digests, replace_periods
from rosterlake.sinks.versions import create_once, names_in, read_small
from rosterlake.sources.drops import newest_drop, require_feed_date
from rosterlake.sources.reports import read_report


MASTER = "hires_master.parquet"
#: The headcount report by month, as it came.
MONTHS = "headcount_months"


@dataclass(frozen=True)
class Reports:
    """Raw inputs: requisitions and applications under column names, the others under report headers."""

    requisitions: DataFrame
    fulfillment: DataFrame
    hires: DataFrame
    applications: DataFrame
    prospects: DataFrame
    headcount: DataFrame
    refreshed: date


@dataclass(frozen=True)
class Patterns:
    """Globs of the drops; the defaults are fixed values, the exports' own names."""

    requisitions: str = fv.REQUISITION_DROPS
    fulfillment: str = fv.FULFILLMENT_DROPS
    hires: str = fv.HIRES_DROPS
    applications: str = fv.APPLICATION_DROPS
    prospects: str = fv.PROSPECT_DROPS
    headcount: str = fv.HEADCOUNT_DROPS


def read_reports(spark: SparkSession, landing: str, historical: str | None = None, patterns: Patterns = Patterns()) -> Reports:
    """The newest drop of every report; the requisition drop's name gives the refresh date. The headcount is in the folder
    ``historical``, or else with the others."""

    def newest(pattern: str, preamble: int, folder: str = landing, **how) -> DataFrame:
        return read_report(spark, newest_drop(spark, folder, pattern)["path"], preamble, **how)

    requisitions = newest_drop(spark, landing, patterns.requisitions)
    return Reports(
        requisitions=read_report(spark, requisitions["path"], fv.REQUISITION_PREAMBLE, snake=True),
        fulfillment=newest(patterns.fulfillment, fv.FULFILLMENT_PREAMBLE),
        hires=newest(patterns.hires, fv.HIRES_PREAMBLE),
        # The only report that is delivered as CSV and not exported from a sheet; its free text may hold line breaks.
        applications=newest(
            patterns.applications, fv.APPLICATION_PREAMBLE, names=fv.APPLICATION_NAMES, strict=True, line_breaks=True
        ),
        prospects=newest(patterns.prospects, fv.PROSPECT_PREAMBLE),
        headcount=newest(patterns.headcount, fv.HEADCOUNT_PREAMBLE, historical or landing),
        refreshed=require_feed_date(requisitions["drop"]),
    )


def landed(spark: SparkSession, name: str, report: DataFrame, folder: str, as_of: date) -> DataFrame:
    """A report kept as that day's raw snapshot and read back: text is parsed once, columns are pruned."""
    sinks.snapshot_table(report, f"{folder}/{name}", as_of)
    return sinks.read_snapshot(spark, f"{folder}/{name}", as_of)


def referral_tables(applications: DataFrame, prospects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Referrals and unique referrals. The funnel carries the referrer, without which no id is complete."""
    funnel = stage_funnel(applications, carry=REFERRER_COLUMNS)
    referrals = referral_funnel(read_prospects(prospects), referred_only(funnel))
    return referrals, unique_referrals(referrals)


def _run_key(reports: Reports, last: int, *settings) -> str:
    """What a run is known by: the run before it, its settings and its input files."""
    files = sorted(f for df in vars(reports).values() if isinstance(df, DataFrame) for f in df.inputFiles())
    return sha256(json.dumps([last, *map(str, settings), reports.refreshed.isoformat(), files]).encode()).hexdigest()


def run(
    spark: SparkSession, reports: Reports, out: str, as_of: date, scope_years: int, *, one_per_key: bool = False
) -> dict[str, DataFrame]:
    """Run the stages and publish their tables under ``out``; returns the published tables.

    ``one_per_key`` goes to the upsert of hires.

    Every table is versioned, and a run is one commit that names the version of each: ``read_run`` sees the tables of one
    finished run, whatever a later one has already written. A version notes the run that made it; when a failed run is
    started again with the same reports and settings, tables that it had published are taken as they are. Requisitions,
    hires, applications and the reports of the last stages are worked on at once. Each stage reads what the stages before it
    wrote. The funnel is expanded once, with the referrer beside its columns for the referrals. Hires are the master's own
    files under a second name, and of the master only files that hold an incoming position are rewritten. Applications,
    offer accepts, funnel and headcount are kept by month. Digests by month of the applications in scope tell which months have
    changed since the last run: only these are cleansed and expanded, the others keep their files. The headcount's latest
    month is carried on from that month's files alone. The snapshot of the day names versions. The table ``hires_master.parquet`` has to exist.
    While it runs, the session's tasks are small (``session.small_tasks``).
    """
    path = lambda name: f"{out}/{name}.parquet"
    master, raw = f"{out}/{MASTER}", f"{out}/snapshots/raw"
    if sinks.current_version(spark, master) is None:
        raise FileNotFoundError(f"no version of table {master}")
    last = last_run(spark, out)
    number = last[0] + 1 if last else 1
    notes = {"run": _run_key(reports, number - 1, as_of, scope_years, one_per_key)}
    made: dict[str, int] = {}

    def earlier(table: str):
        """What this run had published before it failed."""
        found = sinks.current_version(spark, table)
        return found if found and found.notes.get("run") == notes["run"] else None

    def published(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        found = earlier(path(name))
        made[name] = found.number if found else sinks.replace_table(make(), path(name), notes=notes)
        return sinks.read_version(spark, path(name), found or sinks.version_of(spark, path(name), made[name]))

    def published_by(name: str, period: Callable[[DataFrame], Column], make: Callable[[], DataFrame], **how) -> sinks.Version:
        found = earlier(path(name))
        if found is None:
            rows = make()
            found = replace_periods(rows, path(name), period(rows), notes=notes, **how)
        made[name] = found.number
        return found

    def months() -> sinks.Version:
        return published_by(MONTHS, reported, lambda: read_headcount(report("headcount")), within=["employee_id"])

    def reported(rows: DataFrame) -> Column:
        return F.col(PERIOD)

    def headcount() -> DataFrame:
        current = carried_on(spark, path(MONTHS), monthly.result(), PERIOD, as_of)
        return with_referrals(current, unique_referrals(referrals))

    def report(name: str) -> DataFrame:
        return landed(spark, name, getattr(reports, name), raw, as_of)

    def requisitions() -> DataFrame:
        sinks.write_refresh_date(spark, reports.refreshed, f"{out}/refresh_date.csv")
        return published("requisitions", lambda: clean_requisitions(report("requisitions"), reports.refreshed, scope_years))

    def hires() -> DataFrame:
        merged = earlier(master)
        if merged is None:
            incoming = incoming_hires(report("fulfillment"), report("hires"), as_of)
            merged = merge_table(incoming, master, MASTER_KEY, fv.MASTER_HIRES, one_per_key=one_per_key, notes=notes)
        shared = earlier(path("hires")) or sinks.share_version(spark, master, merged, path("hires"), notes)
        made["hires"] = shared.number
        return sinks.read_version(spark, path("hires"), shared)

    def applications() -> sinks.Version:
        found = earlier(path("applications"))
        if found is None:
            read = read_applications(report("applications"), as_of)
            known = digests(read, application_month(read))
            found = published_by("applications", application_month, lambda: corrected_applications(read), known=known)
        made["applications"] = found.number
        return found

    with small_tasks(spark), ThreadPoolExecutor(8) as workers:
        first, second, third = (workers.submit(f) for f in (requisitions, hires, applications))
        prospects = None if earlier(path("referrals")) else workers.submit(report, "prospects")
        monthly = workers.submit(months)
        discrepancies = workers.submit(
            lambda: published("hire_discrepancies", lambda: hire_discrepancies(second.result(), first.result()))
        )
        of_month = {"known": third.result().notes["digests"], "gather": False}
        cleaned = sinks.read_version(spark, path("applications"), third.result())
        csv = workers.submit(sinks.write_csv, cleaned, f"{out}/applications.csv")
        accepts = workers.submit(published_by, "offer_accepts", application_month, lambda: offer_accepts(cleaned), **of_month)
        expanded = published_by("funnel", application_month, lambda: stage_funnel(cleaned, carry=REFERRER_COLUMNS), **of_month)
        funnel = sinks.read_version(spark, path("funnel"), expanded)
        referrals = published("referrals", lambda: referral_funnel(read_prospects(prospects.result()), referred_only(funnel)))
        flagged = sinks.read_version(spark, path("headcount"), published_by("headcount", reported, headcount, within=["employee_id"]))
        csv.result()
        tables = {
            "requisitions": first.result(), "hires": second.result(), "hire_discrepancies": discrepancies.result(), "applications": cleaned,
            "offer_accepts": sinks.read_version(spark, path("offer_accepts"), accepts.result()), "funnel": funnel.select(fv.FUNNEL_COLUMNS), "referrals": referrals, "headcount": flagged,
        }

    sinks.name_versions(spark, {name: path(name) for name in tables}, f"{out}/snapshots/processed", as_of, made)
    create_once(spark, f"{out}/runs/{number:06d}.json", {"as_of": as_of.isoformat(), "tables": made} | notes)
    return tables


def last_run(spark: SparkSession, out: str) -> tuple[int, dict] | None:
    """Number and content of the last finished run's commit."""
    numbers = [int(n[:-5]) for n in names_in(spark, f"{out}/runs") if n[:-5].isdigit()]
    return (max(numbers), read_small(spark, f"{out}/runs/{max(numbers):06d}.json")) if numbers else None


def read_run(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table as the last finished run published it."""
    found = last_run(spark, out)
    if found is None or name not in found[1]["tables"]:
        raise FileNotFoundError(f"no run under {out} has published {name}")
    path = f"{out}/{name}.parquet"
    return sinks.read_version(spark, path, sinks.version_of(spark, path, found[1]["tables"][name]))


def vacuum(spark: SparkSession, out: str) -> dict[str, list[str]]:
    """Remove what neither a current version, the last finished run nor a snapshot of the day names, of every table under ``out``; see
    ``versions.remove_unnamed``. Scratch folders of runs (``rosterlake`` in the checkpoint folder) can go as a whole when no run
    is at work."""
    kept = sinks.named_paths(spark, f"{out}/snapshots/processed")
    last = last_run(spark, out)
    names = [*(last[1]["tables"] if last else ()), MASTER.removesuffix(".parquet")]
    for name in names:
        kept |= set(sinks.current_version(spark, f"{out}/{name}.parquet").paths)
        if last and name in last[1]["tables"]:
            kept |= set(sinks.version_of(spark, f"{out}/{name}.parquet", last[1]["tables"][name]).paths)
    return {name: sinks.remove_unnamed(spark, f"{out}/{name}.parquet", kept) for name in names}
