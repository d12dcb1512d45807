"""One query per operator, over the whole of the supplied tables."""

from __future__ import annotations

from datetime import date, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from harness.oracles import SCOPE_YEARS
from harness.recruiting_views import AS_OF, HEADCOUNT_AS_OF, RUN_MONTH_ENDS, spark_view
from rosterlake import fixed_values as fv
from rosterlake.functions import dates, keys, text
from rosterlake.operators import quality as dq
from rosterlake.operators.dedupe import duplicated_rows
from rosterlake.operators.joins import repeated_right_join
from rosterlake.operators.late import keep_one_late
from rosterlake.operators.periods import extend_latest_period, sort_by_period
from rosterlake.operators.shape import align_schema, select_rename
from rosterlake.operators.upsert import new_rows
from rosterlake.plans import applications as app
from rosterlake.plans import headcount as hc
from rosterlake.plans import checks, full_run, hires, referrals
from rosterlake.plans import requisitions as req
from rosterlake.sinks import tables as sinks
from rosterlake.sinks import versions
from rosterlake.sinks.counts import FileCounts
from rosterlake.sources import drops, reports
from rosterlake.sources.tables import read_table, scratch_path, stage

AS_OF_DATE = date.fromisoformat(AS_OF)
HEADCOUNT_DATE = date.fromisoformat(HEADCOUNT_AS_OF)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _under_headers(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select([F.col(new).alias(old) for old, new in names.items() if new in df.columns])


# --- recruiting tables from the views ----------------------------------------------------------------


def requisitions(spark, sf):
    return req.clean_requisitions(spark_view(spark, sf, "requisition_report"), AS_OF_DATE, SCOPE_YEARS)


def late_requisitions(spark, sf):
    """Requisitions chosen by id and date from a stored report, the other columns fetched afterwards."""
    stored = stage(spark_view(spark, sf, "requisition_report"), "report")
    return req.clean_requisitions(stored, AS_OF_DATE, SCOPE_YEARS, keep_one_late)


def late_lines(spark, sf):
    """The last line of each part to be shipped, from the files as they are; some parts have several on that day."""
    lines = keep_one_late(_table(spark, sf, "lineitem"), ["l_partkey"], ["l_shipdate"])
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def fulfillment_report(spark, sf):
    return _under_headers(spark_view(spark, sf, "fulfillment_report"), fv.FULFILLMENT_NAMES)


def hires_report(spark, sf):
    return _under_headers(spark_view(spark, sf, "hires_report"), fv.HIRES_NAMES)


def incoming(spark, sf):
    return hires.incoming_hires(fulfillment_report(spark, sf), hires_report(spark, sf), AS_OF_DATE)


def merged_hires(spark, sf):
    staged = stage(incoming(spark, sf), "incoming-hires")
    return hires.merge_hires(spark_view(spark, sf, "master_hires"), staged)


def applications(spark, sf):
    return app.clean_applications(spark_view(spark, sf, "application_report"), AS_OF_DATE)


def referred_funnel(spark, sf):
    return referrals.referred_only(app.stage_funnel(applications(spark, sf), carry=referrals.REFERRER_COLUMNS))


def prospects(spark, sf):
    return referrals.read_prospects(_under_headers(spark_view(spark, sf, "prospect_report"), fv.PROSPECT_NAMES))


def all_referrals(spark, sf):
    return referrals.referral_funnel(prospects(spark, sf), referred_funnel(spark, sf))


def headcount(spark, sf):
    return spark_view(spark, sf, "headcount")


def flag_headcount(spark, sf, referred: DataFrame):
    return hc.headcount_with_referrals(headcount(spark, sf), referrals.unique_referrals(referred), HEADCOUNT_DATE)


def flagged_headcount(spark, sf):
    return flag_headcount(spark, sf, all_referrals(spark, sf))


# --- sources -----------------------------------------------------------------------------------------


def _daily_drops(spark, sf) -> str:
    """Events written as one dated drop per day, the last day last."""
    folder = scratch_path(spark, "drops")
    events = _table(spark, sf, "events").withColumn("drop", F.concat(F.lit("events "), F.to_date("ts")))
    last = events.select(F.max("drop")).scalar()
    for part in (F.col("drop") < last, F.col("drop") == last):
        events.where(part).write.mode("append").partitionBy("drop").parquet(folder)
    return folder


def src_newest_drop(spark, sf):
    drop = drops.newest_drop(spark, _daily_drops(spark, sf), "drop=events*")
    return spark.read.parquet(drop["path"]).withColumn("ts", F.col("ts").cast("string"))


def src_feed_date(spark, sf):
    folder = _daily_drops(spark, sf)
    listed = drops.list_drops(spark, folder, "drop=*").select("drop", drops.feed_date(F.col("drop")).alias("feed_date"))
    rows = spark.read.parquet(folder).select(F.concat(F.lit("drop="), "drop").alias("drop"), "user_id")
    return (
        rows.join(listed, "drop")
        .groupBy("feed_date")
        .agg(F.count(F.lit(1)).alias("feed_rows"), F.countDistinct("user_id").alias("users"))
    )


def _customer_report(spark, sf, preamble: int) -> str:
    """Customers as report files, each with preamble lines and an untidy header line."""
    folder = scratch_path(spark, "report")
    customer = _table(spark, sf, "customer").repartition(4)
    record = F.to_csv(F.struct("c_custkey", "c_name", "c_mktsegment", "c_mktsegment", "c_nationkey", "c_acctbal"))
    head = [F.lit(f'"Report line {n}, made by Spark"') for n in range(preamble)]
    head.append(F.lit("Customer ID, Customer-Name ,Segment,SEGMENT,Nation Key (primary),Balance"))
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    lines = customer.select(record.alias("record"), first.alias("first"))
    lines = lines.select(
        F.explode(F.when(F.col("first"), F.array(*head, F.col("record"))).otherwise(F.array("record"))).alias("line")
    )
    lines.write.text(folder)
    return folder


def src_report_preamble(spark, sf):
    return reports.read_report(spark, _customer_report(spark, sf, 13), 13, snake=True)


def src_report_quoted(spark, sf):
    """A report whose fields hold blanks, quotes and line breaks, written as the CSV sink writes."""
    folder = scratch_path(spark, "quoted")
    sinks.write_csv(spark_view(spark, sf, "noted_orders").repartition(3, "o_orderkey"), folder)
    return reports.read_report(spark, folder, 0, line_breaks=True)


def src_report_select(spark, sf):
    names = {" Customer-Name ": "name", "Customer ID": "id"}
    return reports.read_report(spark, _customer_report(spark, sf, 16), 16, names=names, strict=True)


# --- sinks -------------------------------------------------------------------------------------------


def sink_roundtrip(spark, sf):
    folder, orders = scratch_path(spark, "roundtrip"), spark_view(spark, sf, "noted_orders")
    sinks.write_table(orders, f"{folder}/orders.parquet")
    sinks.write_csv(orders, f"{folder}/orders.csv")
    back = read_table(spark, f"{folder}/orders.parquet").withColumn("sink", F.lit("parquet"))
    csv = sinks.read_csv(spark, f"{folder}/orders.csv", orders.schema)
    return back.unionByName(csv.withColumn("sink", F.lit("csv")))


def sink_refresh_date(spark, sf):
    folder = scratch_path(spark, "refresh")
    refreshed = _table(spark, sf, "orders").select(F.max("o_orderdate").cast("date")).first()[0]
    sinks.write_refresh_date(spark, refreshed, f"{folder}/refresh_date.csv")
    return spark.read.schema("refresh_date date").option("header", True).csv(f"{folder}/refresh_date.csv")


def sink_versioned(spark, sf):
    """The second version of a table, made from its first."""
    path = f"{scratch_path(spark, 'versioned')}.parquet"
    sinks.replace_table(spark_view(spark, sf, "noted_orders"), path)
    starred = sinks.read_current(spark, path).withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("*")))
    version = sinks.replace_table(starred, path)
    return sinks.read_current(spark, path).withColumn("table_version", F.lit(version).cast("long"))


def sink_snapshot(spark, sf):
    """Snapshots of two days, the first of them run twice."""
    path = scratch_path(spark, "snapshots")
    orders = spark_view(spark, sf, "noted_orders")
    starred = orders.withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("*")))
    sinks.snapshot_table(orders, path, AS_OF_DATE)
    sinks.snapshot_table(orders, path, AS_OF_DATE + timedelta(days=1))
    sinks.snapshot_table(starred, path, AS_OF_DATE)
    return spark.read.parquet(path)


# --- schemas and functions ---------------------------------------------------------------------------


def schema_select_rename(spark, sf):
    return select_rename(fulfillment_report(spark, sf), {**fv.FULFILLMENT_NAMES, "Not There": "absent"})


def schema_align(spark, sf):
    schema = fv.layout(
        positions_filled_hire_selected="short",
        job_requisition_id="string",
        closed_on="date",
        mbps_teams="int",
        target_hire_date="date",
    )
    return align_schema(spark_view(spark, sf, "requisition_report"), schema, "requisition report")


def fn_parse_date_multi(spark, sf):
    return spark_view(spark, sf, "application_report").select(
        "candidate_id",
        F.col("added_date").alias("added_text"),
        F.col("target_hire_date").alias("target_text"),
        dates.parse_common_date(F.col("added_date")).alias("added_date"),
        dates.parse_common_date(F.col("target_hire_date")).alias("target_hire_date"),
    )


def fn_parse_date_by_column(spark, sf):
    columns = [
        "added_date",
        "candidate_start_date",
        "job_application_date",
        "ready_for_hire_date",
        "offer_accepted_date",
    ]
    parsed = [dates.parse_report_date(c).alias(c) for c in columns]
    return spark_view(spark, sf, "hires_report").select("candidate_id", *parsed)


def fn_parse_date_embedded(spark, sf):
    log = spark_view(spark, sf, "event_log")
    return log.select("event_id", dates.parse_embedded_date(F.col("stamp")).alias("stamp_date"))


def fn_composite_ids(spark, sf):
    start = dates.parse_report_date("candidate_start_date")
    return spark_view(spark, sf, "fulfillment_report").select(
        keys.composite_id("job_requisition_id", "position_id").alias("jrpos_id"),
        keys.composite_id("job_requisition_id", "employee_id").alias("jree_id"),
        keys.composite_id("employee_id", dates.year_month(start, dash=False)).alias("eehire_id"),
        keys.composite_id("employee_id", dates.year_month(start)).alias("headcount_id"),
    )


def fn_strip_id_suffix(spark, sf):
    named = F.col("referred_by")
    return spark_view(spark, sf, "prospect_report").select(
        named.alias("referred_by_text"), text.name_without_id(named).alias("referred_by")
    )


def fn_recruiter_id(spark, sf):
    offer = F.col("recruiter_completed_offer")
    number = F.coalesce(text.bracketed_number(offer), F.col("recruiter_employee_id"))
    return spark_view(spark, sf, "hires_report").select(offer, number.alias("rfh_recruiter_id"))


def fn_digits_sentinel(spark, sf):
    offer = F.col("recruiter_completed_offer")
    number = text.digits_or(offer, fv.BLANK_RECRUITER).alias("recruiter_completed_offer_id")
    return spark_view(spark, sf, "application_report").select(offer, number)


# --- stages ------------------------------------------------------------------------------------------


def req_status_counts(spark, sf):
    return req.status_counts(requisitions(spark, sf))


def hire_new_rows(spark, sf):
    staged = stage(incoming(spark, sf), "incoming-hires")
    return new_rows(spark_view(spark, sf, "master_hires"), staged, hires.MASTER_KEY, fv.MASTER_HIRES)


def hire_discrepancy(spark, sf):
    return hires.hire_discrepancies(merged_hires(spark, sf), requisitions(spark, sf))


def app_rescind(spark, sf):
    return applications(spark, sf).select(
        "candidate_id",
        "last_recruiting_stage_orig",
        "last_recruiting_stage",
        "disposition_reason_orig",
        "disposition_reason",
    )


def app_offer_accepts(spark, sf):
    return app.offer_accepts(applications(spark, sf))


def app_funnel(spark, sf):
    return app.stage_funnel(applications(spark, sf))


def ref_source_filter(spark, sf):
    """The funnel stored as a table, read back through filter and column selection."""
    path = f"{scratch_path(spark, 'funnel')}.parquet"
    sinks.write_table(app.stage_funnel(applications(spark, sf), carry=referrals.REFERRER_COLUMNS), path)
    columns = [*fv.FUNNEL_COLUMNS, *referrals.REFERRER_COLUMNS, "not_there"]
    return read_table(spark, path, columns, where=F.col("source").rlike(fv.REFERRAL_SOURCE))


def ref_normalise(spark, sf):
    return referrals.normalise(prospects(spark, sf))


def ref_unique(spark, sf):
    return referrals.unique_referrals(all_referrals(spark, sf))


def ref_counts(spark, sf):
    return referrals.referral_counts(prospects(spark, sf), referred_funnel(spark, sf))


def hc_extend(spark, sf):
    extended = extend_latest_period(headcount(spark, sf), hc.PERIOD, HEADCOUNT_DATE)
    return sort_by_period(extended, hc.PERIOD, ["employee_id"])


# --- quality -----------------------------------------------------------------------------------------


def _report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dq_nulls(spark, sf):
    read = align_schema(spark_view(spark, sf, "requisition_report"), fv.REQUISITION_INPUT)
    return _report(
        dq.violations(read, dq.not_null(["positions_filled_hire_selected", "target_hire_date"])),
        dq.violations(applications(spark, sf), dq.not_null(["disposition_reason", "last_stage_number"])),
        dq.violations(incoming(spark, sf), dq.not_null(["jrpos_id", "eehire_id", "candidate_id"])),
    )


def dq_domain(spark, sf):
    raw = {"compensation_grade": fv.GRADES_IN_SCOPE, "last_recruiting_stage": list(fv.STAGES)}
    staged = {
        "stage_number": [n for n in fv.STAGES.values() if n not in fv.MERGED_STAGES],
        "candidate_recruiting_status": [fv.PASSED, "Rejected"],
    }
    return _report(
        dq.violations(spark_view(spark, sf, "application_report"), dq.in_domain(raw)),
        dq.violations(spark_view(spark, sf, "flawed_applications"), dq.in_domain(staged)),
    )


def dq_duplicates(spark, sf):
    return _report(
        dq.duplicate_violations(spark_view(spark, sf, "requisition_report"), ["job_requisition_id"]),
        dq.duplicate_violations(spark_view(spark, sf, "fulfillment_report"), ["employee_id", "candidate_start_date"]),
        dq.duplicate_violations(spark_view(spark, sf, "prospect_report"), ["candidate_id"]),
    )


def dq_duplicated_rows(spark, sf):
    return duplicated_rows(spark_view(spark, sf, "fulfillment_report"), ["employee_id", "grade_proposed"])


def dq_rules(spark, sf):
    """Rules over stored tables with planted faults."""
    status, openings = F.col("jobreq_status"), F.col("positions_openings_available")
    requested = F.col("positions_requested_new")
    return _report(
        dq.violations(
            spark_view(spark, sf, "flawed_requisitions"),
            {
                **dq.implies(
                    "cancelled_requests_nothing", "positions_requested_new", status == "CAN", requested == 0
                ),
                **dq.implies("open_has_openings", "positions_openings_available", status == "OPEN", openings > 0),
                **dq.implies(
                    "filled_has_no_openings", "positions_openings_available", status == "FILLED", openings == 0
                ),
                **dq.in_range("positions_requested_new", 0),
            },
        ),
        dq.violations(
            spark_view(spark, sf, "flawed_applications"),
            {**dq.in_range("last_stage_number", 1, 8), **dq.not_after("job_application_date", AS_OF_DATE)},
        ),
        dq.violations(
            spark_view(spark, sf, "flawed_referrals"),
            {**dq.in_range("last_stage_number", 0), **dq.not_after("added_date", HEADCOUNT_DATE)},
        ),
        dq.violations(
            spark_view(spark, sf, "flawed_headcount"),
            {**dq.matches("headcount_id", r"^.+_\d{4}-\d{2}$"), **dq.matches("job_grade", "^Level [1-9]")},
        ),
    )


def dq_counted(spark, sf):
    """Checks of a second version, of which only the files that it adds are read."""
    path, rows = f"{scratch_path(spark, 'counted')}.parquet", spark_view(spark, sf, "flawed_applications")
    counts = FileCounts(
        {**dq.in_domain({"candidate_recruiting_status": [fv.PASSED, "Rejected"]}), **dq.in_range("last_stage_number", 1, 8)},
        latest=("job_application_date",),
    )
    early = F.col("stage_number") < 6
    sinks.replace_table(rows.where(early), path)
    base = sinks.current_version(spark, path)
    counts.by_file(spark, path, base)
    added = versions.write_data(rows.where(~early), path, base)
    version = versions.commit(spark, path, [*base.paths, added], base)
    return counts.violations(spark, path, version, AS_OF_DATE)


def join_hot_key(spark, sf):
    """Customers and their events, a third of which have one user and some none."""
    user = "case when event_id % 3 = 0 then 7 when event_id % 11 = 0 then null else user_id end as user_id"
    acted = _table(spark, sf, "events").selectExpr(user, "event_id", "event_type", "value", "props", "cast(ts as string) as ts")
    customers = _table(spark, sf, "customer").selectExpr("if(c_custkey % 13 = 0, null, c_custkey) as user_id", "c_name")
    return repeated_right_join(customers, acted, ["user_id"])


# --- the whole chain ---------------------------------------------------------------------------------


def all_reports(spark, sf) -> full_run.Reports:
    stamped = F.concat(F.col("reporting_date"), F.lit(" 00:00:00"))
    monthly = spark_view(spark, sf, "headcount", RUN_MONTH_ENDS).withColumn("reporting_date", stamped)
    headcount_report = _under_headers(monthly, fv.HEADCOUNT_NAMES)
    return full_run.Reports(
        requisitions=spark_view(spark, sf, "requisition_report"),
        fulfillment=fulfillment_report(spark, sf),
        hires=hires_report(spark, sf),
        applications=spark_view(spark, sf, "application_report"),
        prospects=_under_headers(spark_view(spark, sf, "prospect_report"), fv.PROSPECT_NAMES),
        headcount=headcount_report,
        refreshed=AS_OF_DATE,
    )


def last_stage(spark, sf):
    """Applications, funnel, referrals and headcount flags as one plan, with nothing stored in between."""
    reports = all_reports(spark, sf)
    cleaned = app.clean_applications(reports.applications, AS_OF_DATE)
    unique = full_run.referral_tables(cleaned, reports.prospects)[1]
    return hc.headcount_with_referrals(hc.read_headcount(reports.headcount), unique, AS_OF_DATE)


#: Where a session has published the tables of a folder, so that one run serves all queries on it.
_PUBLISHED: dict[tuple, str] = {}


def _published_key(spark, sf) -> tuple:
    """A session, a folder and when its tables last changed."""
    newest = drops.list_drops(spark, sf, "*.parquet").agg(F.max("modified")).first()[0]
    return spark.sparkContext.applicationId, sf, newest


def published_folder(spark, sf) -> str:
    """All five stages run one after the other and published under a scratch folder."""
    key = _published_key(spark, sf)
    if key not in _PUBLISHED:
        out = scratch_path(spark, "published")
        sinks.replace_table(spark_view(spark, sf, "master_hires"), f"{out}/hires_master.parquet")
        full_run.run(spark, all_reports(spark, sf), out, AS_OF_DATE, SCOPE_YEARS)
        _PUBLISHED[key] = out
    return _PUBLISHED[key]


PUBLISHED = [
    "requisitions", "hires", "hire_discrepancies", "applications", "offer_accepts", "funnel", "referrals", "headcount",
]


def all_stages(spark, sf):
    """Rows per published table of a whole run, which is made anew."""
    _PUBLISHED.pop(_published_key(spark, sf), None)
    out = published_folder(spark, sf)
    return _report(
        *[
            sinks.read_current(spark, f"{out}/{name}.parquet")
            .agg(F.count(F.lit(1)).alias("table_rows"))
            .select(F.lit(name).alias("table_name"), "table_rows")
            for name in PUBLISHED
        ]
    )


def published_table(name: str, spark, sf):
    return sinks.read_current(spark, f"{published_folder(spark, sf)}/{name}.parquet")


def published_csv(spark, sf):
    schema = published_table("applications", spark, sf).schema
    return sinks.read_csv(spark, f"{published_folder(spark, sf)}/applications.csv", schema)


def snapshot_of_table(spark, sf):
    """The headcount as the snapshot of the day names it."""
    return sinks.read_named(spark, f"{published_folder(spark, sf)}/snapshots/processed", AS_OF_DATE, "headcount")


def dq_run(spark, sf):
    """Checks of all tables of the last run."""
    return checks.check_run(spark, published_folder(spark, sf), AS_OF_DATE)


def dq_run_rows(spark, sf):
    """Rows of the last run's tables by status, stage and flag."""
    out = published_folder(spark, sf)
    columns = {"requisitions": "jobreq_status", "funnel": "stage", "headcount": "has_referral"}
    return _report(
        *[
            checks.run_rows(spark, out, name).select(F.lit(name).alias("table"), F.col(c).cast("string").alias("value"), "rows")
            for name, c in columns.items()
        ]
    )


def snapshot_of_report(spark, sf):
    return sinks.read_snapshot(spark, f"{published_folder(spark, sf)}/snapshots/raw/requisitions", AS_OF_DATE)


QUERIES = {
    "src_newest_drop": src_newest_drop,
    "src_feed_date": src_feed_date,
    "src_report_preamble": src_report_preamble,
    "src_report_select": src_report_select,
    "src_report_quoted": src_report_quoted,
    "sink_roundtrip": sink_roundtrip,
    "sink_refresh_date": sink_refresh_date,
    "sink_versioned": sink_versioned,
    "sink_snapshot": sink_snapshot,
    "schema_select_rename": schema_select_rename,
    "schema_align": schema_align,
    "fn_parse_date_multi": fn_parse_date_multi,
    "fn_parse_date_by_column": fn_parse_date_by_column,
    "fn_parse_date_embedded": fn_parse_date_embedded,
    "fn_composite_ids": fn_composite_ids,
    "fn_strip_id_suffix": fn_strip_id_suffix,
    "fn_recruiter_id": fn_recruiter_id,
    "fn_digits_sentinel": fn_digits_sentinel,
    "req_clean": requisitions,
    "req_clean_late": late_requisitions,
    "late_latest": late_lines,
    "req_status_counts": req_status_counts,
    "hire_incoming": incoming,
    "hire_upsert": merged_hires,
    "hire_new_rows": hire_new_rows,
    "hire_discrepancy": hire_discrepancy,
    "app_clean": applications,
    "app_rescind": app_rescind,
    "app_offer_accepts": app_offer_accepts,
    "app_funnel": app_funnel,
    "ref_source_filter": ref_source_filter,
    "ref_normalise": ref_normalise,
    "ref_funnel": all_referrals,
    "ref_unique": ref_unique,
    "ref_counts": ref_counts,
    "hc_extend": hc_extend,
    "hc_referral_flag": flagged_headcount,
    "dq_nulls": dq_nulls,
    "dq_domain": dq_domain,
    "dq_duplicates": dq_duplicates,
    "dq_duplicated_rows": dq_duplicated_rows,
    "dq_rules": dq_rules,
    "dq_counted": dq_counted,
    "dq_run": dq_run,
    "dq_run_rows": dq_run_rows,
    "join_hot_key": join_hot_key,
    "last_stage": last_stage,
    "all_stages": all_stages,
    **{f"stage_{name}": partial(published_table, name) for name in PUBLISHED},
    "stage_applications_csv": published_csv,
    "stage_snapshot": snapshot_of_table,
    "stage_raw_snapshot": snapshot_of_report,
}
