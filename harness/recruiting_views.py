"""Recruiting-shaped views over the supplied tables, as SQL that Spark and DuckDB both run.

The supplied tables hold no recruiting data. Each view turns whole tables into the shape of one export:
no rows are left out, and nulls, bad text, unmatched keys and repeated ids are derived from the columns.
A name in braces is a table or another view.
"""

from __future__ import annotations

import re

AS_OF = "2000-01-15"
HEADCOUNT_AS_OF = "2024-01-20"
RUN_MONTH_ENDS = ["1999-08-31", "1999-09-30", "1999-10-31", "1999-11-30", "1999-12-31"]
MONTH_ENDS = ["2023-08-31", "2023-09-30", "2023-10-31", "2023-11-30", "2023-12-31"]

_STAGE = """case o_orderkey % 10 when 0 then 'Review' when 1 then 'Screen' when 2 then 'Assessment'
    when 3 then 'Interview' when 4 then 'Reference Check' when 5 then 'Offer' when 6 then 'Background Check'
    when 7 then 'Unheard Of' when 8 then 'Ready for Hire' end"""
_SOURCE = """case o_orderpriority when '1-URGENT' then 'ERP' when '2-HIGH' then 'Employee referral'
    when '3-MEDIUM' then null when '5-LOW' then 'Enterprise Agency' else 'Career Site' end"""


def _day(ts: str) -> str:
    return f"cast(cast({ts} as date) as string)"


def _spelled(day: str, way: str) -> str:
    """The text ``day`` in one of three spellings, or unreadable, by the number ``way``."""
    us = f"substr({day}, 6, 2) || '/' || substr({day}, 9, 2) || '/' || substr({day}, 1, 4)"
    return f"case {way} when 0 then {day} when 1 then replace({day}, '-', '/') when 2 then {us} else 'n/a' end"


def _digit(place: int, of: int) -> str:
    return f"cast(floor(o_orderkey / {place}) as bigint) % {of}"


VIEWS = {
    # Many versions per requisition; all of it text. Of the dates some have slashes, some are a bare year, a serial number, or
    # have something after them; the last three kinds would count as late dates if they were read at all.
    "requisition_report": """
select 'JR-' || cast(l_orderkey as string) as job_requisition_id,
    case l_partkey % 11 when 0 then replace(cast(cast(l_shipdate as date) as string), '-', '/')
        when 1 then '2040' when 2 then cast(45000 + l_partkey % 1000 as string)
        when 3 then cast(cast(l_shipdate as date) as string) || ' tbc' when 4 then 'n/a'
        else cast(cast(l_shipdate as date) as string) end as target_hire_date,
    case when l_linenumber = 7 and l_returnflag = 'A' then 'n/a' when l_linestatus = 'F'
        then cast(cast(l_quantity as int) % 3 as string) else '0' end as positions_filled_hire_selected,
    case when l_linestatus = 'O' then cast(cast(l_quantity as int) % 3 as string) else '0' end
        as positions_openings_available,
    l_returnflag as mbps_teams, l_linestatus as some_extra_column
from {lineitem}""",
    "application_report": f"""
select 'CAND-' || cast(o_custkey as string) as candidate_id, c_name as candidate_name,
    'JR-' || cast(o_orderkey % 200 as string) as job_requisition_id, 'Engineer' as job_requisition,
    'Open to all' as recruiting_instruction, c_mktsegment as job_family,
    case when o_orderkey % 17 = 0 then null else 'Level ' || cast(1 + o_custkey % 10 as string) end
        as compensation_grade,
    'Employee' as worker_type_hiring_requirement, 'Regular' as worker_sub_type_hiring_requirement,
    {_spelled("day60", _digit(10, 4))} as target_hire_date,
    {_spelled("day0", _digit(100, 4))} as added_date,
    {_spelled("day3", _digit(1000, 3))} as job_application_date,
    case when o_orderstatus = 'F' then {_spelled("day30", _digit(10, 3))} end
        as offer_accepted_date,
    case when o_orderstatus = 'F' then {_spelled("day45", _digit(100, 3))} end
        as candidate_start_date,
    'R' || cast(o_custkey as string) as recruiter_employee_id,
    case when o_custkey % 9 = 0 then null when o_custkey % 9 = 1 then 'unknown'
        else c_name || ' (' || cast(o_custkey as string) || ')' end as recruiter_completed_offer,
    case when {_digit(100, 2)} = 0 then null else 'Chose another offer' end as disposition_reason,
    case o_orderstatus when 'F' then 'Offer Accepted' when 'O' then ' Application in Process'
        else case when o_orderkey % 19 = 0 then null else 'Rejected' end end as candidate_recruiting_status,
    {_STAGE} as last_recruiting_stage,
    case when o_custkey % 3 = 0 then null else 'Yes' end as hired,
    case when o_custkey % 3 = 0 then 'Rescinded' else 'Completed' end as hire_transaction_status,
    {_SOURCE} as source,
    case when o_custkey % 23 = 0 then null else 'EMP-' || cast(o_custkey % 50 as string) end
        as referred_by_employee_id,
    'Referrer ' || cast(o_custkey % 50 as string) || ' (' || cast(o_custkey % 50 as string) || ')' as referred_by,
    case when o_orderpriority = '5-LOW' then 'Agency' end as recruiting_agency, 'Former Ltd' as last_employer,
    cast(null as string) as school_name, 'No' as is_cancelled, c_mktsegment as mbps_teams
from (select *, {_day("o_orderdate")} as day0, {_day("o_orderdate + interval 3 day")} as day3,
        {_day("o_orderdate + interval 30 day")} as day30, {_day("o_orderdate + interval 45 day")} as day45,
        {_day("o_orderdate + interval 60 day")} as day60 from {{orders}}) as o
    left join {{customer}} on o_custkey = c_custkey""",
    "fulfillment_report": """
select 'JR-' || cast(o_orderkey as string) as job_requisition_id,
    case when o_orderkey % 101 = 0 then null else 'POS-' || cast(o_orderkey as string) end as position_id,
    case when o_orderkey % 103 = 0 then null else 'EMP-' || cast(o_custkey as string) end as employee_id,
    'Name ' || cast(o_custkey as string) as employee_name,
    case o_orderstatus when 'F' then 'Hire > External' when 'O' then 'Hire > Internal > Transfer' else 'Hire' end
        as business_process_reason,
    cast(cast(o_orderdate as date) as string) || case when o_orderkey % 2 = 0 then '' else ' 00:00:00' end
        as candidate_start_date,
    case when o_orderkey % 13 = 0 then null else 'Level ' || cast(1 + o_custkey % 10 as string) end
        as grade_proposed
from {orders}""",
    # A third of the rows starts in another month than in the fulfillment report and matches nothing.
    "hires_report": """
select 'CAND-' || cast(o_custkey as string) as candidate_id,
    case when o_orderkey % 107 = 0 then null else 'EMP-' || cast(o_custkey as string) end as employee_id,
    cast(cast(o_orderdate - interval 90 day as date) as string) as added_date,
    cast(cast(o_orderdate - interval 100 day as date) as string) as recruiting_start_date,
    cast(cast(o_orderdate - interval 80 day as date) as string)
        || case o_orderkey % 3 when 0 then ' 10:20:30' when 1 then ' 10:20:30.125' else '' end
        as job_application_date,
    cast(cast(o_orderdate - interval 20 day as date) as string) || ' 00:00:00' as ready_for_hire_date,
    cast(cast(case when o_orderkey % 3 = 0 then o_orderdate + interval 31 day else o_orderdate end as date) as string)
        as candidate_start_date,
    case o_orderkey % 5 when 0 then null when 1 then 'R' || cast(o_custkey as string)
        else 'R' || cast(o_custkey as string) || ' (' || cast(o_orderkey as string) || ')' end
        as recruiter_completed_offer,
    'R' || cast(o_custkey as string) as recruiter_employee_id,
    case when o_custkey % 4 = 0 then 'EMP-' || cast(o_custkey % 50 as string) end as referred_by_employee_id,
    case o_orderpriority when '1-URGENT' then 'ERP' when '3-MEDIUM' then null else 'LinkedIn' end as source,
    case when o_orderpriority = '5-LOW' then 'Agency' end as recruiting_agency,
    case when o_orderkey % 2 = 0 then replace(cast(cast(o_orderdate - interval 30 day as date) as string), '-', '/')
        else cast(cast(o_orderdate - interval 30 day as date) as string) end as offer_accepted_date,
    case when o_orderkey % 4 = 0 then cast(cast(o_orderdate - interval 70 day as date) as string) end
        as jr_unfreeze_date,
    cast(o_orderkey % 40 as string) as days_frozen
from {orders}""",
    # Present hires, a third of them under positions that no longer exist; overrides on some rows.
    "master_hires": """
select case when o_orderkey % 101 = 0 then null else 'JR-' || cast(o_orderkey as string)
        || case when o_orderkey % 3 = 0 then '_OLD-' else '_POS-' end || cast(o_orderkey as string) end as jrpos_id,
    'JR-' || cast(o_orderkey as string) || '_EMP-' || cast(o_custkey as string) as jree_id,
    cast(null as string) as eehire_id, 'JR-' || cast(o_orderkey as string) as job_requisition_id,
    'EMP-' || cast(o_custkey as string) as employee_id, cast(null as string) as candidate_id,
    'Former name ' || cast(o_custkey as string) as employee_name,
    'POS-' || cast(o_orderkey as string) as position_id, 'Hire' as business_process_reason,
    cast(null as date) as recruiting_start_date, cast(o_orderdate as date) as added_date,
    cast(null as date) as job_application_date, cast(null as date) as ready_for_hire_date,
    cast(o_orderdate as date) as candidate_start_date, 'late' as is_hire_on_time_exception,
    cast(null as date) as jr_unfreeze_date, cast(null as date) as offer_accepted_date,
    cast(null as string) as days_frozen, 'R0' as rfh_recruiter_id,
    case when o_custkey % 11 = 0 then 'R-override' end as rfh_recruiter_id_exception,
    cast(null as string) as recruiter_completed_offer, o_orderpriority as source,
    case when o_custkey % 7 = 0 then 'Manual' end as source_exception, 'Old agency' as recruiting_agency,
    cast(null as string) as referred_by_employee_id, 'kept' as remarks, cast(null as date) as termination_date,
    cast(null as string) as termination_reason, cast(null as string) as termination_reason_category,
    cast(o_custkey % 90 as int) as termination_tenure_days_bucket
from {orders}""",
    "headcount": f"""
select {{unnest}} as reporting_date, n_name as location, c_mktsegment as function, 'Sub' as sub_function,
    cast(c_custkey % 10 as string) as job_grade, 'EMP-' || cast(c_custkey as string) as employee_id
from {{customer}} left join {{nation}} on c_nationkey = n_nationkey""",
    "prospect_report": f"""
select case when event_id % 97 = 0 then null else 'CAND-' || cast(user_id as string) end as candidate_id,
    'JR-' || cast(event_id % 200 as string) as job_requisition_id,
    case when event_id % 89 = 0 then null else 'EMP-' || cast(user_id % 50 as string) end
        as referred_by_employee_id,
    '  Referrer ' || cast(user_id as string) || ' (' || cast(user_id as string) || ')' as referred_by,
    case when event_id % 4 = 3 then substr(cast(ts as string), 1, 19) else {_spelled("day", "event_id % 4")} end
        as added_date,
    case event_type when 'signup' then 'ERP' when 'click' then 'Employee Referral' else 'Referral' end as source,
    case when event_type = 'error' then 'Chose another offer' end as disposition_reason, 'Prospect' as candidate_recruiting_status
from (select *, {_day("ts")} as day from {{events}}) as e""",
    # Text that a CSV sink or reader can spoil.
    "noted_orders": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as string) as o_orderdate, o_orderpriority,
    case o_orderkey % 8 when 0 then '  padded ' when 1 then 'They said "yes", twice' when 2 then 'two' || chr(10) || 'lines'
        when 3 then '' when 4 then null when 5 then 'back' || chr(92) || 'slash' when 6 then '"' else 'a,b' end as note
from {orders}""",
    # Tables with planted faults, a different number of each.
    "flawed_requisitions": """
select 'JR-' || cast(o_orderkey as string) as job_requisition_id,
    cast(o_orderkey % 5 - case when o_orderkey % 29 = 0 then 7 else 0 end as int) as positions_requested_new,
    cast(o_custkey % 3 as int) as positions_openings_available,
    case when o_orderkey % 4 = 0 then 'CAN' when o_orderkey % 4 < 3 then 'OPEN' else 'FILLED' end as jobreq_status
from {orders}""",
    "flawed_applications": """
select 'CAND-' || cast(o_custkey as string) as candidate_id, cast(o_orderkey % 11 as int) as last_stage_number,
    cast(o_orderkey % 10 as int) as stage_number, cast(o_orderdate as date) as job_application_date,
    case o_orderkey % 13 when 0 then null when 1 then 'Lost' else 'Passed' end as candidate_recruiting_status
from {orders}""",
    "flawed_referrals": """
select cast(event_id % 17 as int) - 1 as last_stage_number,
    date_add(cast(ts as date), cast(event_id % 23 as int)) as added_date
from {events}""",
    "flawed_headcount": """
select 'EMP-' || cast(c_custkey as string) || case when c_custkey % 19 = 0 then '_2023' else '_2023-08' end as headcount_id,
    'Level ' || cast(c_custkey % 10 as string) as job_grade
from {customer}""",
    # Dates the way they are found in free text.
    "event_log": """
select event_id, case event_id % 5 when 0 then 'run of ' || substr(cast(ts as string), 1, 19) || ' (nightly)'
        when 1 then substr(cast(ts as string), 1, 19) when 2 then substr(cast(ts as string), 1, 10)
        when 3 then 'no date' end as stamp
from {events}""",
}

TABLES = "region nation customer supplier part orders lineitem events".split()


def used_tables(view: str) -> set[str]:
    return set(re.findall(r"{(\w+)}", VIEWS[view])) & set(TABLES)


def duckdb_sql(view: str, month_ends: list[str] = MONTH_ENDS) -> str:
    dates = ", ".join(f"date '{d}'" for d in month_ends)
    return VIEWS[view].format(unnest=f"unnest([{dates}])", **{t: t for t in TABLES})


def spark_view(spark, sf_dir: str, view: str, month_ends: list[str] = MONTH_ENDS):
    """The view as a Spark DataFrame."""
    dates = ", ".join(f"date '{d}'" for d in month_ends)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used_tables(view)}
    sql = VIEWS[view].replace("{unnest}", f"explode(array({dates}))")
    return spark.sql(sql, **tables)
