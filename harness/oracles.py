"""DuckDB SQL for every query of the catalog, written from the rules and not from the Spark code.

Latest-row rules are ``row_number`` with all columns as tie-break, the upsert is a left join plus an anti
join, the funnel a join to a stage list, the incoming hires are joined first and reduced afterwards.
"""

from __future__ import annotations

from harness.recruiting_views import AS_OF, HEADCOUNT_AS_OF, RUN_MONTH_ENDS, duckdb_sql
from rosterlake import fixed_values as fv

SCOPE_YEARS = 3
_CUTOFF_REQ = f"make_date(year(date '{AS_OF}') - {SCOPE_YEARS}, 1, 1)"
_CUTOFF_APP = f"make_date(year(date '{AS_OF}') - 4, 1, 1)"
_CUTOFF_HIRE = f"cast(date_trunc('month', date '{AS_OF}') - interval 3 month as date)"


def _with(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def _view(name: str) -> str:
    return f"{name} as ({duckdb_sql(name)})"


def _parsed(col: str, *formats: str) -> str:
    return "coalesce(" + ", ".join(f"cast(try_strptime({col}, '{f}') as date)" for f in formats) + ")"


def _common(col: str) -> str:
    return _parsed(col, "%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y")


def _desc(*columns: str) -> str:
    return ", ".join(f"{c} desc nulls last" for c in columns)


# --- requisitions ------------------------------------------------------------------------------------

_REQ_DATE = _parsed("target_hire_date", "%Y-%m-%d", "%Y/%m/%d")
_REQ_TYPED = f"""req_typed as (
select job_requisition_id, {_REQ_DATE} as target_hire_date,
    try_cast(positions_filled_hire_selected as smallint) as positions_filled_hire_selected,
    try_cast(positions_openings_available as smallint) as positions_openings_available, mbps_teams
from requisition_report where {_REQ_DATE} >= {_CUTOFF_REQ})"""

_REQ = f"""requisitions as (
select job_requisition_id, target_hire_date, positions_filled_hire_selected, positions_openings_available,
    mbps_teams,
    cast(positions_openings_available + positions_filled_hire_selected as smallint) as positions_requested_new,
    case when positions_openings_available + positions_filled_hire_selected = 0 then 'CAN'
        when positions_openings_available > 0 then 'OPEN' else 'FILLED' end as jobreq_status
from (select *, row_number() over (partition by job_requisition_id order by
    {_desc("target_hire_date", "positions_filled_hire_selected", "positions_openings_available", "mbps_teams")}) as n
    from req_typed) where n = 1)"""

_REQUISITIONS = (_view("requisition_report"), _REQ_TYPED, _REQ)

# --- hires -------------------------------------------------------------------------------------------

_STARTED = _parsed("candidate_start_date", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d")

_FULFILLED = f"""fulfilled as (
select job_requisition_id, position_id, employee_id, employee_name,
    split_part(business_process_reason, ' > ', 1) as business_process_reason, started as candidate_start_date,
    grade_proposed, job_requisition_id || '_' || position_id as jrpos_id,
    employee_id || '_' || strftime(started, '%Y%m') as eehire_id,
    job_requisition_id || '_' || employee_id as jree_id
from (select *, {_STARTED} as started from fulfillment_report)
where started >= {_CUTOFF_HIRE} and grade_proposed not in ('Level 9', 'Level 10'))"""


def _plain(col: str) -> str:
    return _parsed(col, "%Y-%m-%d %H:%M:%S", "%Y-%m-%d")


def _stamped(col: str) -> str:
    return _parsed(col, "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f")


_HIRED = f"""hired as (
select candidate_id, {_plain("added_date")} as added_date, {_plain("recruiting_start_date")} as recruiting_start_date,
    {_stamped("job_application_date")} as job_application_date,
    {_stamped("ready_for_hire_date")} as ready_for_hire_date, recruiter_completed_offer, referred_by_employee_id,
    source, recruiting_agency,
    coalesce({_parsed("offer_accepted_date", "%Y/%m/%d")}, {_stamped("ready_for_hire_date")}) as offer_accepted_date,
    {_plain("jr_unfreeze_date")} as jr_unfreeze_date,
    case when {_plain("jr_unfreeze_date")} is null then '0' else days_frozen end as days_frozen,
    coalesce(nullif(regexp_extract(recruiter_completed_offer, '\\((\\d+)\\)', 1), ''), recruiter_employee_id)
        as rfh_recruiter_id,
    employee_id || '_' || strftime({_STARTED}, '%Y%m') as eehire_id
from hires_report where {_STARTED} >= {_CUTOFF_HIRE})"""

_FULFILLED_COLUMNS = [*fv.FULFILLMENT_NAMES.values(), "jrpos_id", "eehire_id", "jree_id"]
_HIRED_COLUMNS = [
    *(c for c in fv.HIRES_NAMES.values() if c not in ("employee_id", "candidate_start_date", "recruiter_employee_id")),
    "rfh_recruiter_id",
]
_INCOMING_COLUMNS = _FULFILLED_COLUMNS + _HIRED_COLUMNS
_TIES = [c for c in _INCOMING_COLUMNS if c not in ("eehire_id", "candidate_start_date", "employee_id")]

_INCOMING_CTE = f"""incoming as (
select {", ".join(_INCOMING_COLUMNS)} from (
    select f.*, h.* exclude (eehire_id), row_number() over (partition by f.eehire_id order by
        {_desc("f.candidate_start_date", "f.employee_id", *_TIES)}) as n
    from fulfilled f left join hired h on f.eehire_id = h.eehire_id)
where n = 1)"""

_INCOMING = (_view("fulfillment_report"), _view("hires_report"), _FULFILLED, _HIRED, _INCOMING_CTE)

_MASTER_COLUMNS = fv.MASTER_HIRES.names


def _updated(c: str) -> str:
    if c == "jrpos_id" or c not in _INCOMING_COLUMNS:
        return f"m.{c}"
    override = f"m.{c}_exception, " if f"{c}_exception" in _MASTER_COLUMNS else ""
    return f"coalesce({override}i.{c}, m.{c}) as {c}"


def _fresh(c: str) -> str:
    kind = "date" if c.endswith("_date") else "integer" if c.endswith("_bucket") else "varchar"
    return f"i.{c}" if c in _INCOMING_COLUMNS else f"cast(null as {kind}) as {c}"


_NEW_SQL = (
    f"select {', '.join(_fresh(c) for c in _MASTER_COLUMNS)} from incoming i "
    "where not exists (select 1 from master_hires m where m.jrpos_id = i.jrpos_id)"
)
_MERGED = f"""hires as (
select {", ".join(_updated(c) for c in _MASTER_COLUMNS)} from master_hires m left join incoming i on m.jrpos_id = i.jrpos_id
union all {_NEW_SQL})"""

# --- applications ------------------------------------------------------------------------------------

_RAW_APPLICATION_COLUMNS = list(fv.APPLICATION_NAMES.values())
_DATES = fv.APPLICATION_DATES
_STAGE_NUMBER = f"case last_recruiting_stage {' '.join(f"when '{label}' then {n}" for label, n in fv.STAGES.items())} end"

_APP_TYPED = f"""app_typed as (
select * replace ({", ".join(f"{_common(c)} as {c}" for c in _DATES)}, coalesce(source, 'zzz_unknown') as source)
from application_report),
app_scoped as (
select *, last_recruiting_stage as last_recruiting_stage_orig,
    candidate_recruiting_status as candidate_recruiting_status_orig, disposition_reason as disposition_reason_orig,
    coalesce(hire_transaction_status = 'Rescinded' and hired is null and last_recruiting_stage = 'Ready for Hire'
        and candidate_recruiting_status = 'Offer Accepted', false) as rescinded
from app_typed where job_application_date >= {_CUTOFF_APP} and compensation_grade in ({
    ", ".join(f"'Level {n}'" for n in range(1, 9))})),
app_corrected as (
select * replace (
    case when rescinded or (last_recruiting_stage = 'Ready for Hire' and disposition_reason is not null)
        then 'Offer' else last_recruiting_stage end as last_recruiting_stage,
    case when rescinded then 'Offer Accepted to Rescinded' else disposition_reason end as disposition_reason)
from app_scoped)"""

_APPS = f"""applications as (
select {", ".join(_RAW_APPLICATION_COLUMNS)}, last_recruiting_stage_orig, candidate_recruiting_status_orig,
    disposition_reason_orig,
    case when regexp_replace(recruiter_completed_offer, '\\D+', '', 'g') = '' then 'zzz_blank'
        else regexp_replace(recruiter_completed_offer, '\\D+', '', 'g') end as recruiter_completed_offer_id,
    cast({_STAGE_NUMBER} as tinyint) as last_stage_number
from app_corrected)"""

_APPLICATIONS = (_view("application_report"), _APP_TYPED, _APPS)

_FUNNEL_CTE = """stage_list(stage_number, stage) as (values (1, 'Review'), (2, 'Screen'), (3, 'Assessment'),
    (4, 'Interview'), (6, 'Offer'), (7, 'Background Check'), (8, 'Ready for Hire')),
funnel_typed as (
select *, case when last_stage_number = 5 then 4 else last_stage_number end as last_number,
    coalesce(lower(trim(candidate_recruiting_status)) = 'application in process', false) as in_process
from applications),
funnel as (
select job_requisition_id, candidate_id, added_date,
    cast(date_trunc('month', job_application_date) as date) as job_application_date,
    cast(last_number as smallint) as last_stage_number, cast(stage_number as smallint) as stage_number, stage,
    case when stage_number = last_number then candidate_recruiting_status else 'Passed' end
        as candidate_recruiting_status,
    recruiting_agency, source, case when stage_number = last_number then disposition_reason end as disposition_reason,
    referred_by_employee_id, referred_by
from funnel_typed join stage_list
    on (in_process and stage_number < last_number) or (not in_process and stage_number <= last_number))"""

_FUNNEL = (*_APPLICATIONS, _FUNNEL_CTE)

# --- referrals ---------------------------------------------------------------------------------------

_PROSPECTS = """prospects as (
select * replace (coalesce(
    cast(try_strptime(added_date, '%Y-%m-%d') as date), cast(try_strptime(added_date, '%Y/%m/%d') as date),
    cast(try_strptime(added_date, '%m/%d/%Y') as date),
    cast(try_strptime(added_date, '%Y-%m-%d %H:%M:%S') as date)) as added_date)
from prospect_report)"""


def _normalised(stage: str, extra: str, source: str) -> str:
    return f"""select coalesce(candidate_id, '') as candidate_id,
    coalesce(job_requisition_id, '') as job_requisition_id,
    coalesce(referred_by_employee_id, '') as referred_by_employee_id,
    trim(split_part(referred_by, '(', 1)) as referred_by, added_date, source, disposition_reason,
    candidate_recruiting_status, cast({stage} as smallint) as last_stage_number{extra} from {source}"""


_REFERRED = "funnel where regexp_matches(source, '(?i)ERP|Referral')"
_REFERRAL_ROWS = f"""referral_rows as (
{_normalised("last_stage_number", ", 0 as origin, stage_number", _REFERRED)}
union all {_normalised("0", ", 1 as origin, null", "prospects")}
union all {_normalised("0", ", 2 as origin, stage_number", _REFERRED + " and last_stage_number = 1")})"""

_REFERRALS_CTE = f"""referrals as (
select * exclude (origin, stage_number, n) from (
    select *, row_number() over (partition by erp_id order by {_desc(
        "origin", "stage_number", "candidate_id", "job_requisition_id", "referred_by_employee_id", "referred_by",
        "added_date", "source", "disposition_reason", "candidate_recruiting_status", "last_stage_number")}) as n
    from (select *, job_requisition_id || '_' || referred_by_employee_id || '_' || candidate_id as erp_id,
        referred_by_employee_id || '_' || strftime(added_date, '%Y-%m') as headcount_id from referral_rows))
where n = 1)"""

_REFERRALS = (*_FUNNEL, _view("prospect_report"), _PROSPECTS, _REFERRAL_ROWS, _REFERRALS_CTE)
_UNIQUE_CTE = "unique_referrals as (select distinct headcount_id, cast(1 as tinyint) as has_referral from referrals)"

# --- headcount ---------------------------------------------------------------------------------------



def _extended(as_of: str) -> str:
    return f"""extended as (
select * from headcount
union all
select last_day(date '{as_of}') as reporting_date, location, function, sub_function, job_grade, employee_id
from headcount
where reporting_date = (select max(reporting_date) from headcount)
    and reporting_date <= last_day(date '{as_of}')
    and not exists (select 1 from headcount where reporting_date = last_day(date '{as_of}')))"""


_FLAGGED = """flagged as (
select reporting_date, location, function, sub_function, 'Level ' || job_grade as job_grade, employee_id,
    e.employee_id || '_' || strftime(reporting_date, '%Y-%m') as headcount_id,
    cast(coalesce(has_referral, 0) as tinyint) as has_referral
from extended e left join unique_referrals u
    on u.headcount_id = e.employee_id || '_' || strftime(reporting_date, '%Y-%m'))"""

_HEADCOUNT = (_view("headcount"), _extended(HEADCOUNT_AS_OF))
_FLAGS = (*_REFERRALS, _UNIQUE_CTE, *_HEADCOUNT, _FLAGGED)

# --- the whole chain, with a headcount that ends before the reference date ------------------------------

_RUN = (
    *_REFERRALS,
    _UNIQUE_CTE,
    f"headcount as ({duckdb_sql('headcount', RUN_MONTH_ENDS)})",
    _extended(AS_OF),
    _FLAGGED,
)
_DISCREPANCIES = """discrepancies as (
select r.job_requisition_id, cast(coalesce(r.positions_filled_hire_selected, 0) as integer) as jobreq_filled_count,
    coalesce(h.n, 0) as hires_count,
    abs(coalesce(r.positions_filled_hire_selected, 0) - coalesce(h.n, 0)) as discrepancy
from requisitions r left join (select job_requisition_id, count(*) as n from hires group by 1) h
    on r.job_requisition_id = h.job_requisition_id
where coalesce(r.positions_filled_hire_selected, 0) <> coalesce(h.n, 0))"""


def _check(check: str, column: str, test: str, source: str) -> str:
    return (
        f"select '{check}' as \"check\", '{column}' as \"column\", "
        f"count(*) filter (where {test}) as violations from {source}"
    )


def _checks(*rows: tuple[str, str, str, str]) -> str:
    return " union all ".join(_check(*r) for r in rows)


_NOTED = _with(_view("noted_orders"))
_NOTED_TEXT = ", ".join(
    f"cast({c} as varchar) as {c}"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "note")
)
_STARRED = "select * replace (o_orderstatus || '*' as o_orderstatus), "

ORACLES: dict[str, str] = {
    # sources
    "src_newest_drop": "select * replace (cast(ts as varchar) as ts) from events "
    "where cast(ts as date) = (select max(cast(ts as date)) from events)",
    "src_feed_date": "select cast(ts as date) as feed_date, count(*) as feed_rows, count(distinct user_id) as users "
    "from events group by 1",
    "src_report_preamble": "select cast(c_custkey as varchar) as customer_id, c_name as customer_name, "
    "c_mktsegment as segment, c_mktsegment as segment_1, cast(c_nationkey as varchar) as nation_key_primary, "
    "cast(c_acctbal as varchar) as balance from customer",
    "src_report_quoted": _NOTED + f"select {_NOTED_TEXT} from noted_orders",
    "src_report_select": "select c_name as name, cast(c_custkey as varchar) as id from customer",
    # sinks
    "sink_roundtrip": _NOTED + "select *, 'parquet' as sink from noted_orders union all select *, 'csv' as sink from noted_orders",
    "sink_refresh_date": "select cast(max(o_orderdate) as date) as refresh_date from orders",
    "sink_versioned": _NOTED + _STARRED + "cast(2 as bigint) as table_version from noted_orders",
    "sink_snapshot": _NOTED + _STARRED + "date '2000-01-15' as snapshot_date from noted_orders "
    "union all select *, date '2000-01-16' as snapshot_date from noted_orders",
    # schemas
    "schema_select_rename": _with(_view("fulfillment_report"))
    + "select job_requisition_id, position_id, employee_id, employee_name, business_process_reason, "
    "candidate_start_date, grade_proposed from fulfillment_report",
    "schema_align": _with(_view("requisition_report"))
    + "select try_cast(positions_filled_hire_selected as smallint) as positions_filled_hire_selected, "
    "job_requisition_id, cast(null as date) as closed_on, try_cast(mbps_teams as integer) as mbps_teams, "
    f"{_REQ_DATE} as target_hire_date from requisition_report",
    # functions
    "fn_parse_date_multi": _with(_view("application_report"))
    + "select candidate_id, added_date as added_text, target_hire_date as target_text, "
    f"{_common('added_date')} as added_date, {_common('target_hire_date')} as target_hire_date from application_report",
    "fn_parse_date_by_column": _with(_view("hires_report"))
    + f"select candidate_id, {_plain('added_date')} as added_date, {_plain('candidate_start_date')} as "
    f"candidate_start_date, {_stamped('job_application_date')} as job_application_date, "
    f"{_stamped('ready_for_hire_date')} as ready_for_hire_date, "
    f"{_parsed('offer_accepted_date', '%Y/%m/%d')} as offer_accepted_date from hires_report",
    "fn_parse_date_embedded": _with(_view("event_log"))
    + "select event_id, coalesce(cast(try_strptime(regexp_extract(stamp, "
    "'\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}'), '%Y-%m-%d %H:%M:%S') as date), "
    "cast(try_strptime(stamp, '%Y-%m-%d') as date)) as stamp_date from event_log",
    "fn_composite_ids": _with(_view("fulfillment_report"))
    + "select job_requisition_id || '_' || position_id as jrpos_id, job_requisition_id || '_' || employee_id as "
    f"jree_id, employee_id || '_' || strftime({_STARTED}, '%Y%m') as eehire_id, "
    f"employee_id || '_' || strftime({_STARTED}, '%Y-%m') as headcount_id from fulfillment_report",
    "fn_strip_id_suffix": _with(_view("prospect_report"))
    + "select referred_by as referred_by_text, trim(split_part(referred_by, '(', 1)) as referred_by "
    "from prospect_report",
    "fn_recruiter_id": _with(_view("hires_report"))
    + "select recruiter_completed_offer, coalesce(nullif(regexp_extract(recruiter_completed_offer, "
    "'\\((\\d+)\\)', 1), ''), recruiter_employee_id) as rfh_recruiter_id from hires_report",
    "fn_digits_sentinel": _with(_view("application_report"))
    + "select recruiter_completed_offer, case when regexp_replace(recruiter_completed_offer, '\\D+', '', 'g') = '' "
    "then 'zzz_blank' else regexp_replace(recruiter_completed_offer, '\\D+', '', 'g') end as "
    "recruiter_completed_offer_id from application_report",
    # requisitions
    "req_clean": _with(*_REQUISITIONS) + "select * from requisitions",
    "req_clean_late": _with(*_REQUISITIONS) + "select * from requisitions",
    "late_latest": f"""select * exclude (n) replace (cast(l_shipdate as date) as l_shipdate)
from (select *, row_number() over (partition by l_partkey order by {_desc(
        "l_shipdate", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")}) as n from lineitem) where n = 1""",
    "req_status_counts": _with(*_REQUISITIONS)
    + "select jobreq_status, count(*) as requisitions from requisitions group by jobreq_status",
    # hires
    "hire_incoming": _with(*_INCOMING) + "select * from incoming",
    "hire_upsert": _with(*_INCOMING, _view("master_hires"), _MERGED) + "select * from hires",
    "hire_new_rows": _with(*_INCOMING, _view("master_hires")) + _NEW_SQL,
    "hire_discrepancy": _with(*_REQUISITIONS, *_INCOMING, _view("master_hires"), _MERGED, _DISCREPANCIES)
    + "select * from discrepancies",
    # applications
    "app_clean": _with(*_APPLICATIONS) + "select * from applications",
    "app_rescind": _with(_view("application_report"), _APP_TYPED)
    + "select candidate_id, last_recruiting_stage_orig, last_recruiting_stage, disposition_reason_orig, "
    "disposition_reason from app_corrected",
    "app_offer_accepts": _with(*_APPLICATIONS)
    + "select * from applications where candidate_recruiting_status = 'Offer Accepted'",
    "app_funnel": _with(*_FUNNEL) + "select * exclude (referred_by_employee_id, referred_by) from funnel",
    # referrals
    "ref_source_filter": _with(*_FUNNEL) + f"select * from {_REFERRED}",
    "ref_normalise": _with(_view("prospect_report"), _PROSPECTS) + _normalised("0", "", "prospects"),
    "ref_funnel": _with(*_REFERRALS) + "select * from referrals",
    "ref_unique": _with(*_REFERRALS, _UNIQUE_CTE) + "select * from unique_referrals",
    "ref_counts": _with(*_REFERRALS)
    + "select case origin when 0 then 'funnel' when 1 then 'prospect' else 'review' end as origin, "
    "count(*) as referral_rows from referral_rows group by 1",
    # headcount
    "hc_extend": _with(*_HEADCOUNT) + "select * from extended",
    "hc_referral_flag": _with(*_FLAGS) + "select * from flagged",
    # quality
    "dq_nulls": _with(_view("requisition_report"), *_APPLICATIONS, *_INCOMING)
    + _checks(
        ("not_null", "positions_filled_hire_selected", "try_cast(positions_filled_hire_selected as smallint) is null",
         "requisition_report"),
        ("not_null", "target_hire_date", f"{_REQ_DATE} is null", "requisition_report"),
        ("not_null", "disposition_reason", "disposition_reason is null", "applications"),
        ("not_null", "last_stage_number", "last_stage_number is null", "applications"),
        ("not_null", "jrpos_id", "jrpos_id is null", "incoming"),
        ("not_null", "eehire_id", "eehire_id is null", "incoming"),
        ("not_null", "candidate_id", "candidate_id is null", "incoming"),
    ),
    "dq_domain": _with(_view("application_report"), _view("flawed_applications"))
    + _checks(
        ("in_domain", "compensation_grade", "not regexp_matches(compensation_grade, '^Level [1-8]$')", "application_report"),
        ("in_domain", "last_recruiting_stage", "last_recruiting_stage = 'Unheard Of'", "application_report"),
        ("in_domain", "stage_number", "stage_number not in (1, 2, 3, 4, 6, 7, 8)", "flawed_applications"),
        ("in_domain", "candidate_recruiting_status", "candidate_recruiting_status not in ('Passed', 'Rejected')",
         "flawed_applications"),
    ),
    "dq_duplicates": _with(_view("requisition_report"), _view("fulfillment_report"), _view("prospect_report"))
    + " union all ".join(
        f"select 'unique' as \"check\", '{', '.join(keys)}' as \"column\", coalesce(sum(n), 0)::bigint as violations "
        f"from (select count(*) as n from {source} group by {', '.join(keys)} having count(*) > 1)"
        for source, keys in (
            ("requisition_report", ["job_requisition_id"]),
            ("fulfillment_report", ["employee_id", "candidate_start_date"]),
            ("prospect_report", ["candidate_id"]),
        )
    ),
    "dq_duplicated_rows": _with(_view("fulfillment_report"))
    + "select * exclude (n) from (select *, count(*) over (partition by employee_id, grade_proposed) as n "
    "from fulfillment_report) where n > 1",
    "dq_rules": _with(*(_view(f"flawed_{t}") for t in ("requisitions", "applications", "referrals", "headcount")))
    + _checks(
        ("cancelled_requests_nothing", "positions_requested_new",
         "jobreq_status = 'CAN' and positions_requested_new <> 0", "flawed_requisitions"),
        ("open_has_openings", "positions_openings_available",
         "jobreq_status = 'OPEN' and positions_openings_available <= 0", "flawed_requisitions"),
        ("filled_has_no_openings", "positions_openings_available",
         "jobreq_status = 'FILLED' and positions_openings_available <> 0", "flawed_requisitions"),
        ("in_range", "positions_requested_new", "positions_requested_new < 0", "flawed_requisitions"),
        ("in_range", "last_stage_number", "last_stage_number < 1 or last_stage_number > 8", "flawed_applications"),
        ("not_after", "job_application_date", f"job_application_date > date '{AS_OF}'", "flawed_applications"),
        ("in_range", "last_stage_number", "last_stage_number < 0", "flawed_referrals"),
        ("not_after", "added_date", f"added_date > date '{HEADCOUNT_AS_OF}'", "flawed_referrals"),
        ("matches", "headcount_id", "not regexp_matches(headcount_id, '^.+_\\d{4}-\\d{2}$')", "flawed_headcount"),
        ("matches", "job_grade", "not regexp_matches(job_grade, '^Level [1-9]')", "flawed_headcount"),
    ),
    "dq_counted": _with(_view("flawed_applications"))
    + _checks(
        ("in_domain", "candidate_recruiting_status", "candidate_recruiting_status not in ('Passed', 'Rejected')", "flawed_applications"),
        ("in_range", "last_stage_number", "last_stage_number < 1 or last_stage_number > 8", "flawed_applications"),
        ("not_after", "job_application_date", f"job_application_date > date '{AS_OF}'", "flawed_applications"),
    ),
    # joins
    "join_hot_key": """with acted as (
select case when event_id % 3 = 0 then 7 when event_id % 11 = 0 then null else user_id end as user_id, event_id, event_type,
    value, props, cast(ts as varchar) as ts from events),
customers as (select case when c_custkey % 13 = 0 then null else c_custkey end as user_id, c_name from customer)
select c.user_id, c_name, event_id, event_type, value, props, ts from customers c left join acted a on c.user_id = a.user_id""",
    # the whole chain
    "last_stage": _with(*_RUN) + "select * from flagged",
    "all_stages": _with(*_REQUISITIONS, *_INCOMING, _view("master_hires"), _MERGED, _DISCREPANCIES, *_RUN)
    + " union all ".join(
        f"select '{name}' as table_name, count(*) as table_rows from {source}"
        for name, source in (
            ("requisitions", "requisitions"),
            ("hires", "hires"),
            ("hire_discrepancies", "discrepancies"),
            ("applications", "applications"),
            ("offer_accepts", "applications where candidate_recruiting_status = 'Offer Accepted'"),
            ("funnel", "funnel"),
            ("referrals", "referrals"),
            ("headcount", "flagged"),
        )
    ),
}

_RUN_TABLES = _with(*_REQUISITIONS, *_INCOMING, _view("master_hires"), _MERGED, _DISCREPANCIES, *_RUN)
ORACLES |= {
    f"stage_{name}": f"{_RUN_TABLES}select * from {source}"
    for name, source in {
        "requisitions": "requisitions",
        "hires": "hires",
        "hire_discrepancies": "discrepancies",
        "applications": "applications",
        "offer_accepts": "applications where candidate_recruiting_status = 'Offer Accepted'",
        "funnel": "funnel",
        "referrals": "referrals",
        "headcount": "flagged",
        "applications_csv": "applications",
        "snapshot": "flagged",
        "raw_snapshot": "requisition_report",
    }.items()
}
ORACLES["dq_run"] = _RUN_TABLES + " union all ".join(
    f"select '{table}' as \"table\", * from ({_check(check, column, violated, source)})"
    for table, source, check, column, violated in (
        ("requisitions", "requisitions", "not_null", "job_requisition_id", "job_requisition_id is null"),
        ("requisitions", "requisitions", "not_null", "target_hire_date", "target_hire_date is null"),
        ("requisitions", "requisitions", "cancelled_requests_nothing", "positions_requested_new",
         "jobreq_status = 'CAN' and positions_requested_new <> 0"),
        ("requisitions", "requisitions", "open_has_openings", "positions_openings_available",
         "jobreq_status = 'OPEN' and positions_openings_available <= 0"),
        ("requisitions", "requisitions", "filled_has_no_openings", "positions_openings_available",
         "jobreq_status = 'FILLED' and positions_openings_available <> 0"),
        ("requisitions", "requisitions", "in_range", "positions_requested_new", "positions_requested_new < 0"),
        ("hires", "hires", "not_null", "jrpos_id", "jrpos_id is null"),
        ("hires", "hires", "not_null", "eehire_id", "eehire_id is null"),
        ("hires", "hires", "not_null", "candidate_id", "candidate_id is null"),
        ("applications", "applications", "not_null", "disposition_reason", "disposition_reason is null"),
        ("applications", "applications", "not_null", "last_stage_number", "last_stage_number is null"),
        ("applications", "applications", "in_domain", "compensation_grade",
         "not regexp_matches(compensation_grade, '^Level [1-8]$')"),
        ("applications", "applications", "in_range", "last_stage_number", "last_stage_number < 1 or last_stage_number > 8"),
        ("applications", "applications", "not_after", "job_application_date", f"job_application_date > date '{AS_OF}'"),
        ("funnel", "funnel", "in_domain", "stage_number", "stage_number not in (1, 2, 3, 4, 6, 7, 8)"),
        ("referrals", "referrals", "in_range", "last_stage_number", "last_stage_number < 0"),
        ("referrals", "referrals", "not_after", "added_date", f"added_date > date '{AS_OF}'"),
        ("headcount", "flagged", "matches", "headcount_id", "not regexp_matches(headcount_id, '^.+_\\d{4}-\\d{2}$')"),
        ("headcount", "flagged", "matches", "job_grade", "not regexp_matches(job_grade, '^Level [1-9]')"),
    )
)
ORACLES["dq_run_rows"] = _RUN_TABLES + " union all ".join(
    f"select '{table}' as \"table\", cast({column} as varchar) as value, count(*) as \"rows\" from {source} group by {column}"
    for table, column, source in (
        ("requisitions", "jobreq_status", "requisitions"),
        ("funnel", "stage", "funnel"),
        ("headcount", "has_referral", "flagged"),
    )
)
