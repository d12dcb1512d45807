"""Names, codes and patterns that come from the recruiting exports themselves.

Everything in this module is a FIXED VALUE: report headers, stage codes, sentinels, table layouts and
preamble lengths have to be exactly these for the results to be right. Nothing here is logic.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
}


def layout(**columns: str) -> T.StructType:
    """A nullable table layout from ``name="type"`` pairs, in the order given."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# --- fixed values: preamble lines above the header line of each report -------------------------------

REQUISITION_PREAMBLE = 13
FULFILLMENT_PREAMBLE = 7
HIRES_PREAMBLE = 10
APPLICATION_PREAMBLE = 16
PROSPECT_PREAMBLE = 0
HEADCOUNT_PREAMBLE = 1

# --- fixed values: names of the exports, without the ending of the file type ---------------------------

REQUISITION_DROPS = "MBPS Requisition - All Status*"
FULFILLMENT_DROPS = "*Fulfillment*"
HIRES_DROPS = "Recruiting - Internal and External Hires*"
APPLICATION_DROPS = "MBPS Daily Application_2*"
PROSPECT_DROPS = "Referrals Without Job Applications*"
HEADCOUNT_DROPS = "pmd_monthly_headcount*"

# --- fixed values: report header -> column name ------------------------------------------------------

FULFILLMENT_NAMES = {
    "Job Requisition ID": "job_requisition_id",
    "Position ID - Proposed": "position_id",
    "Employee ID": "employee_id",
    "Legal Name": "employee_name",
    "Business Process Reason": "business_process_reason",
    "Effective Date": "candidate_start_date",
    "Grade - Proposed": "grade_proposed",
}

HIRES_NAMES = {
    "Candidate ID": "candidate_id",
    "Employee ID": "employee_id",
    "Added Date": "added_date",
    "Recruiting Start Date": "recruiting_start_date",
    "Job Application Date": "job_application_date",
    "Ready for Hire Date": "ready_for_hire_date",
    "Candidate Start Date": "candidate_start_date",
    "Recruiter Completed Offer": "recruiter_completed_offer",
    "Recruiter Employee ID": "recruiter_employee_id",
    "Referred By Employee ID": "referred_by_employee_id",
    "Source": "source",
    "Recruiting Agency": "recruiting_agency",
    "Date Completed (Offer)": "offer_accepted_date",
    "Job Requisition Unfreeze Date": "jr_unfreeze_date",
    "Total Number of Days Frozen": "days_frozen",
}

APPLICATION_NAMES = {
    "Candidate ID": "candidate_id",
    "Candidate Name": "candidate_name",
    "Job Requisition ID": "job_requisition_id",
    "Job Requisition": "job_requisition",
    "Recruiting Instruction": "recruiting_instruction",
    "Job Family": "job_family",
    "Compensation Grade": "compensation_grade",
    "Worker Type Hiring Requirement": "worker_type_hiring_requirement",
    "Worker Sub-Type Hiring Requirement": "worker_sub_type_hiring_requirement",
    "Target Hire Date": "target_hire_date",
    "Added Date": "added_date",
    "Job Application Date": "job_application_date",
    "Offer Accepted Date": "offer_accepted_date",
    "Candidate Start Date": "candidate_start_date",
    "Recruiter Employee ID": "recruiter_employee_id",
    "Recruiter Completed Offer": "recruiter_completed_offer",
    "Disposition Reason": "disposition_reason",
    "Candidate Recruiting Status": "candidate_recruiting_status",
    "Last Recruiting Stage": "last_recruiting_stage",
    "Hired": "hired",
    "Hire Transaction Status": "hire_transaction_status",
    "Source": "source",
    "Referred By Employee ID": "referred_by_employee_id",
    "Referred By": "referred_by",
    "Recruiting Agency": "recruiting_agency",
    "Last Employer": "last_employer",
    "School Name": "school_name",
    "Is cancelled?": "is_cancelled",
    "MBPS Teams": "mbps_teams",
}

PROSPECT_NAMES = {
    "Candidate ID": "candidate_id",
    "Job Requisition ID": "job_requisition_id",
    "Referred By Employee ID": "referred_by_employee_id",
    "Referred By": "referred_by",
    "Added Date": "added_date",
    "Source": "source",
    "Disposition Reason": "disposition_reason",
    "Candidate Recruiting Status": "candidate_recruiting_status",
}

HEADCOUNT_NAMES = {
    "Masterfile[Reporting Date]": "reporting_date",
    "Masterfile[Location]": "location",
    "Masterfile[Function]": "function",
    "Masterfile[Sub-function]": "sub_function",
    "Masterfile[Job Grade]": "job_grade",
    "Masterfile[Employee ID]": "employee_id",
}

# --- fixed values: table layouts ---------------------------------------------------------------------

REQUISITION_INPUT = layout(
    job_requisition_id="string",
    target_hire_date="date",
    positions_filled_hire_selected="short",
    positions_openings_available="short",
    mbps_teams="string",
)

REQUISITIONS = T.StructType(
    REQUISITION_INPUT.fields + layout(positions_requested_new="short", jobreq_status="string").fields
)

MASTER_HIRES = layout(
    jrpos_id="string",
    jree_id="string",
    eehire_id="string",
    job_requisition_id="string",
    employee_id="string",
    candidate_id="string",
    employee_name="string",
    position_id="string",
    business_process_reason="string",
    recruiting_start_date="date",
    added_date="date",
    job_application_date="date",
    ready_for_hire_date="date",
    candidate_start_date="date",
    is_hire_on_time_exception="string",
    jr_unfreeze_date="date",
    offer_accepted_date="date",
    days_frozen="string",
    rfh_recruiter_id="string",
    rfh_recruiter_id_exception="string",
    recruiter_completed_offer="string",
    source="string",
    source_exception="string",
    recruiting_agency="string",
    referred_by_employee_id="string",
    remarks="string",
    termination_date="date",
    termination_reason="string",
    termination_reason_category="string",
    termination_tenure_days_bucket="int",
)

DECLARED_FILLED = layout(
    job_requisition_id="string",
    target_hire_date="date",
    positions_filled_hire_selected="int",
)

REFERRALS = layout(
    candidate_id="string",
    job_requisition_id="string",
    referred_by_employee_id="string",
    referred_by="string",
    added_date="date",
    source="string",
    disposition_reason="string",
    candidate_recruiting_status="string",
    last_stage_number="short",
)

APPLICATION_COLUMNS = [
    *APPLICATION_NAMES.values(),
    "last_recruiting_stage_orig",
    "candidate_recruiting_status_orig",
    "disposition_reason_orig",
    "recruiter_completed_offer_id",
    "last_stage_number",
]

FUNNEL_INPUT = [
    "candidate_id",
    "added_date",
    "job_application_date",
    "job_requisition_id",
    "recruiting_agency",
    "source",
    "disposition_reason",
    "candidate_recruiting_status",
    "last_stage_number",
]

FUNNEL_COLUMNS = [
    "job_requisition_id",
    "candidate_id",
    "added_date",
    "job_application_date",
    "last_stage_number",
    "stage_number",
    "stage",
    "candidate_recruiting_status",
    "recruiting_agency",
    "source",
    "disposition_reason",
]

# --- fixed values: codes, sentinels and patterns -----------------------------------------------------

STAGES = {
    "Review": 1,
    "Screen": 2,
    "Assessment": 3,
    "Interview": 4,
    "Reference Check": 5,
    "Offer": 6,
    "Background Check": 7,
    "Ready for Hire": 8,
}
MERGED_STAGES = {5: 4}
PROSPECT_STAGE = 0
REVIEW_STAGE = 1

APPLICATION_DATES = [
    "added_date",
    "job_application_date",
    "offer_accepted_date",
    "candidate_start_date",
    "target_hire_date",
]

GRADES_IN_SCOPE = [f"Level {n}" for n in range(1, 9)]
GRADES_OUT_OF_SCOPE = ["Level 9", "Level 10"]

REQUISITION_SCOPE_YEARS = 3
APPLICATION_SCOPE_YEARS = 4
HIRE_SCOPE_MONTHS = 3

REFERRAL_SOURCE = "(?i)ERP|Referral"
FEED_DATE = r"\d{4}-\d{2}-\d{2}"
UNKNOWN_SOURCE = "zzz_unknown"
BLANK_RECRUITER = "zzz_blank"
IN_PROCESS = "application in process"
PASSED = "Passed"
OFFER_ACCEPTED = "Offer Accepted"
RESCINDED = "Rescinded"
RESCINDED_OFFER = "Offer Accepted to Rescinded"
OVERRIDE_SUFFIX = "_exception"
