"""The eight raw tables. Every raw column is text; an empty string is the missing value."""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names of the landing files.
RAW_COLUMNS: dict[str, list[str]] = {
    "employer_groups": [
        "group_id", "name", "industry", "city", "contract_start", "contract_end", "lives_covered",
        "monthly_premium_pkr",
    ],
    "policies": [
        "policy_id", "plan_name", "plan_tier", "annual_limit_pkr", "room_rent_cap_pkr", "deductible_pkr",
        "copay_pct", "maternity_covered", "pre_existing_waiting_months",
    ],
    "providers": [
        "provider_id", "hospital_name", "city", "provider_type", "network_status", "tier", "panel_since",
    ],
    "members": [
        "member_id", "masked_cnic", "name", "gender", "date_of_birth", "city", "employer_group_id", "policy_id",
        "enrolment_date", "termination_date", "relationship",
    ],
    "diagnoses": ["diagnosis_code", "description", "chapter"],
    "procedures": ["procedure_code", "description", "category", "typical_cost_pkr"],
    "claims_header": [
        "claim_id", "member_id", "provider_id", "policy_id", "claim_type", "admission_date", "discharge_date",
        "submission_date", "adjudication_date", "payment_date", "status", "denial_reason_code",
        "billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr", "member_share_pkr", "adjudication_mode",
    ],
    "claims_lines": [
        "claim_line_id", "claim_id", "line_no", "procedure_code", "diagnosis_code", "quantity", "unit_price_pkr",
        "line_billed_pkr", "line_approved_pkr",
    ],
}

RAW_TABLES = tuple(RAW_COLUMNS)

# The columns that hold numbers; money unless the name says otherwise.
NUMBER_COLUMNS: dict[str, list[str]] = {
    t: [c for c in columns if c.endswith("_pkr") or c in
        ("lives_covered", "copay_pct", "pre_existing_waiting_months", "line_no", "quantity")]
    for t, columns in RAW_COLUMNS.items()
}

# Code domains.
CLAIM_STATUSES = ("Paid", "Partially Paid", "Denied", "Pending", "In Review")
OPEN_STATUSES = ("Pending", "In Review")
CLAIM_TYPES = ("Inpatient", "Outpatient", "Daycare", "Pharmacy", "Diagnostic", "Maternity", "Emergency")
STAY_TYPES = ("Inpatient", "Maternity", "Emergency")
ADJUDICATION_MODES = ("Auto", "Manual")
GENDERS = ("Male", "Female")
RELATIONSHIPS = ("Self", "Spouse", "Child")
NETWORKS = ("In-Network", "Out-of-Network")
PROVIDER_TYPES = ("Hospital", "Clinic", "Diagnostic", "Pharmacy")
PLAN_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
FUNNEL_ORDER = ("In Review", "Pending", "Partially Paid", "Denied", "Paid")

# The reporting window and the calendar around it.
WINDOW_END = "2026-06-30"
WINDOW_MONTHS = 24
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2027-12-31"
MAX_AGE = 120


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])
