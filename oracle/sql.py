"""DuckDB SQL per registered query. Ratios are rounded to six digits, money is a double after an
exact decimal sum, arrays are joined text."""

from __future__ import annotations

import re

from oracle.tables import pdate, with_tables, ymd

OPEN = "status IN ('Pending', 'In Review')"
STAYS = "claim_type IN ('Inpatient', 'Maternity', 'Emergency')"
TAT = "tat_submit_to_adjudicate"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def total(c: str, where: str = "") -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(sum({c}){f} AS DOUBLE)"


def share(a: str, b: str) -> str:
    """a / b to six digits, NULL over zero."""
    return f"round({dbl(a)} / nullif({dbl(b)}, 0), 6)"


def mean(c: str, where: str = "") -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return f"round(CAST(sum({c}){f} AS DOUBLE) / nullif(count({c}){f}, 0), 6)"


def money(cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols.split())


def n_rows(table: str, label: str | None = None) -> str:
    return f"SELECT '{label or table}' AS table_name, count(*) AS row_count FROM {table}"


RAW_OF = {
    "employer_groups": "raw_groups", "policies": "raw_policies", "providers": "raw_providers", "members": "raw_members",
    "diagnoses": "raw_diagnoses", "procedures": "raw_procedures", "claims_header": "raw_headers", "claims_lines": "raw_lines",
}
MART_OF = {
    "dim_date": "cal", "dim_member": "d_member", "dim_provider": "d_provider", "dim_employer_group": "d_group",
    "dim_policy": "d_policy", "dim_diagnosis": "d_diagnosis", "dim_procedure": "d_procedure",
    "fct_claim_header": "f_header", "fct_claim_line": "f_line", "fct_monthly_member_summary": "f_month",
}

# -- data quality: one SELECT of failing keys per rule, in catalogue order ---------------------
_n = "TRY_CAST(NULLIF({}, '') AS DECIMAL(18,2))".format
_d = pdate
_tidy = "(upper(trim(city, ' ')[1]) || lower(trim(city, ' ')[2:]))"

# Id, name, dimension, severity, table, column; then the key and the failing condition.
ROW_RULES = [
    ("C-HDR-ADJMODE", "adjudication_mode = ''"),
    ("C-HDR-CLAIMID", "claim_id = ''"),
    ("C-HDR-MEMBERID", "member_id = ''"),
    ("C-HDR-PROVIDERID", "provider_id = ''"),
    ("C-LINE-CLAIMID", "claim_id = ''"),
    ("C-MBR-DOB", "date_of_birth = ''"),
    ("C-MBR-POLICY", "policy_id = ''"),
    ("V-HDR-STATUS", "NOT list_contains(['Paid', 'Denied', 'Pending', 'Partially Paid', 'In Review'], status)"),
    ("V-HDR-CTYPE", "NOT list_contains(['Inpatient', 'Outpatient', 'Daycare', 'Pharmacy', 'Diagnostic', 'Maternity', "
                    "'Emergency'], claim_type)"),
    ("V-HDR-ADJMODE", "adjudication_mode NOT IN ('', 'Auto', 'Manual')"),
    ("V-MBR-GENDER", "NOT list_contains(['Male', 'Female'], gender)"),
    ("V-MBR-REL", "NOT list_contains(['Self', 'Spouse', 'Child'], relationship)"),
    ("V-PRV-NETWORK", "NOT list_contains(['In-Network', 'Out-of-Network'], network_status)"),
    ("V-PRV-TYPE", "NOT list_contains(['Hospital', 'Clinic', 'Diagnostic', 'Pharmacy'], provider_type)"),
    ("V-POL-TIER", "NOT list_contains(['Bronze', 'Silver', 'Gold', 'Platinum'], plan_tier)"),
    ("V-POL-COPAY", f"{_n('copay_pct')} NOT BETWEEN 0 AND 1"),
    ("V-HDR-DATEPARSE", f"submission_date <> '' AND ({_d('submission_date')}) IS NULL"),
    ("V-MBR-AGE", f"coalesce(date_diff('day', {_d('date_of_birth')}, DATE '2026-06-30') NOT BETWEEN 0 AND 43800, true)"),
    ("K-HDR-DISCHARGE", f"({_d('discharge_date')}) < ({_d('admission_date')})"),
    ("K-HDR-SUBMIT", f"({_d('submission_date')}) < ({_d('discharge_date')})"),
    ("K-MBR-CITY", f"city <> {_tidy}"),
    ("K-PRV-CITY", f"city <> {_tidy}"),
    ("K-GRP-CITY", f"city <> {_tidy}"),
    ("K-HDR-DENIAL", "(status = 'Denied') = (denial_reason_code = '')"),
    ("A-HDR-APPR-BILLED", f"{_n('approved_amount_pkr')} > {_n('billed_amount_pkr')}"),
    ("A-HDR-PAID-APPR", f"{_n('paid_amount_pkr')} > {_n('approved_amount_pkr')}"),
    ("A-HDR-NONNEG", f"{_n('billed_amount_pkr')} <= 0"),
    ("A-LINE-MATH", f"abs({_n('unit_price_pkr')} * {_n('quantity')} - {_n('line_billed_pkr')}) > 1"),
    ("T-HDR-ADJ-LAG", f"date_diff('day', {_d('submission_date')}, {_d('adjudication_date')}) > 60"),
    ("T-HDR-PAYMENT", f"({_d('payment_date')}) < ({_d('adjudication_date')})"),
    ("T-HDR-SUBMIT-LAG", f"date_diff('day', {_d('discharge_date')}, {_d('submission_date')}) > 30"),
]
TABLE_OF_CODE = {"HDR": ("claims_header", "claim_id"), "LINE": ("claims_lines", "claim_line_id"),
                 "MBR": ("members", "member_id"), "PRV": ("providers", "provider_id"), "POL": ("policies", "policy_id"),
                 "GRP": ("employer_groups", "group_id")}
SET_RULES = {
    "U-HDR-CLAIMID": "SELECT claim_id FROM raw_headers GROUP BY 1 HAVING count(*) > 1",
    "U-LINE-ID": "SELECT claim_line_id FROM raw_lines GROUP BY 1 HAVING count(*) > 1",
    "U-MBR-ID": "SELECT member_id FROM raw_members GROUP BY 1 HAVING count(*) > 1",
    "U-PRV-ID": "SELECT provider_id FROM raw_providers GROUP BY 1 HAVING count(*) > 1",
    "U-HDR-BIZDUP": "SELECT claim_id FROM raw_headers QUALIFY row_number() OVER (PARTITION BY member_id, provider_id, "
                    "admission_date, billed_amount_pkr ORDER BY claim_id) > 1",
    "R-HDR-MEMBER-FK": "SELECT claim_id FROM raw_headers ANTI JOIN raw_members USING (member_id)",
    "R-HDR-PROVIDER-FK": "SELECT claim_id FROM raw_headers ANTI JOIN raw_providers USING (provider_id)",
    "R-LINE-CLAIM-FK": "SELECT claim_line_id FROM raw_lines ANTI JOIN raw_headers USING (claim_id)",
}


def table_of(rule: str) -> tuple[str, str]:
    return TABLE_OF_CODE[rule.split("-")[1]]


def failing_keys() -> str:
    parts = []
    for rule, cond in ROW_RULES:
        t, key = table_of(rule)
        parts.append(f"SELECT '{rule}' AS rule_id, '{t}' AS table_name, {key} AS record_key FROM {RAW_OF[t]} WHERE {cond}")
    for rule, sql in SET_RULES.items():
        t, key = table_of(rule)
        parts.append(f"SELECT '{rule}' AS rule_id, '{t}' AS table_name, {key} AS record_key FROM ({sql})")
    return " UNION ALL ".join(parts)


# Id, name, dimension, severity, column.
CATALOGUE = """
C-HDR-ADJMODE|Adjudication mode is populated|completeness|medium|adjudication_mode
C-HDR-CLAIMID|Claim id is present|completeness|critical|claim_id
C-HDR-MEMBERID|Member id is present on claim|completeness|critical|member_id
C-HDR-PROVIDERID|Provider id is present on claim|completeness|critical|provider_id
C-LINE-CLAIMID|Claim line references a claim|completeness|critical|claim_id
C-MBR-DOB|Member date of birth is present|completeness|high|date_of_birth
C-MBR-POLICY|Member policy id is present|completeness|high|policy_id
V-HDR-STATUS|Claim status is a known value|validity|high|status
V-HDR-CTYPE|Claim type is a known value|validity|high|claim_type
V-HDR-ADJMODE|Adjudication mode value is valid|validity|low|adjudication_mode
V-MBR-GENDER|Member gender is valid|validity|medium|gender
V-MBR-REL|Member relationship is valid|validity|low|relationship
V-PRV-NETWORK|Provider network status is valid|validity|medium|network_status
V-PRV-TYPE|Provider type is valid|validity|low|provider_type
V-POL-TIER|Plan tier is valid|validity|low|plan_tier
V-POL-COPAY|Copay percentage in range|validity|low|copay_pct
V-HDR-DATEPARSE|Submission date is parseable|validity|medium|submission_date
V-MBR-AGE|Member age is plausible|validity|high|date_of_birth
K-HDR-DISCHARGE|Discharge is not before admission|consistency|high|discharge_date
K-HDR-SUBMIT|Submission is not before discharge|consistency|medium|submission_date
K-MBR-CITY|Member city is canonical|consistency|low|city
K-PRV-CITY|Provider city is canonical|consistency|low|city
K-GRP-CITY|Employer city is canonical|consistency|low|city
K-HDR-DENIAL|Denial reason consistent with status|consistency|medium|denial_reason_code
U-HDR-CLAIMID|Claim id is unique|uniqueness|critical|claim_id
U-LINE-ID|Claim line id is unique|uniqueness|critical|claim_line_id
U-MBR-ID|Member id is unique|uniqueness|critical|member_id
U-PRV-ID|Provider id is unique|uniqueness|critical|provider_id
U-HDR-BIZDUP|No duplicate business claims|uniqueness|high|
A-HDR-APPR-BILLED|Approved not greater than billed|accuracy|high|approved_amount_pkr
A-HDR-PAID-APPR|Paid not greater than approved|accuracy|high|paid_amount_pkr
A-HDR-NONNEG|Billed amount is positive|accuracy|high|billed_amount_pkr
A-LINE-MATH|Line billed equals price x quantity|accuracy|low|line_billed_pkr
T-HDR-ADJ-LAG|Adjudication within SLA|timeliness|low|adjudication_date
T-HDR-PAYMENT|Payment after adjudication|timeliness|medium|payment_date
T-HDR-SUBMIT-LAG|Submission within filing limit|timeliness|low|submission_date
R-HDR-MEMBER-FK|Claim member exists|validity|high|member_id
R-HDR-PROVIDER-FK|Claim provider exists|validity|high|provider_id
R-LINE-CLAIM-FK|Claim line parent exists|validity|high|claim_id
"""


def rule_results() -> str:
    """CTEs ``bad``, ``sizes`` and ``res`` (one row per rule)."""
    rows = []
    for line in CATALOGUE.strip().splitlines():
        rid, name, dim, sev, col = line.split("|")
        rows.append(f"('{rid}', '{name}', '{dim}', '{sev}', '{table_of(rid)[0]}', {repr(col) if col else 'NULL'})")
    sizes = " UNION ALL ".join(n_rows(RAW_OF[t], t) for t in RAW_OF)
    return f"""
        bad AS ({failing_keys()}), sizes AS ({sizes}),
        res AS (SELECT rule_id, rule_name, dimension, severity, table_name, column_name, row_count AS rows_checked,
                       (SELECT count(*) FROM bad WHERE bad.rule_id = c.rule_id) AS rows_failed,
                       CASE severity WHEN 'critical' THEN 8 WHEN 'high' THEN 4 WHEN 'medium' THEN 2 ELSE 1 END AS w,
                       (SELECT count(*) FROM bad WHERE bad.rule_id = c.rule_id)::DOUBLE / row_count AS rate
                FROM (VALUES {', '.join(rows)}) c(rule_id, rule_name, dimension, severity, table_name, column_name)
                JOIN sizes USING (table_name))"""


def dirty_rules() -> str:
    """The rules over overlays of the raw tables, which spoil rows by the last digits of their keys."""
    def overlay(table: str, key: str, digits: int, defects: dict[str, dict[int, str]]) -> str:
        tail = f"TRY_CAST(right({key}, {digits}) AS INT)"
        each = (f"CASE {tail} {' '.join(f'WHEN {k} THEN {v}' for k, v in at.items())} ELSE {c} END AS {c}" for c, at in defects.items())
        return f"dirty_{table} AS (SELECT * REPLACE ({', '.join(each)}) FROM raw_{table})"

    tables = [
        overlay("headers", "claim_id", 3, {
            "claim_id": {601: "''", 613: "'CLM-same'"}, "member_id": {602: "''"}, "provider_id": {603: "''"},
            "status": {604: "'Lost'"}, "claim_type": {605: "'Spa'"}, "adjudication_mode": {606: "'Robot'"},
            "submission_date": {607: "'2025/13/45'", 608: "'2020-01-01'", 611: "'2031-01-01'"},
            "denial_reason_code": {609: "if(denial_reason_code = '', 'DR01', '')"},
            "adjudication_date": {610: "'2031-01-01'"}, "payment_date": {612: "'2020-01-01'"}}),
        overlay("lines", "claim_id", 3, {
            "claim_id": {701: "''", 702: "'CLM-none'"}, "line_billed_pkr": {703: "'0.01'"}, "claim_line_id": {704: "'LINE-same'"}}),
        overlay("members", "member_id", 2, {
            "date_of_birth": {31: "''"}, "policy_id": {32: "''"}, "gender": {33: "'X'"}, "relationship": {34: "'Cousin'"},
            "member_id": {35: "'MB-same'", 36: "'MB-same'"}}),
        overlay("providers", "provider_id", 1, {
            "network_status": {3: "'Maybe'"}, "provider_type": {4: "'Spa'"}, "provider_id": {5: "'PR-same'", 6: "'PR-same'"}}),
        overlay("policies", "policy_id", 2, {"plan_tier": {7: "'Tin'"}, "copay_pct": {8: "'1.5'"}}),
    ]
    bad = failing_keys()
    for t in ("headers", "lines", "members", "providers", "policies"):
        bad = bad.replace(f"raw_{t}", f"dirty_{t}")
    rules = ", ".join(f"('{x.split('|')[0]}', '{x.split('|')[3]}')" for x in CATALOGUE.strip().splitlines())
    return f"""WITH {', '.join(tables)}, bad AS ({bad})
        SELECT c.rule_id, (SELECT count(*) FROM bad WHERE bad.rule_id = c.rule_id) AS rows_failed,
               severity = 'critical' AND EXISTS (SELECT 1 FROM bad WHERE bad.rule_id = c.rule_id) AS stops
        FROM (VALUES {rules}) c(rule_id, severity)"""


def dq(body: str) -> str:
    return f"WITH {rule_results()} {body}"


RESULT_ROW = ("rule_id, rule_name, dimension, severity, table_name, column_name, rows_checked, rows_failed, "
              "round(rate, 6) AS fail_rate, 0.0::DOUBLE AS threshold, rows_failed = 0 AS passed")
SCORE = "100 * sum(w * (1 - rate)) / sum(w)"


# -- warehouse assertions ------------------------------------------------------------------------
STAGED_OF = {
    "stg_employer_groups": "st_groups", "stg_policies": "st_policies", "stg_providers": "st_providers",
    "stg_members": "st_members", "stg_diagnoses": "raw_diagnoses", "stg_procedures": "st_procedures",
    "stg_claims_header": "st_headers", "stg_claims_lines": "st_lines",
}
# Columns of the raw claim headers.
HEADER_COLUMNS = """claim_id member_id provider_id policy_id claim_type admission_date discharge_date submission_date
    adjudication_date payment_date status denial_reason_code billed_amount_pkr approved_amount_pkr paid_amount_pkr
    member_share_pkr adjudication_mode""".split()
MODEL_SQL = {
    **STAGED_OF, **MART_OF,
    "dim_claim_status": "(SELECT s AS status, md5(s) AS claim_status_sk FROM (VALUES ('Paid'), ('Partially Paid'), ('Denied'), "
                        "('Pending'), ('In Review')) v(s))",
    "dim_claim_type": "(SELECT s AS claim_type, md5(s) AS claim_type_sk FROM (VALUES ('Inpatient'), ('Daycare'), ('Maternity'), "
                      "('Emergency'), ('Outpatient'), ('Diagnostic'), ('Pharmacy')) v(s))",
}
STATUSES = "'Paid', 'Partially Paid', 'Denied', 'Pending', 'In Review'"
TYPES = "'Inpatient', 'Outpatient', 'Daycare', 'Pharmacy', 'Diagnostic', 'Maternity', 'Emergency'"
# model: unique columns; not-null columns
UNIQUE_AND_PRESENT = """
stg_employer_groups: group_id; group_id
stg_policies: policy_id; policy_id
stg_providers: provider_id; provider_id
stg_members: member_id; member_id
stg_diagnoses: diagnosis_code; diagnosis_code
stg_procedures: procedure_code; procedure_code
stg_claims_header: ; claim_id
stg_claims_lines: ; claim_line_id
dim_date: date_key; date_key date_day fiscal_year
dim_member: member_sk; member_sk member_id is_current
dim_provider: provider_sk; provider_sk provider_id
dim_employer_group: employer_group_sk group_id; employer_group_sk group_id
dim_policy: policy_sk policy_id; policy_sk policy_id
dim_diagnosis: diagnosis_sk diagnosis_code; diagnosis_sk diagnosis_code
dim_procedure: procedure_sk procedure_code; procedure_sk procedure_code
dim_claim_status: claim_status_sk status; claim_status_sk
dim_claim_type: claim_type_sk claim_type; claim_type_sk
fct_claim_header: claim_sk claim_id; claim_sk claim_id member_sk provider_sk adjudication_mode
fct_claim_line: claim_line_sk claim_line_id; claim_line_sk claim_line_id claim_id
fct_monthly_member_summary: member_month_sk; member_month_sk member_sk
"""
ALLOWED = [
    ("dim_member", "gender", "'Male', 'Female'"), ("dim_member", "relationship", "'Self', 'Spouse', 'Child'"),
    ("dim_provider", "network_status", "'In-Network', 'Out-of-Network'"),
    ("dim_provider", "provider_type", "'Hospital', 'Clinic', 'Diagnostic', 'Pharmacy'"),
    ("dim_policy", "plan_tier", "'Bronze', 'Silver', 'Gold', 'Platinum'"),
    ("dim_claim_status", "status", STATUSES), ("dim_claim_type", "claim_type", TYPES),
    ("fct_claim_header", "status", STATUSES), ("fct_claim_header", "claim_type", TYPES),
    ("fct_claim_header", "adjudication_mode", "'Auto', 'Manual'"),
]
POINTS_TO = [
    ("dim_member", "policy_id", "dim_policy"), ("fct_claim_header", "member_sk", "dim_member"),
    ("fct_claim_header", "provider_sk", "dim_provider"), ("fct_claim_header", "policy_sk", "dim_policy"),
    ("fct_claim_line", "claim_id", "fct_claim_header"), ("fct_claim_line", "procedure_sk", "dim_procedure"),
    ("fct_claim_line", "diagnosis_sk", "dim_diagnosis"), ("fct_monthly_member_summary", "member_sk", "dim_member"),
]


def assertions() -> str:
    out = []

    def add(name: str, model: str, kind: str, col: str, count_sql: str) -> None:
        out.append(f"SELECT '{name}' AS assertion, '{model}' AS model, '{kind}' AS kind, '{col}' AS column_name, "
                   f"({count_sql}) AS failures")

    for line in UNIQUE_AND_PRESENT.strip().splitlines():
        model, rest = line.split(":")
        uniq, present = (x.split() for x in rest.split(";"))
        src = MODEL_SQL[model]
        for c in uniq:
            add(f"unique_{model}_{c}", model, "unique", c,
                f"SELECT count(*) FROM (SELECT {c} FROM {src} t WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for c in present:
            add(f"not_null_{model}_{c}", model, "not_null", c, f"SELECT count(*) - count({c}) FROM {src} t")
    for model, c, values in ALLOWED:
        add(f"accepted_values_{model}_{c}", model, "accepted_values", c,
            f"SELECT count(*) FROM {MODEL_SQL[model]} t WHERE {c} NOT IN ({values})")
    for model, c, parent in POINTS_TO:
        add(f"relationships_{model}_{c}", model, "relationships", c,
            f"SELECT count({c}) FROM {MODEL_SQL[model]} t ANTI JOIN {MODEL_SQL[parent]} p USING ({c})")
    h, m = "fct_claim_header", "fct_monthly_member_summary"
    add("approved_le_billed", h, "business", "", "SELECT count_if(approved_amount_pkr > billed_amount_pkr) FROM f_header")
    add("paid_le_approved", h, "business", "", "SELECT count_if(paid_amount_pkr > approved_amount_pkr) FROM f_header")
    add("discharge_ge_admission", h, "business", "", "SELECT count_if(length_of_stay < 0) FROM f_header")
    add("no_negative_amounts", h, "business", "",
        "SELECT count_if(least(billed_amount_pkr, approved_amount_pkr, paid_amount_pkr, member_share_pkr) < 0) FROM f_header")
    add("no_impossible_ages", "dim_member", "business", "",
        "SELECT count_if(age_years NOT BETWEEN 0 AND 120 OR date_of_birth > DATE '2026-06-30') FROM d_member")
    add("member_months_positive", m, "business", "",
        "SELECT count_if(claim_count < 1 OR least(billed_amount_pkr, paid_amount_pkr) < 0) FROM f_month")
    add("no_duplicate_business_claims", h, "business", "",
        "SELECT count(*) FROM (SELECT 1 FROM f_header GROUP BY member_sk, provider_sk, admission_date_key, billed_amount_pkr "
        "HAVING count(*) > 1)")
    add("lines_have_header", "fct_claim_line", "business", "", "SELECT count(*) FROM f_line ANTI JOIN f_header USING (claim_id)")
    add("fct_reconciles_staging", h, "business", "",
        "SELECT ((SELECT count(*) FROM f_header) > (SELECT count(*) FROM st_headers))::INTEGER")
    return " UNION ALL ".join(out)


def planted_assertions() -> str:
    """The assertions over marts of which rows are spoilt by the last two letters of their keys, or doubled."""
    def overlay(name: str, source: str, key: str, changes: dict[str, dict[str, str]], twice: str) -> str:
        each = []
        for c, at in changes.items():
            cases = " ".join(f"WHEN '{end}' THEN {v}" for end, v in at.items())
            each.append(f"CASE right({key}::VARCHAR, 2) {cases} ELSE {c} END AS {c}")
        spoilt = f"SELECT * REPLACE ({', '.join(each)}) FROM {source} o"
        again = f" UNION ALL {spoilt} WHERE right(o.{key}::VARCHAR, 2) = '{twice}'" if twice else ""
        return f"{name} AS ({spoilt}{again})"

    spoilt = {
        "f_header": ("b_header", "claim_id", {
            "member_sk": {"02": "'nobody'"}, "provider_sk": {"03": "NULL"}, "status": {"04": "'Lost'"},
            "approved_amount_pkr": {"05": "billed_amount_pkr + 1"}, "paid_amount_pkr": {"06": "approved_amount_pkr + 1"},
            "length_of_stay": {"07": "-1"}, "member_share_pkr": {"32": "-1"}, "adjudication_mode": {"33": "NULL"},
            "claim_type": {"34": "'Spa'"}, "policy_sk": {"35": "'none'"}}, "36"),
        "f_line": ("b_line", "claim_line_id", {
            "claim_id": {"01": "'none'", "02": "NULL"}, "procedure_sk": {"03": "'none'"}}, "04"),
        "f_month": ("b_month", "member_id", {"claim_count": {"07": "0"}, "member_sk": {"08": "'nobody'"}}, "10"),
        "d_member": ("b_member", "member_id", {
            "age_years": {"11": "200"}, "gender": {"13": "'X'"}, "relationship": {"14": "'Cousin'"}, "policy_id": {"16": "'none'"},
            "is_current": {"17": "NULL"}}, "19"),
        "d_provider": ("b_provider", "provider_id", {"network_status": {"03": "'Maybe'"}}, ""),
        "d_policy": ("b_policy", "policy_id", {"plan_tier": {"02": "'Tin'"}}, "03"),
        "cal": ("b_cal", "date_key", {"fiscal_year": {"02": "NULL"}}, "05"),
    }
    body, head = assertions(), []
    for source, (name, key, changes, twice) in spoilt.items():
        body = re.sub(rf"\b{source}\b", name, body)
        head.append(overlay(name, source, key, changes, twice))
    head.append("b_staged AS (SELECT * FROM st_headers WHERE right(claim_id, 1) = '1')")
    body = re.sub(r"\bst_headers\b", "b_staged", body)
    return f"WITH {', '.join(head)} {body}"


# -- measures ------------------------------------------------------------------------------------
def by_month(select: str) -> str:
    return f"SELECT year_month, {select} FROM claims_x GROUP BY year_month"


CHANGE = """
    SELECT * FROM (
        SELECT year_month, count(*) AS n, sum(billed_amount_pkr)::DOUBLE AS b, sum(paid_amount_pkr)::DOUBLE AS p
        FROM claims_x WHERE year_month IS NOT NULL GROUP BY 1) ORDER BY year_month DESC LIMIT 2"""

DETAIL = """claim_id, claim_date, employer_name, provider_id, hospital_name, member_city, network_status, claim_type, status,
    adjudication_mode"""
AMOUNTS = "billed_amount_pkr approved_amount_pkr paid_amount_pkr"

ANOMALY = """
    SELECT *, avg(avg_value) OVER w AS peer_mean, stddev_pop(avg_value) OVER w AS peer_sd
    FROM (SELECT provider_id, hospital_name, provider_type, network_status, count(*) AS claim_count,
                 sum(billed_amount_pkr)::DOUBLE / count(*) AS avg_value
          FROM claims_x GROUP BY ALL)
    WINDOW w AS (PARTITION BY provider_type)"""

SPEND = "SELECT provider_id, hospital_name, sum(paid_amount_pkr) AS paid FROM claims_x GROUP BY ALL"

MULTIPLES = """
    SELECT procedure_code, description,
           sum(unit_price_pkr) FILTER (network_status = 'In-Network')::DOUBLE
               / count(unit_price_pkr) FILTER (network_status = 'In-Network') AS a,
           sum(unit_price_pkr) FILTER (network_status = 'Out-of-Network')::DOUBLE
               / count(unit_price_pkr) FILTER (network_status = 'Out-of-Network') AS b
    FROM f_line JOIN raw_procedures USING (procedure_code) JOIN d_provider USING (provider_sk)
    GROUP BY ALL HAVING count(DISTINCT network_status) = 2"""

FREQUENT = """
    SELECT *, avg(n) OVER () AS m, stddev_pop(n) OVER () AS sd
    FROM (SELECT member_id, count(*) AS n, sum(paid_amount_pkr) AS paid FROM claims_x GROUP BY 1)"""

LOSS = f"""
    SELECT group_id, employer_name, industry, lives_covered, monthly_premium_pkr, 24 * monthly_premium_pkr AS prem,
           ifnull(sum(f.paid_amount_pkr), 0) AS paid, count(f.claim_id) AS n
    FROM d_group LEFT JOIN f_header f USING (employer_group_sk) GROUP BY ALL"""

MONTHS = """
    SELECT year_month, any_value(calendar_year) AS cy, any_value(fiscal_year) AS fy FROM cal GROUP BY 1"""

KEYS_HEADER = """claim_sk, claim_id, member_sk, provider_sk, employer_group_sk, policy_sk, claim_type, status, adjudication_mode,
    denial_reason_code, admission_date_key, discharge_date_key, submission_date_key, adjudication_date_key, payment_date_key"""
TATS = "length_of_stay, tat_submit_to_adjudicate, tat_adjudicate_to_pay, tat_total"
HEADER_MONEY = "billed_amount_pkr approved_amount_pkr paid_amount_pkr member_share_pkr"


def bodies() -> dict[str, str]:
    q: dict[str, str] = {}
    # sources
    q["csv_landing_members"] = "SELECT * FROM raw_members"
    q["csv_line_breaks"] = """
        SELECT * REPLACE (name || chr(10) || '"of", ' || city || chr(13) || chr(10) || member_id || chr(10) AS name) FROM raw_members"""
    q["csv_damaged_landing"] = f"""
        WITH lines AS (SELECT right(claim_id, 2) AS k, concat_ws(',', {', '.join(HEADER_COLUMNS)}) AS line FROM raw_headers)
        SELECT 'loaded' AS kind, '' AS reason, count(*) AS rows, 0 AS letters FROM lines WHERE k NOT IN ('07', '33', '64')
        UNION ALL
        SELECT 'refused', 'number of fields', count(*), sum(CASE k
            WHEN '07' THEN length(line) - position(',' IN reverse(line)) WHEN '33' THEN length(line) + 5 ELSE 9 END)::BIGINT
        FROM lines WHERE k IN ('07', '33', '64')"""
    q["published_versions"] = """
        WITH part AS (SELECT * FROM claims_x WHERE submission_date_key BETWEEN 20250101 AND 20251231)
        SELECT version, view_name, row_count FROM (
            SELECT 'v_claims_enriched' AS view_name, count(*) AS row_count, false AS cut FROM claims_x
            UNION ALL SELECT 'v_financial_monthly', count(DISTINCT year_month), false FROM claims_x
            UNION ALL SELECT 'v_provider_scorecard', count(DISTINCT provider_id), false FROM claims_x
            UNION ALL SELECT 'v_claims_enriched', count(*), true FROM part
            UNION ALL SELECT 'v_financial_monthly', count(DISTINCT year_month), true FROM part
            UNION ALL SELECT 'v_provider_scorecard', count(DISTINCT provider_id), true FROM part),
        (VALUES ('attached', false), ('all', false), ('2025', true)) v(version, of_2025) WHERE cut = of_2025"""
    one = "SELECT '{}' AS part, '{}' AS name, {} AS row_count".format
    q["batch_job"] = " UNION ALL ".join(
        [one("raw", t, f"(SELECT count(*) FROM {x})") for t, x in RAW_OF.items()]
        + [one("marts", t, f"(SELECT count(*) FROM {x} t)") for t, x in MODEL_SQL.items() if not t.startswith("stg_")]
        + [one("view", v, f"(SELECT count(*) FROM (@{v}))") for v in VIEWS]
        + [one("export", "kpi_summary", "1"), one("export", "kpi_monthly_trend", "(SELECT count(DISTINCT year_month) FROM claims_x)"),
           one("export", "claims_detail", "(SELECT count(*) FROM claims_x)"),
           one("export", "provider_report", "(SELECT least(60, count(DISTINCT provider_id)) FROM claims_x)"),
           one("export", "dq_latest", "39")])
    # the third decimal, the thousands mark, the word and the number beyond the type are lost; an empty text is not
    q["unread_numbers"] = """
        SELECT 'claims_header' AS table_name, 'billed_amount_pkr' AS column_name, count(*) AS lost FROM raw_headers
        WHERE right(claim_id, 2) IN ('07', '11', '23', '42') HAVING count(*) > 0"""
    q["ingest_audit"] = " UNION ALL ".join(n_rows(RAW_OF[t], t) for t in RAW_OF)
    q["reconcile_counts"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS stored_rows, true AS matches FROM {RAW_OF[t]}"
        for t in RAW_OF)
    q["csv_landing_reconciled"] = q["reconcile_counts"]
    q["layer_counts"] = " UNION ALL ".join(
        [f"SELECT 'raw' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {s}" for t, s in RAW_OF.items()]
        + [f"SELECT 'marts' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {s} t" for t, s in MODEL_SQL.items()
           if not t.startswith("stg_")])
    q["claims_in_date_range"] = (
        f"SELECT {DETAIL}, {money(AMOUNTS + ' savings_pkr')} FROM claims_x "
        "WHERE claim_date BETWEEN DATE '2025-01-01' AND DATE '2025-12-31'")
    q["parse_date_sql_function"] = f"SELECT member_id, {pdate('enrolment_date')} AS enrolled_on FROM raw_members"
    q["masked_identifier_check"] = (
        "SELECT count(*) AS members, count_if(contains(masked_cnic, '*')) AS masked, "
        "count_if(NOT contains(masked_cnic, '*')) AS unmasked FROM raw_members")
    # staging
    q["stg_employer_groups"] = "SELECT * REPLACE (monthly_premium_pkr::DOUBLE AS monthly_premium_pkr) FROM st_groups"
    q["stg_policies"] = ("SELECT * REPLACE (annual_limit_pkr::DOUBLE AS annual_limit_pkr, room_rent_cap_pkr::DOUBLE AS "
                         "room_rent_cap_pkr, deductible_pkr::DOUBLE AS deductible_pkr, copay_pct::DOUBLE AS copay_pct) "
                         "FROM st_policies")
    q["stg_providers"] = "SELECT * FROM st_providers"
    q["stg_members"] = "SELECT * FROM st_members"
    q["stg_diagnoses"] = "SELECT * FROM raw_diagnoses"
    q["stg_procedures"] = "SELECT * REPLACE (typical_cost_pkr::DOUBLE AS typical_cost_pkr) FROM st_procedures"
    claim_cols = """claim_id, member_id, provider_id, policy_id, claim_type, admission_date, discharge_date, submission_date,
        adjudication_date, payment_date, status, denial_reason_code, adjudication_mode"""
    q["stg_claims_header"] = f"SELECT {claim_cols}, {money(HEADER_MONEY)} FROM st_headers"
    line_money = "quantity unit_price_pkr line_billed_pkr line_approved_pkr"
    line_cols = "claim_line_id, claim_id, line_no, procedure_code, diagnosis_code"
    q["stg_claims_lines"] = f"SELECT {line_cols}, {money(line_money)} FROM st_lines"
    # cleaning
    q["members_cleaned"] = "SELECT * FROM good_members"
    q["claims_deduplicated"] = f"SELECT {claim_cols}, {money(HEADER_MONEY)} FROM first_claims"
    days = "days_discharge_to_submit, days_submit_to_adjudicate, days_adjudicate_to_pay, length_of_stay"
    q["claims_cleaned"] = f"SELECT {claim_cols}, {days}, {money(HEADER_MONEY)} FROM good_claims"
    q["claim_lines_cleaned"] = f"SELECT {line_cols}, {money(line_money)} FROM good_lines"
    # dimensions
    q["calendar_activity"] = (
        f"SELECT cal.*, count(f.claim_id) AS claims_submitted, ifnull({total('f.billed_amount_pkr')}, 0) AS billed_pkr "
        "FROM cal LEFT JOIN f_header f ON submission_date_key = date_key GROUP BY ALL")
    q["dim_member"] = "SELECT * FROM d_member"
    q["dim_provider"] = "SELECT * FROM d_provider"
    q["dim_employer_group"] = "SELECT * REPLACE (monthly_premium_pkr::DOUBLE AS monthly_premium_pkr) FROM d_group"
    q["dim_policy"] = ("SELECT * REPLACE (annual_limit_pkr::DOUBLE AS annual_limit_pkr, room_rent_cap_pkr::DOUBLE AS "
                       "room_rent_cap_pkr, deductible_pkr::DOUBLE AS deductible_pkr, copay_pct::DOUBLE AS copay_pct) FROM d_policy")
    q["dim_diagnosis"] = "SELECT * FROM d_diagnosis"
    q["dim_procedure"] = "SELECT * REPLACE (typical_cost_pkr::DOUBLE AS typical_cost_pkr) FROM d_procedure"
    q["claim_status_activity"] = f"""
        SELECT md5(status) AS claim_status_sk, status, status IN ('Paid', 'Partially Paid', 'Denied') AS is_final,
               status IN ('Paid', 'Partially Paid') AS is_paid_state, count(*) AS claim_count,
               {total('billed_amount_pkr')} AS billed_pkr
        FROM f_header GROUP BY status"""
    q["claim_type_activity"] = f"""
        SELECT md5(claim_type) AS claim_type_sk, claim_type,
               if(claim_type IN ('Outpatient', 'Diagnostic', 'Pharmacy'), 'Ambulatory', 'Facility') AS care_setting,
               count(*) AS claim_count, {total('billed_amount_pkr')} AS billed_pkr
        FROM f_header GROUP BY claim_type"""
    # facts
    q["fct_claim_header"] = f"SELECT {KEYS_HEADER}, {TATS}, claim_count, {money(HEADER_MONEY + ' savings_pkr')} FROM f_header"
    q["fct_claim_line"] = (
        "SELECT claim_line_sk, claim_line_id, claim_id, line_no, member_sk, provider_sk, diagnosis_sk, procedure_sk, "
        f"submission_date_key, claim_type, status, procedure_code, diagnosis_code, {money(line_money + ' line_savings_pkr')} "
        "FROM f_line")
    q["fct_monthly_member_summary"] = (
        "SELECT member_month_sk, member_sk, member_id, employer_group_id, policy_id, month_start, month_key, claim_count, "
        f"{money(HEADER_MONEY)} FROM f_month")
    q["as_of_member_join"] = """
        SELECT g.claim_id, g.member_id, g.submission_date, m.member_sk, m.member_sk IS NOT NULL AS covered
        FROM good_claims g LEFT JOIN d_member m
          ON m.member_id = g.member_id AND g.submission_date >= m.valid_from AND g.submission_date <= m.valid_to"""
    # views
    q["v_claims_enriched"] = f"""
        SELECT claim_id, claim_sk, claim_date, year_month, month_number, month_name_short, calendar_year, fiscal_year, member_id,
               gender, age_band, member_city, relationship, employer_group_id, employer_name, industry, lives_covered,
               provider_id, hospital_name, provider_city, provider_type, network_status, provider_tier, plan_tier, claim_type,
               status, adjudication_mode, denial_reason_code, {TATS}, is_denied, is_auto,
               {money(HEADER_MONEY + ' savings_pkr monthly_premium_pkr')}
        FROM claims_x"""
    q["v_financial_monthly"] = f"""
        SELECT year_month, fiscal_year, count(*) AS claim_count, {total('billed_amount_pkr')} AS billed_pkr,
               {total('approved_amount_pkr')} AS approved_pkr, {total('paid_amount_pkr')} AS paid_pkr,
               {total('member_share_pkr')} AS member_share_pkr, {total('savings_pkr')} AS savings_pkr,
               {share('sum(approved_amount_pkr)', 'sum(billed_amount_pkr)')} AS approval_rate,
               {share('sum(savings_pkr)', 'sum(billed_amount_pkr)')} AS savings_rate,
               {share('sum(member_share_pkr)', 'sum(billed_amount_pkr)')} AS member_cost_share
        FROM claims_x GROUP BY ALL"""
    q["v_mlr_by_group"] = f"""
        SELECT group_id AS employer_group_id, employer_name, industry, lives_covered, monthly_premium_pkr::DOUBLE AS
               monthly_premium_pkr, prem::DOUBLE AS earned_premium_pkr, paid::DOUBLE AS paid_pkr, n AS claim_count,
               {share('paid', 'prem')} AS medical_loss_ratio FROM ({LOSS})"""
    q["v_pmpm"] = f"""
        SELECT strftime(month_start, '%Y-%m') AS year_month, count(*) AS member_months, {total('paid_amount_pkr')} AS paid_pkr,
               {total('billed_amount_pkr')} AS billed_pkr, {share('sum(paid_amount_pkr)', 'count(*)')} AS pmpm_paid_pkr,
               {share('sum(billed_amount_pkr)', 'count(*)')} AS pmpm_billed_pkr
        FROM f_month GROUP BY month_start"""
    q["v_operations_monthly"] = by_month(f"""
        count(*) AS claim_count, sum(is_denied)::BIGINT AS denied_count, {mean('is_denied')} AS denial_rate,
        {mean('is_auto')} AS auto_adjudication_rate, {mean(TAT)} AS tat_adj_mean,
        round(quantile_cont({TAT}, 0.5), 6) AS tat_adj_median, round(quantile_cont({TAT}, 0.9), 6) AS tat_adj_p90,
        {mean('tat_total')} AS tat_total_mean, round(quantile_cont(tat_total, 0.9), 6) AS tat_total_p90""")
    q["v_denial_reasons"] = f"""
        SELECT a.denial_reason_code, a.n AS denial_count, a.b::DOUBLE AS denied_billed_pkr,
               (SELECT count(*) + 1 FROM denials o WHERE o.n > a.n) AS rank_by_frequency,
               (SELECT count(*) + 1 FROM denials o WHERE o.b > a.b) AS rank_by_value FROM denials a"""
    q["v_denial_reasons"] = ("WITH denials AS (SELECT denial_reason_code, count(*) AS n, sum(billed_amount_pkr) AS b FROM f_header "
                             "WHERE status = 'Denied' AND denial_reason_code IS NOT NULL GROUP BY 1) " + q["v_denial_reasons"].strip())
    q["v_claims_ageing"] = f"""
        SELECT if(d <= 30, '0-30', if(d <= 60, '31-60', if(d <= 90, '61-90', '90+'))) AS ageing_bucket,
               count(*) AS open_claim_count, {total('billed_amount_pkr')} AS open_billed_pkr
        FROM (SELECT date_diff('day', claim_date, DATE '2026-06-30') AS d, billed_amount_pkr FROM claims_x WHERE {OPEN})
        GROUP BY 1"""
    q["v_top_diagnoses"] = f"""
        SELECT diagnosis_code, description, chapter, count(*) AS line_count, {total('line_billed_pkr')} AS billed_pkr,
               {total('line_approved_pkr')} AS approved_pkr
        FROM f_line JOIN raw_diagnoses USING (diagnosis_code) GROUP BY ALL"""
    q["v_top_procedures"] = f"""
        SELECT procedure_code, description, category, count(*) AS line_count, {total('quantity')} AS total_quantity,
               {total('line_billed_pkr')} AS billed_pkr, {total('line_approved_pkr')} AS approved_pkr
        FROM f_line JOIN raw_procedures USING (procedure_code) GROUP BY ALL"""
    q["v_utilisation"] = f"""
        SELECT claim_type, count(*) AS claim_count,
               round(1000.0::DOUBLE * count(*) / (SELECT count(*) FROM d_member WHERE is_current), 6) AS claims_per_1000_members,
               {mean('length_of_stay', STAYS)} AS avg_length_of_stay, {total('paid_amount_pkr')} AS paid_pkr
        FROM f_header GROUP BY claim_type"""
    q["v_readmissions"] = f"""WITH stays AS (
            SELECT h.claim_id, h.member_sk, h.admission_date_key AS key, any_value(c.date_day) AS d,
                   arg_min(x.chapter, (l.line_no, l.claim_line_id)) AS chapter
            FROM f_header h JOIN f_line l USING (claim_id) JOIN raw_diagnoses x USING (diagnosis_code)
            JOIN cal c ON c.date_key = h.admission_date_key
            WHERE h.{STAYS} GROUP BY ALL)
        SELECT i.member_sk, i.chapter, i.claim_id AS index_claim_id, r.claim_id AS readmit_claim_id,
               date_diff('day', i.d, r.d)::INTEGER AS days_between
        FROM stays i, stays r
        WHERE i.member_sk = r.member_sk AND i.chapter = r.chapter AND date_diff('day', i.d, r.d) BETWEEN 1 AND 30"""
    q["v_network_cost_diff"] = f"""
        SELECT procedure_code, description, round(a, 6) AS in_network_avg_pkr, round(b, 6) AS out_network_avg_pkr,
               round(b / nullif(a, 0), 6) AS oon_cost_multiple FROM ({MULTIPLES})"""
    q["v_provider_scorecard"] = f"""
        SELECT provider_id, hospital_name, provider_city, provider_type, network_status, provider_tier, count(*) AS claim_count,
               {total('billed_amount_pkr')} AS billed_pkr, {total('paid_amount_pkr')} AS paid_pkr,
               {mean('billed_amount_pkr')} AS avg_claim_value_pkr, {mean('is_denied')} AS denial_rate,
               {total('savings_pkr')} AS savings_pkr
        FROM claims_x GROUP BY ALL"""
    q["v_provider_concentration"] = f"""
        SELECT provider_id, hospital_name, paid::DOUBLE AS paid_pkr, {share('paid', 'sum(paid) OVER ()')} AS spend_share,
               row_number() OVER o AS spend_rank,
               {share('sum(paid) OVER (o ROWS UNBOUNDED PRECEDING)', 'sum(paid) OVER ()')} AS cumulative_share
        FROM ({SPEND}) WINDOW o AS (ORDER BY paid DESC, md5(provider_id), provider_id)"""
    q["v_provider_anomaly"] = f"""
        SELECT provider_id, hospital_name, provider_type, network_status, claim_count, round(avg_value, 6) AS avg_claim_value,
               round(peer_mean, 6) AS peer_mean, round(peer_sd, 6) AS peer_sd,
               round((avg_value - peer_mean) / nullif(peer_sd, 0), 6) AS z_score,
               peer_sd > 0 AND avg_value - peer_mean > 2 * peer_sd AS is_anomalous FROM ({ANOMALY})"""
    q["v_duplicate_candidates"] = """
        SELECT member_id, provider_id, admission_date, billed_amount_pkr, occurrence_count, claim_id, count(*) AS copies
        FROM (SELECT *, count(*) OVER (PARTITION BY member_id, provider_id, admission_date, billed_amount_pkr)
                        AS occurrence_count FROM raw_headers)
        WHERE occurrence_count > 1 GROUP BY ALL"""
    q["v_high_frequency_members"] = f"""
        SELECT member_id, n AS claim_count, paid::DOUBLE AS paid_pkr, round(m, 6) AS mean_freq, round((n - m) / sd, 6) AS z_score
        FROM ({FREQUENT}) WHERE sd > 0 AND n > m + 2 * sd"""
    q["ibnr_by_month"] = f"""
        SELECT strftime(c.date_day, '%Y-%m') AS incurred_month, count(*) AS open_claim_count,
               {total('billed_amount_pkr')} AS open_billed_pkr, round(any_value(r), 6) AS conversion_rate,
               round({total('billed_amount_pkr')} * any_value(r), 6) AS ibnr_pkr
        FROM f_header JOIN cal c ON c.date_key = admission_date_key,
             (SELECT sum(paid_amount_pkr)::DOUBLE / sum(approved_amount_pkr)::DOUBLE AS r FROM f_header)
        WHERE {OPEN} GROUP BY 1"""
    q["upcoding_proxy"] = """
        SELECT provider_id, provider_type, category, b::DOUBLE AS category_billed_pkr, round(s, 6) AS category_share,
               round(avg(s) OVER w, 6) AS peer_mean_share,
               round((s - avg(s) OVER w) / nullif(stddev_pop(s) OVER w, 0), 6) AS z_score
        FROM (SELECT *, b::DOUBLE / (sum(b) OVER (PARTITION BY provider_id))::DOUBLE AS s
              FROM (SELECT provider_id, provider_type, category, sum(line_billed_pkr) AS b
                    FROM f_line JOIN raw_procedures USING (procedure_code) JOIN d_provider USING (provider_sk) GROUP BY ALL))
        WINDOW w AS (PARTITION BY provider_type, category)"""
    must = ("v_claims_enriched", "v_financial_monthly", "v_provider_scorecard")
    q["view_smoke_check"] = " UNION ALL ".join(
        f"SELECT '{v}' AS view_name, count(*) AS row_count, {'count(*) > 0' if v in must else 'true'} AS ok FROM ({'@' + v})"
        for v in VIEWS)
    # measures
    q["measures_core_by_month"] = by_month(f"""
        {total('billed_amount_pkr')} AS "Total Billed", {total('approved_amount_pkr')} AS "Total Approved",
        {total('paid_amount_pkr')} AS "Total Paid", {total('member_share_pkr')} AS "Total Member Share",
        {total('savings_pkr')} AS "Total Savings", count(*) AS "Claim Count",
        {share('sum(approved_amount_pkr)', 'sum(billed_amount_pkr)')} AS "Approval Rate",
        {share('sum(savings_pkr)', 'sum(billed_amount_pkr)')} AS "Savings Rate",
        {share('sum(member_share_pkr)', 'sum(billed_amount_pkr)')} AS "Member Cost Share",
        {share('sum(billed_amount_pkr)', 'count(*)')} AS "Avg Claim Value" """)
    premium = "(SELECT sum(24 * monthly_premium_pkr) FROM d_group g WHERE g.industry = x.industry)"
    q["measures_premium_by_industry"] = f"""
        SELECT industry, {dbl(premium)} AS "Earned Premium", {share('sum(paid_amount_pkr)', premium)} AS "Loss Ratio",
               {share('sum(paid_amount_pkr)', premium)} AS "Medical Loss Ratio" FROM claims_x x GROUP BY industry"""
    months = "(SELECT count(*) FROM f_month m WHERE strftime(m.month_start, '%Y-%m') = x.year_month)"
    q["measures_pmpm_by_month"] = f"""
        SELECT year_month, {months} AS "Member Months", {share('sum(paid_amount_pkr)', months)} AS "PMPM Paid",
               {share('sum(billed_amount_pkr)', months)} AS "PMPM Billed" FROM claims_x x GROUP BY year_month"""
    q["measures_operations_by_type"] = f"""
        SELECT claim_type, count_if(status = 'Denied') AS "Denied Claims", {mean('is_denied')} AS "Denial Rate",
               count_if(adjudication_mode = 'Auto') AS "Auto Adjudicated", {mean('is_auto')} AS "Auto Adjudication Rate",
               {mean(TAT)} AS "Avg TAT Submit to Adjudicate", round(quantile_cont({TAT}, 0.5), 6) AS "Median TAT",
               round(quantile_cont({TAT}, 0.9), 6) AS "P90 TAT",
               {mean('tat_adjudicate_to_pay')} AS "Avg TAT Adjudicate to Pay", count_if({OPEN}) AS "Open Claims",
               {total('billed_amount_pkr', OPEN)} AS "Backlog Billed"
        FROM claims_x GROUP BY claim_type"""
    members = "(SELECT count(*) FROM d_member m WHERE m.age_band = x.age_band)"
    lines = "(SELECT {} FROM f_line l JOIN d_member m USING (member_sk) WHERE m.age_band = x.age_band)"
    q["measures_utilisation_by_age"] = f"""
        SELECT age_band, count(DISTINCT member_sk) AS "Distinct Members",
               round(1000.0::DOUBLE * count(*) / {members}, 6) AS "Utilisation per 1000",
               {mean('length_of_stay', STAYS)} AS "Avg Length of Stay", {lines.format('count(*)')} AS "Line Count",
               {lines.format('sum(line_billed_pkr)::DOUBLE')} AS "Line Billed"
        FROM claims_x x GROUP BY age_band"""
    oon = "network_status = 'Out-of-Network'"
    q["measures_network_by_employer"] = f"""
        SELECT employer_name, {total('paid_amount_pkr', oon)} AS "OON Paid",
               round({total('paid_amount_pkr', oon)} / {total('paid_amount_pkr')}, 6) AS "OON Share"
        FROM claims_x GROUP BY employer_name"""
    q["measure_top10_provider_spend"] = f"""
        SELECT sum(paid) FILTER (r <= 10)::DOUBLE AS "Top10 Provider Spend",
               {share('sum(paid) FILTER (r <= 10)', 'sum(paid)')} AS "Provider Concentration"
        FROM (SELECT paid, rank() OVER (ORDER BY paid DESC) AS r FROM ({SPEND}))"""
    q["duplicate_claim_flag"] = """
        SELECT claim_id, member_id, provider_id, admission_date, billed_amount_pkr,
               if(count(*) OVER (PARTITION BY member_id, provider_id, admission_date, billed_amount_pkr) > 1, 1, 0)
                   AS duplicate_claim_flag
        FROM raw_headers"""
    earlier = "(SELECT {} FROM per o WHERE o.i = per.i - 12)"
    window = "(SELECT {} FROM per o WHERE o.i BETWEEN per.i - 2 AND per.i)"
    so_far = "(SELECT sum(o.{0}) FROM per o WHERE o.{1} = per.{1} AND o.i <= per.i)::DOUBLE"
    q["time_intelligence"] = f"""WITH per AS (
            SELECT m.*, row_number() OVER (ORDER BY year_month) AS i, n, p, b, den, mm FROM ({MONTHS}) m
            LEFT JOIN (SELECT year_month, count(*) AS n, sum(paid_amount_pkr) AS p, sum(billed_amount_pkr) AS b,
                              sum(is_denied) AS den FROM claims_x GROUP BY 1) USING (year_month)
            LEFT JOIN (SELECT strftime(month_start, '%Y-%m') AS year_month, count(*) AS mm FROM f_month GROUP BY 1)
                USING (year_month))
        SELECT year_month, {so_far.format('p', 'cy')} AS "Paid YTD", {so_far.format('b', 'cy')} AS "Billed YTD",
               {so_far.format('p', 'fy')} AS "Paid Fiscal YTD", {earlier.format('p')}::DOUBLE AS "Paid PY",
               {earlier.format('n')} AS "Claim Count PY",
               round({earlier.format('den')}::DOUBLE / {earlier.format('n')}, 6) AS "Denial Rate PY",
               {window.format('sum(p)')}::DOUBLE AS "Paid Rolling 3M",
               {share(window.format('sum(p)'), window.format('sum(mm)'))} AS "PMPM Rolling 3M",
               {share('p - ' + earlier.format('p'), earlier.format('p'))} AS "Paid YoY %"
        FROM per WHERE n IS NOT NULL"""
    q["ibnr_estimate_by_type"] = f"""
        SELECT claim_type, round({total('billed_amount_pkr', OPEN)} * ({dbl('sum(paid_amount_pkr)')}
               / {dbl('sum(approved_amount_pkr)')}), 6) AS "IBNR Estimate" FROM f_header GROUP BY claim_type"""
    q["members_of_ranges"] = """
        WITH used AS (SELECT DISTINCT date_trunc('month', claim_date) AS month_start, claim_type, member_sk FROM claims_x WHERE claim_date IS NOT NULL),
        months AS (SELECT unnest(generate_series(min(month_start), max(month_start), INTERVAL 1 MONTH)) AS m FROM used),
        seen AS (SELECT m, claim_type, member_sk FROM months JOIN used ON month_start BETWEEN m - INTERVAL 2 MONTH AND m)
        SELECT strftime(m, '%Y%m')::INTEGER AS submission_month, claim_type, count(DISTINCT member_sk) AS distinct_members
        FROM seen GROUP BY ALL
        UNION ALL SELECT strftime(m, '%Y%m')::INTEGER, 'all', count(DISTINCT member_sk) FROM seen GROUP BY ALL"""
    q["members_of_a_year"] = """
        SELECT claim_type, count(DISTINCT member_sk) AS distinct_members FROM claims_x WHERE year(claim_date) = 2025 GROUP BY 1"""
    took = f"""count({TAT}) AS claims, round(avg({TAT}), 6) AS tat_mean, round(quantile_cont({TAT}, 0.5), 6) AS tat_median,
        round(quantile_cont({TAT}, 0.9), 6) AS tat_p90"""
    q["turnaround_of_ranges"] = " UNION ALL ".join(
        f"""SELECT {a} AS month_from, {mode} AS adjudication_mode, {took} FROM claims_x
            WHERE submission_date_key // 100 BETWEEN {a} AND {b} AND {TAT} IS NOT NULL GROUP BY 1, 2"""
        for a, b in ((202407, 202506), (202501, 202503), (202507, 999999)) for mode in ("adjudication_mode", "'all'"))
    shown = """
        WITH k AS (SELECT member_id, city, policy_id, TRY_CAST(right(member_id, 4) AS INT) AS n FROM raw_members),
        seen AS (
            SELECT member_id, city, policy_id, DATE '2024-07-01' AS taken FROM k WHERE n % 7 <> 0
            UNION ALL SELECT member_id, city, if(n % 5 = 0, 'POL-other', policy_id), DATE '2025-02-01' FROM k WHERE n % 11 <> 0
            UNION ALL SELECT member_id, if(n % 3 = 0, 'Elsewhere', city), policy_id, DATE '2025-09-01' FROM k WHERE n % 13 <> 0),
        days AS (SELECT DISTINCT taken FROM seen),
        history AS (
            SELECT member_id, city, policy_id, taken AS valid_from,
                ifnull((SELECT min(d.taken) FROM days d WHERE d.taken > s.taken AND NOT EXISTS (
                    SELECT 1 FROM seen x WHERE x.member_id = s.member_id AND x.taken = d.taken AND x.city = s.city
                    AND x.policy_id = s.policy_id)), DATE '9999-12-31') AS valid_to
            FROM seen s WHERE NOT EXISTS (
                SELECT 1 FROM seen p WHERE p.member_id = s.member_id AND p.city = s.city AND p.policy_id = s.policy_id
                AND p.taken = (SELECT max(d.taken) FROM days d WHERE d.taken < s.taken)))"""
    q["member_history"] = f"{shown} SELECT *, valid_to = DATE '9999-12-31' AS is_current FROM history"
    q["claims_as_of_history"] = f"""{shown}
        SELECT g.claim_id, g.member_id, g.submission_date, h.city, h.policy_id FROM good_claims g
        LEFT JOIN history h ON h.member_id = g.member_id AND g.submission_date >= valid_from AND g.submission_date < valid_to"""
    q["claims_table_function"] = f"""
        SELECT claim_id, claim_type, {money('paid_amount_pkr')} FROM f_header WHERE submission_date_key BETWEEN 20250115 AND 20250310"""
    q["row_level_filter"] = f"""
        SELECT claim_id, employer_group_id, {money('paid_amount_pkr')} FROM claims_x WHERE industry = 'ASIA'"""
    q["billed_by_admission_month"] = f"""
        SELECT strftime(c.date_day, '%Y-%m') AS admission_month, count(*) AS claim_count,
               {total('billed_amount_pkr')} AS billed_pkr
        FROM f_header JOIN cal c ON c.date_key = admission_date_key GROUP BY 1"""
    q["drill_through_flagged_providers"] = f"""
        SELECT {DETAIL}, {money(AMOUNTS + ' savings_pkr')} FROM claims_x WHERE provider_id IN (
            SELECT provider_id FROM ({ANOMALY}) WHERE peer_sd > 0 AND avg_value > peer_mean + 2 * peer_sd)"""
    q["drill_through_frequent_members"] = f"""
        SELECT member_id, {DETAIL}, {money(AMOUNTS + ' savings_pkr')} FROM claims_x WHERE member_id IN (
            SELECT member_id FROM ({FREQUENT}) WHERE sd > 0 AND n > m + 2 * sd)"""
    q["saved_filters"] = f"""
        SELECT 'denied only' AS saved_filter, count(*) AS claim_count, {total('billed_amount_pkr')} AS billed_pkr
        FROM claims_x WHERE is_denied = 1
        UNION ALL SELECT 'out-of-network only', count(*), {total('billed_amount_pkr')} FROM claims_x WHERE {oon}"""
    # data quality
    q["dq_results"] = dq(f"SELECT 1 AS run_id, {RESULT_ROW} FROM res")
    q["dq_failed_records"] = f"SELECT 1 AS run_id, * FROM ({failing_keys()})"
    second = f"""(SELECT res.* REPLACE (d.rows_failed AS rows_failed, d.rows_failed / rows_checked AS rate)
        FROM res JOIN ({dirty_rules()}) d USING (rule_id))"""
    q["dq_latest_run"] = dq(f"SELECT 2 AS run_id, {RESULT_ROW} FROM {second}")
    q["dq_trend"] = dq(f"""
        SELECT 1 AS run_id, round(sum(rate) / count(*), 6) AS avg_fail_rate, sum(rows_failed)::BIGINT AS total_failed FROM res
        UNION ALL
        SELECT 2, round(sum(rate) / count(*), 6), sum(rows_failed)::BIGINT FROM {second}""")
    q["dq_scores"] = dq(f"""
        SELECT 'overall' AS scope, 'all' AS name, round({SCORE}, 6) AS score FROM res
        UNION ALL SELECT 'dimension', dimension, round({SCORE}, 6) FROM res GROUP BY dimension
        UNION ALL SELECT 'table', table_name, round({SCORE}, 6) FROM res GROUP BY table_name""")
    q["dq_dirty_rules"] = dirty_rules()
    q["gate_verdict"] = dq("SELECT rule_id FROM res WHERE severity = 'critical' AND rows_failed > 0")
    q["dq_report"] = dq(f"""
        SELECT 1 AS run_id, round({SCORE}, 2) AS overall_score, count(*) AS rules,
               count_if(severity = 'critical' AND rows_failed > 0) AS critical_failures,
               {', '.join(f"(SELECT round({SCORE}, 2) FROM res WHERE dimension = '{d}') AS {d}" for d in (
                   'completeness', 'validity', 'consistency', 'uniqueness', 'accuracy', 'timeliness'))},
               {', '.join(f"(SELECT round({SCORE}, 2) FROM res WHERE table_name = '{t}') AS {t}" for t in (
                   'claims_header', 'claims_lines', 'members', 'providers', 'policies', 'employer_groups'))}
        FROM res""")
    q["dq_page_totals"] = dq("""
        SELECT count_if(rows_failed = 0) AS rules_passed, count(*) AS rules_total, sum(rows_failed)::BIGINT AS rows_failed,
               count_if(severity = 'critical' AND rows_failed > 0) AS critical_failures FROM res""")
    q["dq_failures_by_dimension"] = dq("SELECT dimension, sum(rows_failed)::BIGINT AS rows_failed FROM res GROUP BY dimension")
    block = "(SELECT count(*) FROM orders WHERE o_orderkey % 1000 BETWEEN {} AND {})"
    defects = [
        ("duplicate_claims", "U-HDR-BIZDUP", block.format(0, 19)), ("null_values", "C-HDR-ADJMODE", block.format(100, 114)),
        ("orphan_fk_member", "R-HDR-MEMBER-FK", block.format(200, 202)),
        ("orphan_fk_provider", "R-HDR-PROVIDER-FK", block.format(203, 204)),
        ("date_violations", "K-HDR-DISCHARGE", block.format(300, 307)),
        ("amount_violations", "A-HDR-PAID-APPR", block.format(400, 405)),
        ("nonpositive_amounts", "A-HDR-NONNEG", block.format(500, 502)),
        ("impossible_ages", "V-MBR-AGE", "(SELECT count(*) FROM customer WHERE c_custkey % 250 IN (1, 2))"),
        ("city_casing_members", "K-MBR-CITY", "(SELECT count(*) FROM customer WHERE c_custkey % 20 = 0)"),
        ("city_casing_providers", "K-PRV-CITY", "(SELECT count(*) FROM supplier WHERE s_suppkey % 10 = 0)"),
        ("city_casing_groups", "K-GRP-CITY", "(SELECT count(*) FROM nation WHERE n_nationkey % 5 = 0)"),
    ]
    q["dq_defect_reconciliation"] = dq(" UNION ALL ".join(
        f"SELECT '{d}' AS defect, '{r}' AS rule_id, {n} AS injected, rows_failed AS caught, {n} = rows_failed AS matches "
        f"FROM res WHERE rule_id = '{r}'" for d, r, n in defects))
    q["warehouse_assertions"] = assertions()
    q["planted_assertions"] = planted_assertions()
    # consumers
    q["filtered_executive_monthly"] = f"""
        SELECT year_month, {total('billed_amount_pkr')} AS billed, {total('paid_amount_pkr')} AS paid, count(claim_id) AS claims,
               sum(is_denied)::BIGINT AS denied
        FROM claims_x
        WHERE claim_date BETWEEN DATE '2024-10-01' AND DATE '2026-03-31' AND claim_type IN ('Inpatient', 'Outpatient', 'Emergency')
          AND network_status = 'In-Network' GROUP BY 1"""
    names = ["employer_name", "claim_type", "member_city", "network_status"]
    q["filter_domains"] = " UNION ALL ".join(
        [f"SELECT DISTINCT '{n}' AS filter, {n} AS value FROM claims_x WHERE {n} IS NOT NULL" for n in names]
        + ["SELECT 'claim_date_min', min(claim_date)::VARCHAR FROM claims_x",
           "SELECT 'claim_date_max', max(claim_date)::VARCHAR FROM claims_x"])
    q["executive_monthly"] = by_month(
        f"{total('billed_amount_pkr')} AS billed, {total('paid_amount_pkr')} AS paid, count(claim_id) AS claims, "
        "sum(is_denied)::BIGINT AS denied")
    delta = "(SELECT round((max_by({0}, year_month) - min_by({0}, year_month)) / nullif(min_by({0}, year_month)::DOUBLE, 0) * 100, 6) FROM chg)"
    q["executive_headline"] = f"""WITH chg AS ({CHANGE})
        SELECT count(*) AS claims, {total('billed_amount_pkr')} AS billed, {total('paid_amount_pkr')} AS paid,
               round(sum(is_denied)::DOUBLE / count(*) * 100, 6) AS denial_rate_pct,
               round(sum(savings_pkr)::DOUBLE / sum(billed_amount_pkr)::DOUBLE * 100, 6) AS savings_rate_pct,
               {delta.format('n')} AS claims_delta_pct, {delta.format('b')} AS billed_delta_pct,
               {delta.format('p')} AS paid_delta_pct FROM claims_x"""
    q["status_mix"] = 'SELECT status, count(*) AS "count" FROM f_header GROUP BY 1'
    q["volume_by_type"] = 'SELECT claim_type, count(*) AS "count" FROM f_header GROUP BY 1'
    q["spend_by_city"] = f"SELECT member_city, {total('paid_amount_pkr')} AS paid_amount_pkr FROM claims_x GROUP BY 1"
    q["operations_headline"] = f"""
        SELECT round(sum(is_auto)::DOUBLE / count(*) * 100, 6) AS auto_rate_pct, {mean(TAT)} AS tat_mean,
               round(median({TAT}), 6) AS tat_median, round(quantile_cont({TAT}, 0.9), 6) AS tat_p90 FROM claims_x"""
    q["turnaround_histogram"] = f"""WITH b AS (SELECT min({TAT})::DOUBLE AS lo, (max({TAT}) - min({TAT}))::DOUBLE / 40 AS w FROM f_header)
        SELECT adjudication_mode, bin, round(lo + (bin - 1) * w, 6) AS bin_start, round(lo + bin * w, 6) AS bin_end,
               count(*) AS claim_count
        FROM (SELECT adjudication_mode, lo, w, least(floor(({TAT} - lo) * 40 / (w * 40))::INTEGER + 1, 40) AS bin
              FROM f_header, b WHERE {TAT} IS NOT NULL) GROUP BY ALL"""
    q["adjudication_funnel"] = """
        SELECT i::INTEGER AS stage, s AS status, (SELECT count(*) FROM f_header f WHERE f.status = s) AS claim_count
        FROM (VALUES (1, 'In Review'), (2, 'Pending'), (3, 'Partially Paid'), (4, 'Denied'), (5, 'Paid')) v(i, s)"""
    q["top_loss_ratios"] = f"""
        SELECT group_id AS employer_group_id, employer_name, {share('paid', 'prem')} AS medical_loss_ratio FROM ({LOSS})
        ORDER BY paid / prem::DOUBLE DESC, group_id LIMIT 15"""
    q["top_share_of_spend"] = f"""
        SELECT round(sum(paid) FILTER (r <= 10)::DOUBLE / sum(paid)::DOUBLE * 100, 6) AS top_share_pct
        FROM (SELECT paid, row_number() OVER (ORDER BY paid DESC) AS r FROM ({SPEND}))"""
    q["top_network_multiples"] = f"""
        SELECT procedure_code, description, round(b / a, 6) AS oon_cost_multiple FROM ({MULTIPLES})
        ORDER BY b / a DESC, procedure_code LIMIT 15"""
    q["flagged_providers"] = f"""
        SELECT provider_id, hospital_name, provider_type, round(avg_value, 6) AS avg_claim_value,
               round((avg_value - peer_mean) / peer_sd, 6) AS z_score
        FROM ({ANOMALY}) WHERE peer_sd > 0 AND avg_value > peer_mean + 2 * peer_sd"""
    q["kpi_summary"] = f"""
        SELECT count(*) AS total_claims, {total('billed_amount_pkr')} AS total_billed, {total('approved_amount_pkr')} AS total_approved,
               {total('paid_amount_pkr')} AS total_paid,
               {share('sum(approved_amount_pkr)', 'sum(billed_amount_pkr)')} AS approval_rate,
               {share('sum(billed_amount_pkr) - sum(approved_amount_pkr)', 'sum(billed_amount_pkr)')} AS savings_rate FROM f_header"""
    q["kpi_monthly_trend"] = by_month(f"""{total('billed_amount_pkr')} AS billed_pkr, {total('approved_amount_pkr')} AS approved_pkr,
        {total('paid_amount_pkr')} AS paid_pkr, {share('sum(approved_amount_pkr)', 'sum(billed_amount_pkr)')} AS approval_rate""")
    q["claims_detail"] = f"SELECT {DETAIL}, {money(AMOUNTS + ' savings_pkr')} FROM claims_x"
    q["provider_report"] = f"""
        SELECT provider_id, hospital_name, count(*) AS claim_count, {total('paid_amount_pkr')} AS total_paid,
               {mean('billed_amount_pkr')} AS avg_claim_value, {total('billed_amount_pkr')} AS total_billed
        FROM claims_x GROUP BY ALL ORDER BY sum(billed_amount_pkr) DESC, provider_id LIMIT 60"""
    return q


VIEWS = [
    "v_claims_enriched", "v_financial_monthly", "v_mlr_by_group", "v_pmpm", "v_operations_monthly", "v_denial_reasons",
    "v_claims_ageing", "v_top_diagnoses", "v_top_procedures", "v_utilisation", "v_readmissions", "v_network_cost_diff",
    "v_provider_scorecard", "v_provider_concentration", "v_provider_anomaly", "v_high_frequency_members",
    "v_duplicate_candidates",
]


def all_sql() -> dict[str, str]:
    q = bodies()
    for v in VIEWS:  # the smoke check and the batch job count the views' own SQL
        for n in ("view_smoke_check", "batch_job"):
            q[n] = q[n].replace(f"(@{v})", f"({q[v]})")
    return {name: with_tables(body) for name, body in q.items()}
