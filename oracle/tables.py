"""The claims tables as DuckDB common table expressions, from the driver's tables up to the star.

Written apart from the DataFrame code: nothing here is generated from it or read by it.
"""

from __future__ import annotations

import re


def pdate(c: str) -> str:
    """Three date layouts, else NULL."""
    return (
        f"CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime(left({c}, 10), '%Y-%m-%d')::DATE "
        f"WHEN regexp_full_match({c}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN try_strptime({c}, '%d/%m/%Y')::DATE "
        f"WHEN regexp_full_match({c}, '\\d{{2}}-\\d{{2}}-\\d{{4}}') THEN try_strptime({c}, '%d-%m-%Y')::DATE END"
    )


def num(c: str, t: str = "DECIMAL(18,2)") -> str:
    return f"TRY_CAST(NULLIF({c}, '') AS {t})"


def city(c: str) -> str:
    return f"upper(trim({c}, ' ')[1]) || lower(trim({c}, ' ')[2:])"


def cents_text(c: str) -> str:
    return f"(({c}) // 100)::VARCHAR || '.' || lpad((({c}) % 100)::VARCHAR, 2, '0')"


def ymd(d: str) -> str:
    return f"strftime({d}, '%Y%m%d')::INTEGER"


def sk(*cols: str) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce({c}::VARCHAR, '_null_')" for c in cols) + ")"


def odd_city(base: str, key: str, every: int) -> str:
    return (f"CASE {key} % {2 * every} WHEN 0 THEN lower({base}) || ' ' WHEN {every} THEN upper({base}) ELSE {base} END")


def by_tier(n: str, bronze: int, step: int) -> str:
    """What a plan has: Bronze's value, and so much more for each tier above it (plans 2, 3, 4, 5 are the four tiers)."""
    return f"({bronze} + {step} * (({n} - 2) % 4))"


RAW = {
    "raw_groups": f"""
        SELECT 'EG' || lpad((n_nationkey + 1)::VARCHAR, 4, '0') AS group_id, n_name AS name, r_name AS industry,
               {odd_city("(upper(n_name[1]) || lower(n_name[2:]))", "n_nationkey", 5)} AS city,
               '2024-01-01' AS contract_start, '2027-01-01' AS contract_end,
               (120 + 97 * n_nationkey)::VARCHAR AS lives_covered,
               ((120 + 97 * n_nationkey) * 2500)::VARCHAR || '.00' AS monthly_premium_pkr
        FROM nation, region WHERE n_regionkey = r_regionkey""",
    "raw_policies": f"""
        SELECT 'POL' || lpad(i::VARCHAR, 4, '0') AS policy_id, plan_tier || ' Plan ' || i AS plan_name, plan_tier,
               {by_tier('(i + 4)', 450000, 450000)}::VARCHAR AS annual_limit_pkr,
               {by_tier('(i + 4)', 8500, 8500)}::VARCHAR AS room_rent_cap_pkr,
               {by_tier('(i + 4)', 4200, -1100)}::VARCHAR AS deductible_pkr,
               printf('0.%02d', {by_tier('(i + 4)', 23, -6)}) AS copay_pct,
               CASE plan_tier WHEN 'Bronze' THEN 'False' ELSE 'True' END AS maternity_covered,
               {by_tier('(i + 4)', 10, -2)}::VARCHAR AS pre_existing_waiting_months
        FROM (SELECT i, ['Gold', 'Platinum', 'Bronze', 'Silver'][i % 4 + 1] AS plan_tier
              FROM (SELECT DISTINCT c_custkey % 60 + 1 AS i FROM customer))""",
    "raw_providers": f"""
        SELECT 'PR' || lpad(s_suppkey::VARCHAR, 9, '0') AS provider_id, s_name AS hospital_name,
               {odd_city("(upper(n_name[1]) || lower(n_name[2:]))", "s_suppkey", 10)} AS city,
               ['Hospital', 'Clinic', 'Diagnostic', 'Pharmacy'][s_suppkey % 4 + 1] AS provider_type,
               if(s_suppkey % 10 < 7, 'In-Network', 'Out-of-Network') AS network_status,
               ['A', 'B', 'C'][s_suppkey % 3 + 1] AS tier,
               (DATE '2024-07-01' - ((s_suppkey * 37) % 1825)::INTEGER)::VARCHAR AS panel_since
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_members": f"""
        SELECT 'MB' || lpad(c_custkey::VARCHAR, 9, '0') AS member_id,
               lpad((c_custkey % 100000)::VARCHAR, 5, '0') || '-*******-' || (c_custkey % 10) AS masked_cnic,
               c_name AS name, if(c_custkey % 2 = 0, 'Male', 'Female') AS gender,
               CASE c_custkey % 250 WHEN 1 THEN '2027-01-01' WHEN 2 THEN '1890-01-01'
                    ELSE (DATE '2026-06-30' - ((c_custkey * 7919) % 25000)::INTEGER)::VARCHAR END AS date_of_birth,
               {odd_city("(upper(n_name[1]) || lower(n_name[2:]))", "c_custkey", 20)} AS city,
               'EG' || lpad((c_nationkey + 1)::VARCHAR, 4, '0') AS employer_group_id,
               'POL' || lpad((c_custkey % 60 + 1)::VARCHAR, 4, '0') AS policy_id,
               if(c_custkey % 2 = 1, strftime(DATE '2024-06-30' - ((c_custkey * 13) % 730)::INTEGER, '%d-%m-%Y'),
                  (DATE '2024-06-30' - ((c_custkey * 13) % 730)::INTEGER)::VARCHAR) AS enrolment_date,
               if(c_custkey % 25 = 3, '2026-01-31', '') AS termination_date,
               ['Self', 'Spouse', 'Child'][c_custkey % 3 + 1] AS relationship
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_diagnoses": """
        SELECT 'DX' || lpad(i::VARCHAR, 2, '0') AS diagnosis_code, 'Diagnosis ' || i AS description,
               'Chapter ' || (i % 13) AS chapter
        FROM (SELECT DISTINCT (o_orderkey * 7 + o_custkey) % 26 AS i FROM orders)""",
    "raw_procedures": f"""
        SELECT 'PX' || p_partkey AS procedure_code, p_name AS description, p_type AS category,
               {cents_text("round(p_retailprice * 100)::BIGINT")} AS typical_cost_pkr
        FROM part""",
    # one row per order: numbers before they are turned into text
    "terms": f"""
        SELECT *, CASE WHEN st IN ('Denied', 'Pending') THEN 0 WHEN st = 'Partially Paid' THEN whole // 2
                       ELSE whole END::BIGINT AS share
        FROM (SELECT o_orderkey AS k, o_custkey AS ck, o_custkey % 60 + 1 AS pol_no, o_totalprice, o_orderdate,
                     CASE WHEN o_orderstatus = 'F' THEN 'Paid'
                          WHEN o_orderstatus = 'P' THEN if(o_orderkey % 2 = 0, 'Partially Paid', 'Denied')
                          WHEN o_orderkey % 4 = 0 THEN 'Pending' WHEN o_orderkey % 4 = 1 THEN 'In Review'
                          ELSE 'Paid' END AS st,
                     {by_tier('(o_custkey % 60 + 5)', 6900, 650)} AS whole
              FROM orders)""",
    "events_of_claim": """
        SELECT t.*, (k * 31 + ck) % (SELECT count(*) FROM supplier) AS pk,
               ['Inpatient', 'Outpatient', 'Daycare', 'Pharmacy', 'Diagnostic', 'Maternity', 'Emergency'][k % 7 + 1] AS kind,
               k % 20 < 11 AS auto,
               DATE '2024-07-01' + (date_diff('day', DATE '1995-01-01', o_orderdate::DATE) % 730)::INTEGER AS adm
        FROM terms t""",
    "amounts_of_claim": f"""
        SELECT *, least(appr, greatest(ded * 100, (appr * cop) // 100)) AS mshare,
               dis + (k * 5 % 17)::INTEGER AS sub
        FROM (SELECT *, (bil * share) // 10000 AS appr, {by_tier('(pol_no + 4)', 4200, -1100)}::BIGINT AS ded,
                     {by_tier('(pol_no + 4)', 23, -6)} AS cop
              FROM (SELECT *, adm + if(kind IN ('Inpatient', 'Maternity', 'Emergency'), 2 + k * 3 % 8, 0)::INTEGER AS dis,
                           round(o_totalprice * 100)::BIGINT * if(pk % 40 = 7, 3, 1) AS bil
                    FROM events_of_claim))""",
    "raw_single": f"""
        SELECT k, 'CLM' || lpad(k::VARCHAR, 10, '0') AS claim_id,
               if(k % 1000 BETWEEN 200 AND 202, 'MB999999', 'MB' || lpad(ck::VARCHAR, 9, '0')) AS member_id,
               if(k % 1000 BETWEEN 203 AND 204, 'PR9999', 'PR' || lpad(pk::VARCHAR, 9, '0')) AS provider_id,
               'POL' || lpad(pol_no::VARCHAR, 4, '0') AS policy_id, kind AS claim_type,
               adm::VARCHAR AS admission_date,
               if(k % 1000 BETWEEN 300 AND 307, adm - (1 + k % 4)::INTEGER, dis)::VARCHAR AS discharge_date,
               if(k % 2 = 1, strftime(sub, '%d/%m/%Y'), sub::VARCHAR) AS submission_date,
               coalesce(adj::VARCHAR, '') AS adjudication_date,
               if(st IN ('Paid', 'Partially Paid'), (adj + (3 + k * 11 % 23)::INTEGER)::VARCHAR, '') AS payment_date,
               st AS status, if(st = 'Denied', 'DR' || lpad((k % 10 + 1)::VARCHAR, 2, '0'), '') AS denial_reason_code,
               CASE WHEN k % 1000 BETWEEN 500 AND 502 THEN '-' || (1 + k % 5000) || '.00'
                    ELSE {cents_text('bil')} END AS billed_amount_pkr,
               CASE WHEN k % 1000 BETWEEN 400 AND 405 THEN {cents_text('(bil * 12) // 10')}
                    ELSE {cents_text('appr')} END AS approved_amount_pkr,
               CASE WHEN k % 1000 BETWEEN 400 AND 405 THEN {cents_text('(bil * 13) // 10')}
                    WHEN st IN ('In Review', 'Pending', 'Denied') THEN '0.00'
                    ELSE {cents_text('appr - mshare')} END AS paid_amount_pkr,
               {cents_text('mshare')} AS member_share_pkr,
               CASE WHEN k % 1000 BETWEEN 100 AND 114 THEN '' WHEN auto THEN 'Auto' ELSE 'Manual' END AS adjudication_mode
        FROM (SELECT *, CASE WHEN st <> 'Pending' THEN sub + if(auto, k * 3 % 5, 11 + k * 7 % 26)::INTEGER END AS adj
              FROM amounts_of_claim)""",
    "raw_headers": """
        SELECT * EXCLUDE (k) FROM raw_single
        UNION ALL
        SELECT * EXCLUDE (k) REPLACE ('CLMDUP' || lpad(k::VARCHAR, 10, '0') AS claim_id)
        FROM raw_single WHERE k % 1000 < 20""",
    "raw_lines": f"""
        SELECT concat_ws('-', k, l_linenumber, l_partkey, l_suppkey, qty, bil, strftime(l_shipdate, '%Y%m%d')) AS claim_line_id,
               'CLM' || lpad(k::VARCHAR, 10, '0') AS claim_id, l_linenumber::VARCHAR AS line_no,
               'PX' || l_partkey AS procedure_code,
               'DX' || lpad(((k * 7 + ck) % 26)::VARCHAR, 2, '0') AS diagnosis_code, qty::VARCHAR AS quantity,
               {cents_text('(2 * bil + qty) // (2 * qty)')} AS unit_price_pkr,
               {cents_text('bil')} AS line_billed_pkr, {cents_text('(bil * share) // 10000')} AS line_approved_pkr
        FROM (SELECT *, l_quantity::BIGINT AS qty, round(l_extendedprice * 100)::BIGINT AS bil
              FROM lineitem JOIN terms ON l_orderkey = k)""",
}

STAGED = {
    "st_groups": f"""
        SELECT group_id, name, industry, {city('city')} AS city, {pdate('contract_start')} AS contract_start,
               {pdate('contract_end')} AS contract_end, {num('lives_covered', 'INTEGER')} AS lives_covered,
               {num('monthly_premium_pkr')} AS monthly_premium_pkr FROM raw_groups""",
    "st_policies": f"""
        SELECT policy_id, plan_name, plan_tier, {num('annual_limit_pkr')} AS annual_limit_pkr,
               {num('room_rent_cap_pkr')} AS room_rent_cap_pkr, {num('deductible_pkr')} AS deductible_pkr,
               {num('copay_pct', 'DECIMAL(9,4)')} AS copay_pct, lower(maternity_covered) = 'true' AS maternity_covered,
               {num('pre_existing_waiting_months', 'INTEGER')} AS pre_existing_waiting_months FROM raw_policies""",
    "st_providers": f"""
        SELECT * REPLACE ({city('city')} AS city, {pdate('panel_since')} AS panel_since) FROM raw_providers""",
    "st_members": f"""
        SELECT *, date_diff('day', date_of_birth, DATE '2026-06-30')::INTEGER // 365 AS age_years
        FROM (SELECT * REPLACE ({pdate('date_of_birth')} AS date_of_birth, {city('city')} AS city,
                                {pdate('enrolment_date')} AS enrolment_date, {pdate('termination_date')} AS termination_date)
              FROM raw_members)""",
    "st_procedures": f"SELECT * REPLACE ({num('typical_cost_pkr')} AS typical_cost_pkr) FROM raw_procedures",
    "st_headers": f"""
        SELECT * REPLACE (
            {', '.join(f"{pdate(c)} AS {c}" for c in ('admission_date', 'discharge_date', 'submission_date',
                                                      'adjudication_date', 'payment_date'))},
            {', '.join(f"{num(c)} AS {c}" for c in ('billed_amount_pkr', 'approved_amount_pkr', 'paid_amount_pkr',
                                                    'member_share_pkr'))},
            NULLIF(denial_reason_code, '') AS denial_reason_code, NULLIF(adjudication_mode, '') AS adjudication_mode)
        FROM raw_headers""",
    "st_lines": f"""
        SELECT * REPLACE ({num('line_no', 'INTEGER')} AS line_no,
            {', '.join(f"{num(c)} AS {c}" for c in ('quantity', 'unit_price_pkr', 'line_billed_pkr', 'line_approved_pkr'))})
        FROM raw_lines""",
}

STAR = {
    "good_members": """
        SELECT * FROM st_members
        WHERE date_of_birth <= DATE '2026-06-30' AND age_years >= 0 AND age_years <= 120""",
    "first_claims": """
        SELECT h.* FROM st_headers h
        WHERE NOT EXISTS (SELECT 1 FROM st_headers o
            WHERE o.member_id = h.member_id AND o.provider_id = h.provider_id
              AND o.admission_date IS NOT DISTINCT FROM h.admission_date
              AND o.billed_amount_pkr IS NOT DISTINCT FROM h.billed_amount_pkr AND o.claim_id < h.claim_id)""",
    "good_claims": """
        SELECT f.*, date_diff('day', discharge_date, submission_date)::INTEGER AS days_discharge_to_submit,
               date_diff('day', submission_date, adjudication_date)::INTEGER AS days_submit_to_adjudicate,
               date_diff('day', adjudication_date, payment_date)::INTEGER AS days_adjudicate_to_pay,
               date_diff('day', admission_date, discharge_date)::INTEGER AS length_of_stay
        FROM first_claims f
        WHERE EXISTS (SELECT 1 FROM good_members g WHERE g.member_id = f.member_id)
          AND EXISTS (SELECT 1 FROM raw_providers p WHERE p.provider_id = f.provider_id)
          AND NOT (adjudication_mode IS NULL OR billed_amount_pkr <= 0 OR least(approved_amount_pkr, paid_amount_pkr) < 0
                   OR billed_amount_pkr < approved_amount_pkr OR approved_amount_pkr < paid_amount_pkr
                   OR admission_date > discharge_date)""",
    "cal": f"""
        SELECT {ymd('d')} AS date_key, d AS date_day, year(d)::INTEGER AS calendar_year, quarter(d)::INTEGER AS calendar_quarter,
               month(d)::INTEGER AS month_number, strftime(d, '%b') AS month_name_short, strftime(d, '%B') AS month_name,
               strftime(d, '%Y-%m') AS year_month, day(d)::INTEGER AS day_of_month, isodow(d)::INTEGER AS iso_day_of_week,
               isodow(d) > 5 AS is_weekend, month(d + 1) <> month(d) AS is_month_end,
               (year(d) + (month(d) > 6)::INTEGER)::INTEGER AS fiscal_year,
               ((month(d) + 5) % 12 // 3 + 1)::INTEGER AS fiscal_quarter
        FROM (SELECT (DATE '2024-01-01' + i::INTEGER) AS d FROM range(1461) r(i))""",
    "d_member": f"""
        SELECT {sk('member_id', 'enrolment_date')} AS member_sk, member_id, masked_cnic, name, gender, date_of_birth, age_years,
               CASE WHEN age_years >= 60 THEN '60+' WHEN age_years >= 45 THEN '45-59' WHEN age_years >= 30 THEN '30-44'
                    WHEN age_years >= 18 THEN '18-29' ELSE '0-17' END AS age_band,
               city, employer_group_id, policy_id, relationship, enrolment_date, termination_date,
               enrolment_date AS valid_from, ifnull(termination_date, DATE '9999-12-31') AS valid_to,
               termination_date IS NULL AS is_current
        FROM good_members""",
    "d_provider": f"""
        SELECT {sk('provider_id', 'panel_since')} AS provider_sk, *, panel_since AS valid_from,
               DATE '9999-12-31' AS valid_to, true AS is_current FROM st_providers""",
    "d_group": f"""
        SELECT {sk('group_id')} AS employer_group_sk, group_id, name AS employer_name, industry, city, contract_start,
               contract_end, lives_covered, monthly_premium_pkr FROM st_groups""",
    "d_policy": f"SELECT {sk('policy_id')} AS policy_sk, * FROM st_policies",
    "d_diagnosis": f"SELECT {sk('diagnosis_code')} AS diagnosis_sk, * FROM raw_diagnoses",
    "d_procedure": f"SELECT {sk('procedure_code')} AS procedure_sk, * FROM st_procedures",
    "f_header": f"""
        SELECT {sk('g.claim_id')} AS claim_sk, g.claim_id, m.member_sk, p.provider_sk, e.employer_group_sk, o.policy_sk,
               g.claim_type, g.status, g.adjudication_mode, g.denial_reason_code,
               {', '.join(f"{ymd('g.' + s + '_date')} AS {s}_date_key" for s in
                          ('admission', 'discharge', 'submission', 'adjudication', 'payment'))},
               g.billed_amount_pkr, g.approved_amount_pkr, g.paid_amount_pkr, g.member_share_pkr,
               (g.billed_amount_pkr - g.approved_amount_pkr)::DECIMAL(18,2) AS savings_pkr, g.length_of_stay,
               g.days_submit_to_adjudicate AS tat_submit_to_adjudicate, g.days_adjudicate_to_pay AS tat_adjudicate_to_pay,
               g.days_submit_to_adjudicate + ifnull(g.days_adjudicate_to_pay, 0) AS tat_total, 1 AS claim_count
        FROM good_claims g JOIN d_member m USING (member_id) JOIN d_provider p USING (provider_id)
        LEFT JOIN d_group e ON e.group_id = m.employer_group_id LEFT JOIN d_policy o ON o.policy_id = g.policy_id""",
    "good_lines": """
        SELECT l.* FROM st_lines l JOIN good_claims USING (claim_id)
        WHERE quantity > 0 AND line_billed_pkr >= 0 AND line_approved_pkr >= 0""",
    "f_line": f"""
        SELECT {sk('l.claim_line_id')} AS claim_line_sk, l.claim_line_id, l.claim_id, l.line_no, h.member_sk, h.provider_sk,
               {sk('d.diagnosis_code')} AS diagnosis_sk, {sk('p.procedure_code')} AS procedure_sk, h.submission_date_key,
               h.claim_type, h.status, l.procedure_code, l.diagnosis_code, l.quantity, l.unit_price_pkr, l.line_billed_pkr,
               l.line_approved_pkr, (l.line_billed_pkr - l.line_approved_pkr)::DECIMAL(18,2) AS line_savings_pkr
        FROM good_lines l JOIN f_header h USING (claim_id)
        JOIN raw_diagnoses d ON d.diagnosis_code = l.diagnosis_code JOIN raw_procedures p ON p.procedure_code = l.procedure_code""",
    "f_month": f"""
        SELECT {sk('g.member_id', "date_trunc('month', submission_date)::DATE")} AS member_month_sk, m.member_sk, g.member_id,
               m.employer_group_id, m.policy_id, date_trunc('month', submission_date)::DATE AS month_start,
               {ymd("date_trunc('month', submission_date)::DATE")} AS month_key, count(*) AS claim_count,
               sum(billed_amount_pkr) AS billed_amount_pkr, sum(approved_amount_pkr) AS approved_amount_pkr,
               sum(paid_amount_pkr) AS paid_amount_pkr, sum(member_share_pkr) AS member_share_pkr
        FROM good_claims g JOIN d_member m ON m.member_id = g.member_id
        WHERE submission_date IS NOT NULL GROUP BY ALL""",
    "claims_x": """
        SELECT f.*, c.date_day AS claim_date, c.year_month, c.month_number, c.month_name_short, c.calendar_year, c.fiscal_year,
               m.member_id, m.gender, m.age_band, m.city AS member_city, m.relationship,
               g.group_id AS employer_group_id, g.employer_name, g.industry, g.monthly_premium_pkr, g.lives_covered,
               p.provider_id, p.hospital_name, p.city AS provider_city, p.provider_type, p.network_status,
               p.tier AS provider_tier, o.plan_tier,
               if(f.status = 'Denied', 1, 0) AS is_denied, if(f.adjudication_mode = 'Auto', 1, 0) AS is_auto
        FROM f_header f LEFT JOIN cal c ON c.date_key = f.submission_date_key
        LEFT JOIN d_member m USING (member_sk) LEFT JOIN d_provider p USING (provider_sk)
        LEFT JOIN d_group g USING (employer_group_sk) LEFT JOIN d_policy o USING (policy_sk)""",
}

CTES: dict[str, str] = {**RAW, **STAGED, **STAR}


def used_by(text: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_]\w*", re.sub(r"'[^']*'", "", text)))
    return [n for n in CTES if n in words]


def with_tables(body: str) -> str:
    """``body`` with the tables it names, and those they name, in front."""
    need: set[str] = set()
    todo = used_by(body)
    while todo:
        n = todo.pop()
        if n not in need:
            need.add(n)
            todo += used_by(CTES[n])
    own = body.strip()
    head = ", ".join(f"{n} AS ({CTES[n].strip()})" for n in CTES if n in need)
    if own.upper().startswith("WITH "):
        return f"WITH {head}, {own[5:]}"
    return f"WITH {head} {own}" if head else own
