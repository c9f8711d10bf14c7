"""The traps of cleaning and of the star, on hand-written rows."""

import datetime as dt

import pytest

from medledger.operators import star as star_ops
from medledger.operators.cleaning import clean_claims, clean_lines, clean_members, first_per_signature, sound_claims
from medledger.operators.joins import as_of_join, null_safe_join, restrict
from medledger.operators.staging import stage
from medledger.sources.schemas import RAW_COLUMNS

HEADER = dict(
    claim_id="C1", member_id="M1", provider_id="P1", policy_id="POL1", claim_type="Inpatient", admission_date="2025-01-01",
    discharge_date="2025-01-03", submission_date="05/01/2025", adjudication_date="2025-01-10", payment_date="2025-01-20",
    status="Paid", denial_reason_code="", billed_amount_pkr="100.00", approved_amount_pkr="80.00", paid_amount_pkr="70.00",
    member_share_pkr="10.00", adjudication_mode="Auto")


@pytest.fixture()
def headers(frame):
    def make(*rows):
        cols = RAW_COLUMNS["claims_header"]
        return stage("claims_header", frame(" ".join(cols), [[{**HEADER, **r}[c] for c in cols] for r in rows]))
    return make


def ids(df, col="claim_id"):
    return sorted(r[col] for r in df.select(col).collect())


def test_first_copy_wins_on_typed_values(headers):
    h = headers(dict(claim_id="C2", admission_date="01/01/2025", billed_amount_pkr="100"), dict(claim_id="C1"), dict(claim_id="C3"))
    assert ids(first_per_signature(h)) == ["C1"]


def test_invalid_first_copy_hides_the_group(headers):
    """De-duplicate first, check second."""
    h = headers(dict(claim_id="C1", adjudication_mode=""), dict(claim_id="C2"))
    assert ids(sound_claims(h)) == []


def test_missing_signature_parts_group_together(headers):
    h = headers(dict(claim_id="C1", admission_date="", discharge_date=""), dict(claim_id="C2", admission_date="", discharge_date=""))
    assert ids(first_per_signature(h)) == ["C1"]


@pytest.mark.parametrize("change", [
    dict(adjudication_mode=""), dict(billed_amount_pkr="0"), dict(billed_amount_pkr=""), dict(billed_amount_pkr="x"),
    dict(approved_amount_pkr="-1"), dict(paid_amount_pkr="-0.01"), dict(approved_amount_pkr="100.01"),
    dict(paid_amount_pkr="80.01"), dict(discharge_date="2024-12-31"), dict(discharge_date=""), dict(admission_date="31/02/2025"),
])
def test_unsound_rows_are_dropped(headers, change):
    assert sound_claims(headers(change)).count() == 0


def test_sound_row_and_turnaround(headers):
    r = sound_claims(headers({})).first()
    assert (r.days_discharge_to_submit, r.days_submit_to_adjudicate, r.days_adjudicate_to_pay, r.length_of_stay) == (2, 5, 10, 2)


MEMBER = dict(member_id="M1", masked_cnic="1-*-1", name="n", gender="Male", date_of_birth="1990-01-01", city="karachi ",
              employer_group_id="G1", policy_id="POL1", enrolment_date="2024-01-01", termination_date="", relationship="Self")


@pytest.fixture()
def members(frame):
    def make(*rows):
        cols = RAW_COLUMNS["members"]
        return stage("members", frame(" ".join(cols), [[{**MEMBER, **r}[c] for c in cols] for r in rows]))
    return make


def test_age_bounds_of_cleaning(members, spark):
    end = dt.date(2026, 6, 30)
    rows = [dict(member_id=f"D{n}", date_of_birth=str(end - dt.timedelta(days=n))) for n in (-1, 0, 43800, 43801, 44164, 44165)]
    rows.append(dict(member_id="Dx", date_of_birth=""))
    assert ids(clean_members(members(*rows)), "member_id") == ["D0", "D43800", "D43801", "D44164"]


def test_claims_need_known_member_and_provider(headers, members, frame):
    h = headers(dict(claim_id="A"), dict(claim_id="B", member_id="M9"), dict(claim_id="C", provider_id="P9"))
    prov = frame("provider_id", [("P1",)])
    assert ids(clean_claims(h, members({}), prov)) == ["A"]


def small_star(spark, headers, members, frame, header_rows, line_rows=()):
    """The star over a few rows, through the same builders as the real one."""
    def staged(table, rows):
        cols = RAW_COLUMNS[table]
        return stage(table, frame(" ".join(cols), [[r.get(c, "") for c in cols] for r in rows]))
    s = {
        "members": members({}, dict(member_id="M2", termination_date="2025-06-30")),
        "providers": staged("providers", [dict(provider_id=p, hospital_name=f"H{p}", provider_type="Clinic",
                                               network_status=n, panel_since="2020-01-01") for p, n in
                                          (("P1", "In-Network"), ("P2", "Out-of-Network"), ("P3", "In-Network"))]),
        "employer_groups": staged("employer_groups", [dict(group_id="G1", name="One", monthly_premium_pkr="10"),
                                                      dict(group_id="G2", name="Two", monthly_premium_pkr="0"),
                                                      dict(group_id="G3", name="Three", monthly_premium_pkr="5")]),
        "policies": staged("policies", [dict(policy_id="POL1", plan_tier="Gold")]),
        "diagnoses": staged("diagnoses", [dict(diagnosis_code="D1", chapter="X"), dict(diagnosis_code="D2", chapter="Y")]),
        "procedures": staged("procedures", [dict(procedure_code="R1", description="r", category="c")]),
        "claims_header": headers(*header_rows),
        "claims_lines": staged("claims_lines", line_rows),
    }
    dims = star_ops.dimensions(spark, s)
    h = star_ops.fct_claim_header(s["claims_header"], dims)
    return {**dims, "fct_claim_header": h, "fct_claim_line": star_ops.fct_claim_line(s["claims_lines"], h, dims),
            "fct_monthly_member_summary": star_ops.fct_monthly_member_summary(h, dims["dim_member"])}, s


@pytest.fixture()
def star(spark, headers, members, frame):
    return lambda h, lines=(): small_star(spark, headers, members, frame, h, lines)


def test_terminated_members_keep_their_claims(star):
    s, _ = star([dict(member_id="M2")])
    assert s["fct_claim_header"].join(s["dim_member"], "member_sk").first().is_current is False


def test_total_turnaround_is_null_until_adjudicated(star):
    s, _ = star([dict(claim_id="A", status="Pending", adjudication_date="", payment_date=""),
                 dict(claim_id="B", payment_date="", provider_id="P2"), dict(claim_id="C", provider_id="P3")])
    got = {r.claim_id: r.tat_total for r in s["fct_claim_header"].collect()}
    assert got == {"A": None, "B": 5, "C": 15}


def test_lines_follow_their_claim(star):
    line = dict(claim_id="C1", line_no="1", procedure_code="R1", diagnosis_code="D1", quantity="1", unit_price_pkr="5",
                line_billed_pkr="5", line_approved_pkr="4")
    s, staged = star([{}], [dict(line, claim_line_id="L1"), dict(line, claim_line_id="L2", claim_id="C9"),
                            dict(line, claim_line_id="L3", quantity="0"), dict(line, claim_line_id="L4", line_billed_pkr="-1"),
                            dict(line, claim_line_id="L5", procedure_code="R9")])
    assert ids(s["fct_claim_line"], "claim_line_id") == ["L1", "L5"]
    r = {x.claim_line_id: x for x in s["fct_claim_line"].collect()}
    assert r["L5"].procedure_sk is None and float(r["L1"].line_savings_pkr) == 1.0
    assert ids(clean_lines(staged["claims_lines"], s["fct_claim_header"]), "claim_line_id") == ["L1", "L5"]


def test_calendar(spark):
    d = star_ops.dim_date(spark)
    assert d.count() == 1461
    r = d.filter("date_key = 20240630").first()
    assert (r.fiscal_year, r.fiscal_quarter, r.is_weekend, r.is_month_end, r.iso_day_of_week, r.month_name) == (
        2024, 4, True, True, 7, "June")
    r = d.filter("date_key = 20240701").first()
    assert (r.fiscal_year, r.fiscal_quarter, r.year_month) == (2025, 1, "2024-07")


def test_as_of_join_picks_the_valid_version(spark):
    v = spark.sql("SELECT * FROM VALUES ('M', DATE'2024-01-01', DATE'2024-12-31', 1), ('M', DATE'2025-01-01', DATE'9999-12-31', 2)"
                  " t(member_id, valid_from, valid_to, ver)")
    f = spark.sql("SELECT * FROM VALUES ('M', DATE'2024-12-31'), ('M', DATE'2025-01-01'), ('M', DATE'2023-01-01'), ('X', DATE'2025-01-01')"
                  " t(member_id, day)")
    got = sorted((r.member_id, str(r.day), r.ver) for r in as_of_join(f, v, "member_id", "day").collect())
    assert got == [("M", "2023-01-01", None), ("M", "2024-12-31", 1), ("M", "2025-01-01", 2), ("X", "2025-01-01", None)]


def test_null_safe_join_matches_nulls(spark):
    a = spark.sql("SELECT * FROM VALUES (1, 'x'), (NULL, 'y') t(k, a)")
    b = spark.sql("SELECT * FROM VALUES (NULL, 'z') t(k, b)")
    assert [(r.k, r.a, r.b) for r in null_safe_join(a, b, ["k"]).collect()] == [(None, "y", "z")]


def test_restrict_to_a_users_groups(spark):
    df = spark.sql("SELECT * FROM VALUES ('G1', 1), ('G2', 2), (NULL, 3) t(employer_group_id, v)")
    users = spark.sql("SELECT * FROM VALUES ('a@x', 'G1'), ('a@x', 'G1'), ('b@x', 'G2') t(email, group_id)")
    assert [r.v for r in restrict(df, users, "a@x").collect()] == [1]
    assert restrict(df, users, "nobody").count() == 0
