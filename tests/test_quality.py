import json

import pytest
from pyspark.sql import functions as F

from medledger.functions import register_sql_functions  # noqa: F401
from medledger.plans.pipeline import AssertionsFailed, Settings, check_marts, run_pipeline
from medledger.quality import assertions, engine
from medledger.quality.rules import RULES, Dimension, FirstOnly, Rule, RowCheck, Severity, UniqueKey, missing, rules_by_dimension
from medledger.sources import versions
from fixtures.claims import injected_defects
from fixtures.planted import planted_marts
from medledger.sources.schemas import RAW_COLUMNS, RAW_TABLES
from tests.test_cleaning import HEADER, MEMBER
from tests.test_sources import write_landing


def test_catalogue():
    assert len(RULES) == len({r.id for r in RULES}) == 39
    assert {d: len(rs) for d, rs in rules_by_dimension().items()} == {
        Dimension.COMPLETENESS: 7, Dimension.VALIDITY: 14, Dimension.CONSISTENCY: 6, Dimension.UNIQUENESS: 5,
        Dimension.ACCURACY: 4, Dimension.TIMELINESS: 3}
    assert {r.severity for r in RULES} == set(Severity)


def test_threshold_is_a_share():
    with pytest.raises(ValueError):
        Rule("x", "x", Dimension.VALIDITY, Severity.LOW, "members", None, missing("name"), threshold=1.5)


@pytest.fixture()
def raw(frame):
    """Raw tables of one clean row each; headers and members can be replaced."""
    def make(headers=None, members=None):
        def t(name, rows):
            return frame(" ".join(RAW_COLUMNS[name]), [[r.get(c, "") for c in RAW_COLUMNS[name]] for r in rows])
        return {
            "claims_header": t("claims_header", [{**HEADER, **h} for h in (headers or [{}])]),
            "members": t("members", [{**MEMBER, "city": "Karachi", **m} for m in (members or [{}])]),
            "providers": t("providers", [dict(provider_id="P1", city="Lahore", provider_type="Clinic", network_status="In-Network")]),
            "policies": t("policies", [dict(policy_id="POL1", plan_tier="Gold", copay_pct="0.1")]),
            "employer_groups": t("employer_groups", [dict(group_id="G1", city="Quetta")]),
            "claims_lines": t("claims_lines", [dict(claim_line_id="L1", claim_id="C1", quantity="2", unit_price_pkr="5", line_billed_pkr="10")]),
        }
    return make


def failures(raw):
    return sorted((r.rule_id, r.record_key) for r in engine.failed_records(raw).collect())


def test_clean_rows_fail_nothing(raw):
    assert failures(raw()) == []


@pytest.mark.parametrize("change,want", [
    (dict(adjudication_mode=""), {"C-HDR-ADJMODE"}),
    (dict(adjudication_mode="auto"), {"V-HDR-ADJMODE"}),
    (dict(member_id=""), {"C-HDR-MEMBERID", "R-HDR-MEMBER-FK"}),
    (dict(member_id=None), {"C-HDR-MEMBERID", "R-HDR-MEMBER-FK"}),
    (dict(provider_id="P9"), {"R-HDR-PROVIDER-FK"}),
    (dict(status="Open"), {"V-HDR-STATUS"}),
    (dict(status=None), set()),
    (dict(claim_type="Dental"), {"V-HDR-CTYPE"}),
    (dict(submission_date="31/02/2025"), {"V-HDR-DATEPARSE"}),
    (dict(submission_date=""), set()),
    (dict(discharge_date="2024-12-31"), {"K-HDR-DISCHARGE"}),
    (dict(submission_date="2025-01-02"), {"K-HDR-SUBMIT"}),
    (dict(submission_date="2025-02-02", adjudication_date="2025-02-03", payment_date=""), set()),
    (dict(submission_date="2025-02-03", adjudication_date="2025-02-03", payment_date=""), {"T-HDR-SUBMIT-LAG"}),
    (dict(adjudication_date="2025-03-06", payment_date=""), set()),
    (dict(adjudication_date="2025-03-07", payment_date=""), {"T-HDR-ADJ-LAG"}),
    (dict(payment_date="2025-01-09"), {"T-HDR-PAYMENT"}),
    (dict(status="Denied"), {"K-HDR-DENIAL"}),
    (dict(denial_reason_code="DR01"), {"K-HDR-DENIAL"}),
    (dict(status="Denied", denial_reason_code="DR01"), set()),
    (dict(approved_amount_pkr="100.01"), {"A-HDR-APPR-BILLED"}),
    (dict(paid_amount_pkr="80.01"), {"A-HDR-PAID-APPR"}),
    (dict(billed_amount_pkr="0"), {"A-HDR-APPR-BILLED", "A-HDR-NONNEG"}),
    (dict(billed_amount_pkr=""), set()),
    (dict(billed_amount_pkr="n/a"), set()),
])
def test_header_rules(raw, change, want):
    assert {r for r, _ in failures(raw([change]))} == want


@pytest.mark.parametrize("change,want", [
    (dict(date_of_birth=""), {"C-MBR-DOB", "V-MBR-AGE"}), (dict(policy_id=""), {"C-MBR-POLICY"}), (dict(gender="F"), {"V-MBR-GENDER"}),
    (dict(relationship="Parent"), {"V-MBR-REL"}), (dict(date_of_birth="2026-07-01"), {"V-MBR-AGE"}),
    (dict(date_of_birth="1906-07-31"), set()), (dict(date_of_birth="1906-07-29"), {"V-MBR-AGE"}),
    (dict(city="karachi"), {"K-MBR-CITY"}), (dict(city="Karachi "), {"K-MBR-CITY"}), (dict(city="Al-Shifa"), set()),
    (dict(city="Al-shifa"), {"K-MBR-CITY"}),
])
def test_member_rules(raw, change, want):
    assert {r for r, _ in failures(raw(members=[change]))} == want


def test_repeated_keys_count_once_and_a_missing_key_has_a_name(raw):
    r = raw([dict(claim_id=None, billed_amount_pkr="1", approved_amount_pkr="1", paid_amount_pkr="1"),
             dict(claim_id=None, billed_amount_pkr="2", approved_amount_pkr="1", paid_amount_pkr="1"),
             dict(claim_id="C1"), dict(claim_id="C1", billed_amount_pkr="200"), dict(claim_id="C1", billed_amount_pkr="300")])
    got = failures(r)
    assert [x for x in got if x[0] == "U-HDR-CLAIMID"] == [("U-HDR-CLAIMID", "C1"), ("U-HDR-CLAIMID", "None")]
    assert got.count(("C-HDR-CLAIMID", "None")) == 2


def test_scores_weigh_severity(spark):
    def overall(*rows):
        df = spark.createDataFrame([(s, "validity", "t", f, f == 0) for s, f in rows],
                                   "severity string, dimension string, table_name string, fail_rate double, passed boolean")
        return engine.score(df).first()["score"]
    assert overall(("high", 0.0)) == 100.0
    assert overall(("high", 1.0)) == 0.0
    assert overall(("low", 1.0), ("critical", 0.0)) == pytest.approx(100 * 8 / 9)
    assert overall(("low", 0.0), ("critical", 1.0)) == pytest.approx(100 / 9)
    assert overall() == 100.0


def test_counts_without_rows_are_a_pass(raw, frame):
    r = raw()
    r["members"] = r["members"].limit(0)
    rules = [x for x in RULES if x.table == "members"]
    res = engine.results(r, engine.failed_records(r, rules), rules).collect()
    assert {(x.rows_checked, x.fail_rate, x.passed) for x in res} == {(0, 0.0, True)}


def test_threshold_allows_a_share(raw):
    r = raw([dict(claim_id=f"C{i}", billed_amount_pkr=f"{100 + i}", adjudication_mode="" if i == 1 else "Auto") for i in range(1, 5)])
    def passed(threshold):
        rule = Rule("t", "t", Dimension.COMPLETENESS, Severity.LOW, "claims_header", None, missing("adjudication_mode"), threshold=threshold)
        return engine.results(r, engine.failed_records(r, [rule]), [rule]).first().passed
    assert (passed(0.0), passed(0.24), passed(0.25)) == (False, False, True)


def test_fused_counts_equal_one_rule_at_a_time(claims):
    fused = {r.rule_id: r.rows_failed for r in claims.quality.results.collect()}
    single = {r.id: engine.failed_records(claims.raw, [r]).count() for r in RULES if not isinstance(r.check, RowCheck)
              or r.id in ("K-HDR-DENIAL", "V-MBR-AGE", "A-LINE-MATH", "C-HDR-ADJMODE")}
    assert {k: fused[k] for k in single} == single


def test_every_injected_defect_is_caught(claims):
    r = engine.reconcile_defects(claims.quality.results, injected_defects(claims.source)).collect()
    assert len(r) == 11 and all(x.matches for x in r)
    counts = {x.rule_id: x.rows_failed for x in claims.quality.results.collect()}
    injected = {x.defect: x.injected for x in r}
    assert counts["A-HDR-APPR-BILLED"] == injected["amount_violations"] + injected["nonpositive_amounts"]
    assert injected["duplicate_claims"] == 40 and engine.critical_failures(claims.quality.results).count() == 0
    assert 80 <= claims.quality.overall_score() <= 100


def test_runs_accumulate_and_a_repeat_replaces(lake, raw):
    r = raw([dict(adjudication_mode="")])
    a, b = engine.run(lake, r), engine.run(lake, r)
    assert (a.run_id, b.run_id) == (1, 2)
    with pytest.raises(engine.RunExists):
        engine.run(lake, r, run_id=2)
    engine.run(lake, r, run_id=2, replace=True)
    stored = lake.read("dq", "dq_results")
    assert stored.groupBy("run_id").count().orderBy("run_id").collect() == [(1, 39), (2, 39)]
    assert lake.read("dq", "dq_failed_records").count() == 2
    assert engine.latest_run(stored).select("run_id").distinct().collect() == [(2,)]
    assert [(t.run_id, t.total_failed) for t in engine.trend(stored).collect()] == [(1, 1), (2, 1)]


def test_report_shape(claims):
    doc = json.loads(engine.report(claims.quality.results).toJSON().first())
    assert set(doc) == {"run_id", "run_ts", "overall_score", "dimension_scores", "table_scores", "critical_failures", "rules"}
    assert len(doc["rules"]) == 39 and doc["rules"][0]["rule_id"] == "C-HDR-ADJMODE" and doc["critical_failures"] == []
    assert set(doc["rules"][0]) >= {"name", "dimension", "severity", "table", "column", "rows_checked", "rows_failed", "fail_rate", "passed"}
    assert set(doc["dimension_scores"]) == {d.value for d in Dimension}


def test_assertions_all_pass_and_number_89(claims):
    rows = assertions.evaluate(claims.models()).collect()
    assert len({r.assertion for r in rows}) == len(rows) == 89
    assert [r for r in rows if r.failures] == []


def test_assertions_see_broken_marts(claims):
    m = dict(claims.models())
    m["fct_claim_header"] = m["fct_claim_header"].union(m["fct_claim_header"].limit(1))
    bad = {r.assertion for r in assertions.evaluate(m).collect() if r.failures}
    assert {"unique_fct_claim_header_claim_id", "unique_fct_claim_header_claim_sk", "no_duplicate_business_claims"} <= bad


def test_every_kind_of_assertion_bites(claims):
    planted = planted_marts(claims.models())
    rows = {r.assertion: r for r in assertions.evaluate(planted).collect()}
    assert len(rows) == 89
    failing = {n: r.failures for n, r in rows.items() if r.failures}
    assert {rows[n].kind for n in failing} == {"unique", "not_null", "accepted_values", "relationships", "business"}
    assert {n for n, r in rows.items() if r.kind == "business"} <= set(failing)
    header = planted["fct_claim_header"]
    assert failing["unique_fct_claim_header_claim_id"] == header.groupBy("claim_id").count().filter("count > 1").count()
    for c, parent in (("member_sk", "dim_member"), ("policy_sk", "dim_policy")):
        lost = header.filter(f"{c} IS NOT NULL").join(planted[parent].select(c).distinct(), c, "left_anti").count()
        assert failing[f"relationships_fct_claim_header_{c}"] == lost > 0


def test_keys_are_folded_by_digest_and_lost_lines_without_another_join(claims):
    m = dict(claims.models())
    m["fct_claim_line"] = m["fct_claim_line"].withColumn(
        "claim_id", F.expr("CASE right(claim_line_id, 1) WHEN '1' THEN 'none' WHEN '2' THEN NULL ELSE claim_id END"))
    lost = m["fct_claim_line"].join(m["fct_claim_header"], "claim_id", "left_anti").count()
    found = assertions.evaluate(m)
    rows = {r.assertion: r.failures for r in found.collect()}
    assert rows["lines_have_header"] == lost == (
        rows["relationships_fct_claim_line_claim_id"] + rows["not_null_fct_claim_line_claim_id"]) and len(rows) == 89
    assert 0 < rows["not_null_fct_claim_line_claim_id"] < lost
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan and "hashpartitioning(key" not in plan and "hashpartitioning(member_sk" not in plan


def test_a_missing_value_is_told_from_the_others_in_a_digest(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), (None, None), ("", None)], "x string, y string")
    assert rows.select(*assertions.digest(F.col("x"), F.col("y"))).distinct().count() == 5


def test_key_checks_are_one_aggregation(claims):
    plan = assertions.key_assertions(claims.models())[0]._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) <= 4, shuffles  # by key, by space, and the join with the list of checks


def test_pipeline_end_to_end(claims, lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_landing(claims, landing)
    marts = run_pipeline(lake, Settings(str(landing)))
    for t in ("fct_claim_header", "fct_claim_line", "fct_monthly_member_summary"):
        assert marts[t].exceptAll(claims.marts[t].select(*marts[t].columns)).count() == 0
        assert marts[t].count() == claims.marts[t].count()
    assert lake.read("exports", "claims_detail").count() == marts["fct_claim_header"].count()
    assert lake.spark.read.json(lake.path("exports", "dq_report")).first().overall_score > 80
    assert lake.spark.table("v_pmpm").count() > 0
    assert versions.open_version(lake).read("raw", "_ingest_audit").count() == len(RAW_TABLES)


def test_gate_stops_before_the_star(claims, lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_landing(claims, landing)
    p = landing / "providers.csv"
    text = p.read_text().splitlines()
    p.write_text("\n".join([*text, text[-1]]) + "\n")
    with pytest.raises(engine.QualityGateError) as e:
        run_pipeline(lake, Settings(str(landing)))
    assert e.value.rule_ids == ["U-PRV-ID"] and e.value.exit_code == 2
    assert versions.numbers(lake) == []
    assert lake.read("dq", "dq_results").count() == 39


def test_failed_assertion_is_reported(claims):
    m = dict(claims.marts)
    m["dim_member"] = m["dim_member"].withColumn("age_years", m["dim_member"].age_years + 200)
    with pytest.raises(AssertionsFailed, match="no_impossible_ages"):
        check_marts(claims.lake, m)
