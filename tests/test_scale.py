"""Plans and results under skew: what must hold when one key owns a third of the rows."""

import hashlib
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from medledger.operators import star as star_ops
from medledger.operators.cleaning import first_per_signature
from medledger.operators.staging import stage
from medledger.plans import clinical, consumers, financial, operations, views
from medledger.quality import engine
from medledger.quality.rules import RULES, RowCheck
from medledger.sources.schemas import RAW_COLUMNS
from tests.test_cleaning import HEADER


@contextmanager
def conf(spark, **settings):
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
TINY_SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__coalescePartitions__minPartitionSize": "1KB",
    "spark__sql__shuffle__partitions": "16",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ran_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def many_headers(spark, n, member, signature_amount, **more):
    """``n`` raw headers; ``member``, ``signature_amount`` and ``more`` are SQL over ``id``."""
    over = {"claim_id": "concat('C', lpad(cast(id AS string), 7, '0'))", "member_id": member, "billed_amount_pkr": signature_amount,
            **more}
    cols = [f"{over[c]} AS {c}" if c in over else f"'{HEADER[c]}' AS {c}" for c in RAW_COLUMNS["claims_header"]]
    return spark.range(0, n, 1, 8).selectExpr(*cols)


def test_member_with_a_third_of_the_claims_is_split(spark, claims):
    raw = many_headers(
        spark, 30000, "CASE WHEN id % 3 = 0 THEN 'M0' ELSE concat('M', id % 997) END", "cast(100 + id AS string)",
        provider_id="concat('P', id % 97)", denial_reason_code="md5(cast(id AS string))")
    dims = dict(claims.marts)
    dims["dim_member"] = spark.range(997).selectExpr(
        "concat('M', id) AS member_id", "md5(concat('M', id)) AS member_sk", "concat('EG000', 1 + id % 5) AS employer_group_id")
    dims["dim_provider"] = spark.range(97).selectExpr("concat('P', id) AS provider_id", "md5(concat('P', id)) AS provider_sk")
    with conf(spark, **NO_BROADCAST, **TINY_SKEW):
        fact = star_ops.fct_claim_header(stage("claims_header", raw), dims)
        rows = fact.collect()
        p = plan(fact).split("== Initial Plan ==")[0]
    assert "skew=true" in p
    hot = sum(r.member_sk == rows_key("M0") for r in rows)
    assert len(rows) == 30000 and hot == sum(1 for i in range(30000) if i % 3 == 0 or i % 997 == 0)


def rows_key(member):
    return hashlib.md5(member.encode()).hexdigest()


def test_signature_with_a_third_of_the_claims_is_cut_before_the_shuffle(spark):
    raw = many_headers(spark, 30000, "CASE WHEN id % 3 = 0 THEN 'M0' ELSE concat('M', id) END",
                       "CASE WHEN id % 3 = 0 THEN '100' ELSE cast(100 + id AS string) END")
    kept = first_per_signature(stage("claims_header", raw))
    p = plan(kept)
    assert re.search(r"row_number\(\), 1, Partial", p) and re.search(r"row_number\(\), 1, Final", p)
    rows = kept.filter("member_id = 'M0'").collect()
    assert [r.claim_id for r in rows] == ["C0000000"] and kept.count() == 20001


def test_surplus_of_a_hot_signature_is_whole(spark):
    raw = many_headers(spark, 9000, "CASE WHEN id % 3 = 0 THEN 'M0' ELSE concat('M', id) END",
                       "CASE WHEN id % 3 = 0 THEN '100' ELSE cast(100 + id AS string) END")
    bad = engine.failed_records({"claims_header": raw}, [r for r in RULES if r.id == "U-HDR-BIZDUP"])
    assert bad.count() == 2999 and bad.filter("record_key = 'C0000000'").count() == 0


def test_readmissions_of_one_busy_member(spark):
    """All stays on one member and chapter: pairs against arithmetic, and no unkeyed join."""
    stays = spark.range(300).selectExpr(
        "concat('C', id) AS claim_id", "'m' AS member_sk", "'Inpatient' AS claim_type",
        "int(date_format(date_add(date'2025-01-01', cast(id AS int)), 'yyyyMMdd')) AS admission_date_key")
    lines = spark.range(300).selectExpr(
        "concat('C', id) AS claim_id", "'Inpatient' AS claim_type", "'d' AS diagnosis_sk", "1 AS line_no", "concat('L', id) AS claim_line_id")
    star = {"fct_claim_header": stays, "fct_claim_line": lines,
            "dim_diagnosis": spark.sql("SELECT 'd' AS diagnosis_sk, 'X' AS chapter")}
    with conf(spark, **NO_BROADCAST):
        df = clinical.v_readmissions(star)
        assert df.count() == sum(min(30, 299 - i) for i in range(300))
        assert "block" in plan(df)


def test_no_view_multiplies_tables(spark, claims):
    """Without any broadcast, every join of every view still has an equality key."""
    with conf(spark, **NO_BROADCAST):
        for name, df in views.all_views(claims.marts, claims.raw["claims_header"]).items():
            p = plan(df)
            assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_monthly_views_touch_only_the_calendar(spark, claims):
    with conf(spark, **NO_BROADCAST):
        p = plan(financial.v_financial_monthly(claims.marts))
        assert p.count("FileScan") == 2 and "SortMergeJoin" not in p
        fact = next(s for s in p.split("FileScan")[1:] if "billed_amount_pkr" in s)
        schema = fact.split("ReadSchema:")[1].splitlines()[0]
        assert "claim_id" not in schema and "status" not in schema


def test_filters_reach_the_files(claims):
    p = plan(operations.v_claims_ageing(claims.marts))
    assert "In(status, [In Review,Pending])" in p or "In(status, [Pending,In Review])" in p
    p = plan(consumers.executive_monthly(claims.marts, consumers.Filters(date_from="2025-01-01", date_to="2025-03-31",
                                                                        claim_types=("Inpatient",))))
    fact = next(x for x in p.split("FileScan")[1:] if "claim_type" in x)
    assert "submission_month" in fact.split("PartitionFilters: [")[1].split("]")[0]
    assert "claim_type" in fact.split("PushedFilters: [")[1].split("ReadSchema")[0]


def test_row_rules_share_one_scan_and_one_parse(claims):
    rules = [r for r in RULES if r.table == "claims_header" and isinstance(r.check, RowCheck)]
    p = plan(engine._row_failures(claims.raw["claims_header"], "claims_header", rules))
    assert len(rules) == 17 and p.count("FileScan") == 1 and "Exchange" not in p
    assert p.count("substr(submission_date#") > 0
    assert len(re.findall(r"AS submission_date\|parsed", p)) == 1


@pytest.mark.parametrize("name", ["v_provider_scorecard", "v_mlr_by_group", "v_top_procedures", "v_provider_anomaly"])
def test_facts_are_folded_before_the_look_up(spark, claims, name):
    """The join's fact side is an aggregate, so a hot provider, group or code is one row there."""
    with conf(spark, **NO_BROADCAST):
        p = ran_plan(views.STAR_VIEWS[name](claims.marts))
    if "SortMergeJoin" in p:
        below = p[p.index("SortMergeJoin"):]
        assert "HashAggregate" in below or "Scan ExistingRDD" in below


def test_hot_city_counts(claims):
    s = consumers.spend_by_city(claims.marts).agg(F.sum("paid_amount_pkr")).first()[0]
    assert s == claims.marts["fct_claim_header"].agg(F.sum("paid_amount_pkr")).first()[0]
