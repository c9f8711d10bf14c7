"""Stored summaries against the aggregates over the claims, and the SQL table function."""

import pytest
from pyspark.sql import functions as F

from medledger.plans import pipeline, summaries, views
from medledger.sources import versions
from medledger.sources.lake import MONTH
from medledger.sources.schemas import RAW_TABLES


def one_row(df):
    return df.collect()[0]


def fact_in(claims, a, b):
    return claims.marts["fct_claim_header"].filter(F.col(MONTH).between(a, b))


def test_months_are_counted(spark):
    months = spark.createDataFrame([(202312,), (202401,), (202412,)], "m int").select(
        "m", summaries.month_index("m").alias("i"), summaries.month_number(summaries.month_index("m") + 1).alias("next"))
    rows = sorted(months.collect())
    assert [r.next for r in rows] == [202401, 202402, 202501] and [r.i - rows[0].i for r in rows] == [0, 1, 12]


def test_numbers_have_no_gap_and_stay(spark):
    members = spark.range(20_000).selectExpr("md5(cast(id AS string)) AS member_sk").union(spark.sql("SELECT cast(NULL AS string)"))
    first = summaries.number_members(members.limit(15_000).union(members.limit(10)))
    rows = {r.member_sk: r.member_no for r in first.collect()}
    assert sorted(rows.values()) == list(range(1, len(rows) + 1))
    again = {r.member_sk: r.member_no for r in summaries.number_members(members, spark.createDataFrame(list(rows.items()), first.schema)).collect()}
    assert all(again[k] == n for k, n in rows.items())
    assert sorted(again.values()) == list(range(1, 20_001))
    assert summaries.number_members(members, spark.createDataFrame([], first.schema)).agg(F.min("member_no"), F.max("member_no")).first()[:] == (1, 20_000)


@pytest.mark.parametrize(("a", "b"), [(202407, 202407), (202410, 202503), (202401, 202712), (201001, 201012)])
def test_distinct_members_of_a_range(claims, a, b):
    found = one_row(summaries.distinct_members(claims.summaries["member_bitmaps"], a, b)).distinct_members
    assert found == fact_in(claims, a, b).agg(F.count_distinct("member_sk")).first()[0]


def test_bitmaps_of_more_than_one_block(spark):
    members = spark.range(80_000).selectExpr("md5(cast(id AS string)) AS member_sk", "cast(202401 + id % 3 AS int) AS submission_month", "'x' AS claim_type")
    bits = summaries.member_bitmaps(members.union(members), summaries.number_members(members))
    assert bits.select("block").distinct().count() == 3
    assert one_row(summaries.distinct_members(bits, 202401, 202402)).distinct_members == 53_334
    assert one_row(summaries.distinct_members(bits)).distinct_members == 80_000


def test_ranges_read_their_months_alone_and_not_the_claims(claims):
    df = summaries.distinct_members(claims.summaries["member_bitmaps"], 202501, 202503)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "(submission_month" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert all("/member_bitmaps/" in f for f in df.inputFiles())


@pytest.mark.parametrize("by", [(), ("adjudication_mode",)])
def test_turnaround_of_a_range(claims, by):
    took = F.col("tat_submit_to_adjudicate")
    want = fact_in(claims, 202409, 202504).filter(took.isNotNull()).groupBy(*by).agg(
        F.count("*"), F.avg(took), F.percentile(took, F.lit(0.5)), F.percentile(took, F.lit(0.9)))
    got = summaries.turnaround(claims.summaries["turnaround_counts"], 202409, 202504, by)
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_a_month_is_refreshed_alone(spark, claims, lake):
    fact = claims.marts["fct_claim_header"]
    cut = {**claims.marts, "fct_claim_header": fact.filter((F.col(MONTH) != 202501) | F.col("claim_id").endswith("1")),
           "dim_member": claims.marts["dim_member"].filter("member_id < 'MB000000100'")}
    summaries.build_summaries(lake, cut)
    before = {r.member_sk: r.member_no for r in lake.read("summaries", "member_numbers").collect()}
    summaries.refresh_month(lake, {**cut, "fct_claim_header": fact, "dim_member": claims.marts["dim_member"]}, 202501)
    after = {r.member_sk: r.member_no for r in lake.read("summaries", "member_numbers").collect()}
    assert before.items() <= after.items() and len(after) > len(before)
    bits = lake.read("summaries", "member_bitmaps")
    assert one_row(summaries.distinct_members(bits, 202501, 202501)).distinct_members == fact_in(
        claims, 202501, 202501).agg(F.count_distinct("member_sk")).first()[0]


def test_published_summaries_keep_member_numbers(claims, lake):
    for t in RAW_TABLES:
        lake.replace("raw", t, claims.raw[t])
    for _ in range(2):
        made = versions.draft(lake)
        for t, df in claims.marts.items():
            made.replace("marts", t, df)
        summaries.build_summaries(made, claims.marts, pipeline.known_members(lake))
        pipeline.publish_marts(lake, dict.fromkeys(RAW_TABLES, lake), made)
    one, two = (versions.open_version(lake, n).read("summaries", "member_numbers") for n in (1, 2))
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_table_function_prunes_months(spark, claims):
    views.register_range_function(claims.marts)
    df = spark.sql("SELECT claim_id FROM claims_submitted_between(DATE'2025-01-15', DATE'2025-02-10')")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "submission_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 202501" in plan.split("PartitionFilters: [")[1] and "GreaterThanOrEqual(submission_date_key,20250115)" in plan
    assert "paid_amount_pkr" not in plan.split("ReadSchema:")[1]
    assert df.count() == claims.marts["fct_claim_header"].filter(F.col("submission_date_key").between(20250115, 20250210)).count() > 0
    assert spark.sql("SELECT count(*) AS n FROM claims_submitted_between(DATE'2025-02-10', DATE'2025-01-15')").first().n == 0


def test_bitmaps_shuffle_the_claims_once_and_a_busy_member_as_one_row(spark):
    busy = spark.range(0, 3000, 1, 2).selectExpr("'busy' AS member_sk", "if(id % 2 = 0, 'Inpatient', NULL) AS claim_type",
                                                 "if(id % 5 = 0, NULL, 202501 + int(id % 3)) AS submission_month")
    others = spark.sql("SELECT * FROM VALUES ('m', 'Inpatient', 202501), (NULL, 'Inpatient', 202501), ('lost', 'Inpatient', 202501) "
                       "AS t(member_sk, claim_type, submission_month)")
    fact = busy.union(others)
    numbers = spark.sql("SELECT * FROM VALUES ('busy', 1L), ('m', 2L) AS t(member_sk, member_no)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bits = summaries.member_bitmaps(fact, numbers)
        plan = bits._jdf.queryExecution().executedPlan().toString()
        found = {(r.submission_month, r.claim_type): r.n for r in bits.select("*", F.bitmap_count("bits").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [x.split("hashpartitioning(")[1].split("#")[0] for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert sorted(dealt) == ["member_sk", "member_sk", "submission_month"], plan
    assert "partial_collect_set" in plan
    want = {(m, t): 1 for m in (202501, 202502, 202503) for t in ("Inpatient", None)} | {(202501, "Inpatient"): 2}
    assert found == want
