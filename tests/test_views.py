"""Edge cases of the views and operators, brute force on the other side where it is cheap."""

import hashlib
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from medledger.operators.duplicates import spread_copies, surplus_claims
from medledger.operators.ranking import add_ranks, bucket_of, ranked_running_sum
from medledger.plans import clinical, consumers, financial, measures, network, operations, risk, views
from tests.test_cleaning import headers, ids, members, star  # noqa: F401  (fixtures)

LINE = dict(line_no="1", procedure_code="R1", diagnosis_code="D1", quantity="1", unit_price_pkr="5", line_billed_pkr="5",
            line_approved_pkr="4")


def claim(i, **over):
    """A claim with a billed amount of its own, so no two are business duplicates."""
    return dict(claim_id=f"C{i:03d}", billed_amount_pkr=f"{1000 + i}", **over)


def test_groups_without_claims_or_premium(star):
    s, _ = star([{}])
    got = {r.employer_group_id: r for r in financial.v_mlr_by_group(s).collect()}
    assert float(got["G1"].medical_loss_ratio) == pytest.approx(70 / 240)
    assert got["G2"].medical_loss_ratio is None and got["G2"].claim_count == 0
    assert float(got["G3"].medical_loss_ratio) == 0.0
    assert [r.employer_group_id for r in financial.v_mlr_by_group(s).collect()][-1] == "G2"


def test_ageing_after_the_window_end_counts_as_fresh(star):
    s, _ = star([claim(1, status="Pending", submission_date="2026-07-15"), claim(2, status="In Review", submission_date="2026-03-31"),
                 claim(3, submission_date="2026-01-01")])
    assert {r.ageing_bucket: r.open_claim_count for r in operations.v_claims_ageing(s).collect()} == {"0-30": 1, "90+": 1}


def test_percentiles_interpolate(star):
    s, _ = star([claim(i, adjudication_date=f"2025-01-{5 + i:02d}") for i in range(1, 5)])
    r = operations.v_operations_monthly(s).first()
    assert (r.tat_adj_median, round(r.tat_adj_p90, 6)) == (2.5, 3.7)


def stay(i, day, code="D1", **over):
    return (claim(i, admission_date=day, discharge_date=day, **over),
            dict(LINE, claim_line_id=f"L{i}", claim_id=f"C{i:03d}", diagnosis_code=code))


def test_readmission_bounds(star):
    pairs = [stay(1, "2025-01-01"), stay(2, "2025-01-01"), stay(3, "2025-01-31"), stay(4, "2025-02-01"),
             stay(5, "2025-01-05", "D2"), stay(6, "2025-01-06", claim_type="Outpatient"), stay(7, "2025-01-07", member_id="M2")]
    s, _ = star([h for h, _ in pairs] + [claim(8, admission_date="2025-01-10", discharge_date="2025-01-11")], [x for _, x in pairs])
    got = sorted((r.index_claim_id, r.readmit_claim_id, r.days_between) for r in clinical.v_readmissions(s).collect())
    # same day is out, 30 days is in, 31 is out, other chapter / member / type and the claim without lines are out
    assert got == [("C001", "C003", 30), ("C002", "C003", 30), ("C003", "C004", 1)]


def test_readmissions_against_all_pairs(claims):
    rows = clinical.admissions(claims.marts).collect()
    want = sorted((a.claim_id, b.claim_id) for a in rows for b in rows
                  if (a.member_sk, a.chapter) == (b.member_sk, b.chapter) and 1 <= (b.admit_day - a.admit_day).days <= 30)
    got = sorted((r.index_claim_id, r.readmit_claim_id) for r in clinical.v_readmissions(claims.marts).collect())
    assert got == want and want


def test_first_line_decides_the_chapter(star):
    h, _ = stay(1, "2025-01-01")
    s, _ = star([h], [dict(LINE, claim_id="C001", claim_line_id="B", line_no="2", diagnosis_code="D1"),
                      dict(LINE, claim_id="C001", claim_line_id="A", line_no="1", diagnosis_code="D2"),
                      dict(LINE, claim_id="C001", claim_line_id="C", line_no="1", diagnosis_code="D1")])
    assert clinical.admissions(s).first().chapter == "Y"


def test_network_difference_needs_both_sides(star):
    rows = [claim(1), claim(2, provider_id="P2")]
    lines = [dict(LINE, claim_line_id="a", claim_id="C001"), dict(LINE, claim_line_id="b", claim_id="C002", unit_price_pkr="15")]
    s, _ = star(rows, lines)
    r = network.v_network_cost_diff(s).collect()
    assert [(x.procedure_code, x.in_network_avg_pkr, x.out_network_avg_pkr, x.oon_cost_multiple) for x in r] == [("R1", 5.0, 15.0, 3.0)]
    s, _ = star(rows, lines[:1])
    assert network.v_network_cost_diff(s).count() == 0


def test_equal_peers_have_no_z_score(star):
    s, _ = star([claim(1)])
    r = risk.v_provider_anomaly(s).first()
    assert r.peer_sd == 0 and r.z_score is None and r.is_anomalous is False


def test_no_frequent_member_without_spread(star):
    s, _ = star([claim(1), claim(2, member_id="M2")])
    assert risk.v_high_frequency_members(s).count() == 0


# -- ranking -----------------------------------------------------------------------
@pytest.mark.parametrize("spread", [40, 40_000, 10**12])
def test_running_sum_matches_sorting(spark, spread):
    """A third of the rows share one value; the order of ties is by digest."""
    rng = random.Random(5)
    rows = [(f"P{i:04d}", Decimal(0) if i % 3 == 0 else Decimal(rng.randrange(-spread // 4, spread)) / 4) for i in range(700)]
    df = spark.createDataFrame(rows, "id string, v decimal(18,2)")
    got = {r.id: (r.rk, r.run) for r in ranked_running_sum(df, "v", "id", "rk", "run").collect()}
    order = sorted(rows, key=lambda r: (-r[1], hashlib.md5(r[0].encode()).hexdigest()))
    run, want = Decimal(0), {}
    for n, (i, v) in enumerate(order, start=1):
        run += v
        want[i] = (n, run)
    assert got == want


def test_buckets_keep_the_order(spark):
    rng = random.Random(6)
    values = sorted([0.0, -1e-300, 1e-300, 5e-324, -5e-324, 1.0, 1e308, *(rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 15) for _ in range(3000))])
    near = [12345.67 + k / 100 for k in range(500)]
    for some in (values, near):
        rows = spark.createDataFrame([(v,) for v in [*some, None]], "v double").select("v", bucket_of("v").alias("b")).collect()
        got = sorted((r.v, r.b) for r in rows if r.v is not None)
        assert [b for _, b in got] == sorted(b for _, b in got) and [r.b for r in rows if r.v is None] == [None]
    assert 1 < len({b for _, b in got}) < 10


def test_ranks_run_nothing_before_the_query(spark, claims):
    marts, tracker = claims.marts, spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "views are built, not run")
    try:
        for name in ("v_provider_concentration", "v_denial_reasons", "v_provider_anomaly", "v_high_frequency_members"):
            views.STAR_VIEWS[name](marts)
            assert len(tracker.getJobIdsForGroup("building")) == 0, name
        risk.upcoding_proxy(marts)
        assert len(tracker.getJobIdsForGroup("building")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ranks_match_counting(spark):
    rows = [(f"k{i}", i % 17, (i * 7) % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, a bigint, b bigint")
    got = {r.k: (r.ra, r.rb) for r in add_ranks(df, {"a": "ra", "b": "rb"}).collect()}
    assert got == {k: (1 + sum(x[1] > a for x in rows), 1 + sum(x[2] > b for x in rows)) for k, a, b in rows}


# -- duplicates --------------------------------------------------------------------
def raw(frame, rows):
    return frame("claim_id member_id provider_id admission_date billed_amount_pkr", rows)


def test_surplus_rows_per_signature(frame):
    rows = [("c2", "m", "p", "d", "1"), ("c1", "m", "p", "d", "1"), ("c1", "m", "p", "d", "1"), ("c9", "m", "p", "d", "1.0"),
            ("x", "m", None, "d", "1"), ("y", "m", None, "d", "1"), ("z", "q", "p", "d", "1")]
    got = sorted(r.record_key for r in surplus_claims(raw(frame, rows)).collect())
    assert got == ["c1", "c2", "y"]  # raw text: 1 and 1.0 differ; NULLs group; a repeated id counts as often as it occurs


def test_copies_are_repeated_whole_across_blocks(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 7L), ('b', 0L), ('c', 1L) t(k, n)")
    got = sorted(r.k for r in spread_copies(df, "n", block=3).collect())
    assert got == ["a"] * 7 + ["c"]


def test_large_signature_keeps_its_shape_and_loses_nothing(frame):
    rows = [(f"c{i:03d}", "m", "p", "d", "1") for i in range(50)] + [("same", "m", "p", "d", "1")] * 20
    rows += [("a", "m2", "p", "d", "1"), ("b", "m2", "p", "d", "1"), ("solo", "m3", "p", "d", "1")]
    got = [(r.member_id, r.occurrence_count, r.claim_id, r.copies) for r in risk.v_duplicate_candidates(raw(frame, rows)).collect()]
    assert got == [*(("m", 70, f"c{i:03d}", 1) for i in range(50)), ("m", 70, "same", 20), ("m2", 2, "a", 1), ("m2", 2, "b", 1)]


def test_duplicate_flag(frame):
    rows = [("c1", "m", "p", None, "1"), ("c2", "m", "p", None, "1"), ("c3", "m", "p", "d", "1")]
    got = {r.claim_id: r.duplicate_claim_flag for r in risk.duplicate_claim_flag(raw(frame, rows)).collect()}
    assert got == {"c1": 1, "c2": 1, "c3": 0}


# -- measures ----------------------------------------------------------------------
def test_time_measures_do_not_skip_empty_months(star):
    s, _ = star([claim(1, submission_date="2025-01-05"), claim(2, submission_date="2025-04-05"), claim(3, submission_date="2026-01-05")])
    r = {x.year_month: x for x in measures.time_intelligence(s).collect()}
    assert set(r) == {"2025-01", "2025-04", "2026-01"}
    apr, jan = r["2025-04"], r["2026-01"]
    assert float(apr["Paid Rolling 3M"]) == 70 and float(apr["Paid YTD"]) == 140
    assert float(apr["Paid Fiscal YTD"]) == 140 and float(jan["Paid Fiscal YTD"]) == 70
    assert float(jan["Paid PY"]) == 70 and jan["Paid YoY %"] == 0.0 and jan["Claim Count PY"] == 1
    assert apr["Paid PY"] is None and apr["Paid YoY %"] is None


def test_where_filters_every_table_it_can(star):
    s, _ = star([claim(1), claim(2, member_id="M2")], [dict(LINE, claim_line_id="a", claim_id="C001"),
                                                      dict(LINE, claim_line_id="b", claim_id="C002")])
    only = F.col("member_id") == "M1"
    r = measures.evaluate(s, ["Claim Count", "Line Count", "Member Months", "Earned Premium", "Utilisation per 1000"],
                          where=only, where_reads=("member_id",)).first()
    assert (r["Claim Count"], r["Line Count"], r["Member Months"]) == (1, 1, 1)
    assert float(r["Earned Premium"]) == 360  # members do not filter employer groups
    assert r["Utilisation per 1000"] == 1000.0


def test_all_documented_measures_are_covered():
    plain = {n for n in measures.AGGREGATES if n != "Covered Members"} | set(measures.RATIOS)
    timed = {"Paid YTD", "Billed YTD", "Paid Fiscal YTD", "Paid PY", "Claim Count PY", "Denial Rate PY", "Paid YoY %",
             "Paid Rolling 3M", "PMPM Rolling 3M"}
    other = {"Top10 Provider Spend", "Provider Concentration", "Duplicate Claim Flag", "IBNR Estimate"}
    assert len(plain | timed | other) == 46


def test_every_measure_evaluates_without_grouping(claims):
    names = [n for n in [*measures.AGGREGATES, *measures.RATIOS]]
    r = measures.evaluate(claims.marts, names).first()
    assert r["Claim Count"] == claims.marts["fct_claim_header"].count()
    assert r["Line Count"] == claims.marts["fct_claim_line"].count()
    assert all(r[n] is not None for n in names)


def test_top_providers_include_ties_at_the_edge(star):
    s, _ = star([claim(1), claim(2, provider_id="P2"), claim(3, provider_id="P3", paid_amount_pkr="5")])
    r = measures.top_provider_spend(s, n=1).first()
    assert float(r["Top10 Provider Spend"]) == 140


# -- consumers ---------------------------------------------------------------------
def test_period_change_needs_two_months_and_a_base(spark):
    def change(rows):
        return consumers.last_change(spark.createDataFrame(rows, "year_month string, v double"), ["v"]).first()
    assert change([("2025-01", 4.0), ("2025-02", 5.0)]).v_delta == 25.0
    assert change([("2025-01", 0.0), ("2025-02", 5.0)]).v_delta is None
    assert change([("2025-02", 5.0)]).v_delta is None


def test_histogram_edges(star):
    s, _ = star([claim(i, adjudication_date=f"2025-01-{d:02d}") for i, d in enumerate((5, 6, 25), start=1)])
    h = sorted((r.bin, r.bin_start, r.bin_end, r.claim_count) for r in consumers.turnaround_histogram(s, bins=4).collect())
    assert h == [(1, 0.0, 5.0, 2), (4, 15.0, 20.0, 1)]  # the greatest value belongs to the last bin
    s, _ = star([claim(1)])
    assert [(r.bin, r.claim_count) for r in consumers.turnaround_histogram(s).collect()] == [(1, 1)]


def test_funnel_shows_empty_stages(star):
    s, _ = star([claim(1)])
    got = [(r.status, r.claim_count) for r in consumers.adjudication_funnel(s).collect()]
    assert got == [("In Review", 0), ("Pending", 0), ("Partially Paid", 0), ("Denied", 0), ("Paid", 1)]


def test_filters_are_inclusive_and_optional(star):
    s, _ = star([claim(1, submission_date="2025-01-05"), claim(2, submission_date="2025-02-05", provider_id="P2")])
    n = lambda **k: consumers.filtered(s, consumers.Filters(**k), ["claim_id"]).count()
    assert (n(), n(date_from="2025-01-05", date_to="2025-02-05"), n(date_from="2025-01-06"), n(date_to="2025-02-04")) == (2, 2, 1, 1)
    assert (n(networks=("Out-of-Network",)), n(employers=("One",), cities=("Karachi",)), n(cities=("Nowhere",))) == (1, 2, 0)


def test_drill_through_one_key(star):
    s, _ = star([claim(1), claim(2, provider_id="P2")])
    assert ids(consumers.drill_through(s, "provider_id", "P2", ["claim_id"])) == ["C002"]
    assert ids(consumers.drill_through(s, "member_id", "M1", ["claim_id"])) == ["C001", "C002"]


def test_views_are_callable_by_name(spark, claims):
    assert views.register_views(claims.marts, claims.raw["claims_header"]) == 17
    assert views.load_view(spark, "v_financial_monthly").count() > 0
    assert spark.sql("SELECT count(*) FROM v_claims_enriched WHERE is_denied = 1").first()[0] > 0


def test_industry_without_claims_keeps_its_premium(star):
    s, _ = star([{}])
    by = {r.industry: r for r in measures.evaluate(s, ["Total Paid", "Earned Premium"], by=["industry"]).collect()}
    for r in s["dim_employer_group"].select("industry").distinct().collect():
        assert r.industry in by and by[r.industry]["Earned Premium"] is not None


def test_versions_of_a_provider_and_member_are_one(star):
    s, _ = star([claim(i) for i in range(1, 7)])
    second = F.col("claim_id").isin("C001", "C002")
    cut = {**s}
    for dim, key in (("dim_provider", "provider_sk"), ("dim_member", "member_sk")):
        used = s["fct_claim_header"].select(key).distinct()
        cut[dim] = s[dim].union(s[dim].join(used, key, "left_semi").withColumn(key, F.lit("other")).select(s[dim].columns))
        cut["fct_claim_header"] = cut["fct_claim_header"].withColumn(key, F.when(second, "other").otherwise(F.col(key)))
    for view in (network.v_provider_scorecard, network.v_provider_concentration, risk.v_provider_anomaly, consumers.provider_report):
        assert sorted(map(str, view(cut).collect())) == sorted(map(str, view(s).collect()))
    assert network.v_provider_scorecard(cut).first().claim_count == 6
    assert measures.evaluate(cut, ["Total Paid"]).collect() == measures.evaluate(s, ["Total Paid"]).collect()
