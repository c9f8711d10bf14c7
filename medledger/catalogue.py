"""Every query by name, as a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.claims import dirtied, injected_defects, member_snapshots
from fixtures.planted import planted_marts
from medledger.functions import register_sql_functions
from medledger.operators import cleaning
from medledger.operators.history import as_of_last, versions_of
from medledger.operators.joins import as_of_join, restrict
from medledger.operators.star import dim_claim_status, dim_claim_type
from medledger.plans import consumers, financial, measures, risk, summaries
from medledger.plans.demo import ClaimsLake, claims_lake
from medledger.plans.enriched import enriched
from medledger.plans.pipeline import Settings, layer_counts, publish_marts, run_pipeline
from medledger.plans.views import STAR_VIEWS, attach, published_view, register_range_function, smoke_check
from medledger.quality import assertions, engine
from medledger.sources import versions
from medledger.sources.lake import MONTH, Lake
from medledger.sources.landing import (
    count_rows,
    ingest_all,
    ingest_audit,
    ingest_table,
    read_text_csv,
    reconcile,
    refused_rows,
    union_all,
    write_text_csv,
)
from medledger.sources.schemas import RAW_COLUMNS, RAW_TABLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a function of the claims lake as a query."""
    def add(build: Callable[[ClaimsLake], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(claims_lake(spark, sf_dir))
        return build
    return add


# -- sources ---------------------------------------------------------------------
@query("csv_landing_members")
def _(c: ClaimsLake) -> DataFrame:
    """Members written as landing CSV and read back as text, dirt included."""
    path = c.lake.path("landing", "members.csv")
    write_text_csv(c.tables["members"], path)
    return read_text_csv(c.spark, path, "members")


@query("csv_landing_reconciled")
def _(c: ClaimsLake) -> DataFrame:
    """All eight tables through landing CSV files: rows at the source against rows loaded."""
    folder = c.lake.path("landing", "all")
    for t, df in c.raw.items():
        write_text_csv(df, f"{folder}/{t}.csv")
    landed = Lake(c.spark, c.lake.path("landing", "lake"))
    ingest_all(landed, folder)
    return reconcile(c.source.tables(), landed.tables("raw", RAW_TABLES))


@query("csv_line_breaks")
def _(c: ClaimsLake) -> DataFrame:
    """Members whose names hold line breaks, quotes and commas, through landing files that are split among tasks."""
    folder = c.lake.path("landing", "breaks")
    name = F.concat("name", F.lit('\n"of", '), "city", F.lit("\r\n"), "member_id", F.lit("\n"))
    write_text_csv(c.tables["members"].withColumn("name", name), f"{folder}/members.csv")
    landed = Lake(c.spark, c.lake.path("landing", "breaks-lake"))
    ingest_table(landed, folder, "members")
    return landed.read("raw", "members")


@query("csv_damaged_landing")
def _(c: ClaimsLake) -> DataFrame:
    """Claim headers of which some lines have a field too few or too many: what was loaded, refused and why, with the
    length of the refused text."""
    folder, columns = c.lake.path("landing", "damaged"), RAW_COLUMNS["claims_header"]
    line, k = F.concat_ws(",", *columns), F.substring("claim_id", -2, 2)
    damaged = (F.when(k == "07", F.regexp_replace(line, ",[^,]*$", "")).when(k == "33", F.concat(line, F.lit(",more")))
               .when(k == "64", F.lit("one field")).otherwise(line))
    one_column = c.tables["claims_header"].select(damaged.alias(",".join(columns)))
    (one_column.write.mode("overwrite").option("header", True).option("sep", "\u0001").option("escapeQuotes", False)
               .csv(f"{folder}/claims_header.csv"))
    landed = Lake(c.spark, c.lake.path("landing", "damaged-lake"))
    ingest_table(landed, folder, "claims_header", on_malformed="keep")
    loaded = landed.read("raw", "claims_header").select(F.lit("loaded").alias("kind"), F.lit("").alias("reason"), F.lit("").alias("record"))
    refused = refused_rows(landed, "claims_header").select(F.lit("refused").alias("kind"), "reason", "record")
    return loaded.union(refused).groupBy("kind", "reason").agg(F.count("*").alias("rows"), F.sum(F.length("record")).alias("letters"))


@query("published_versions")
def _(c: ClaimsLake) -> DataFrame:
    """Views over two published versions, of which the second shares all tables but the claims of 2025 alone; the names
    attached to the first keep its data after the second is published."""
    raw, claims = dict.fromkeys(RAW_TABLES, c.lake), c.marts["fct_claim_header"]
    first = publish_marts(c.lake, raw, c.lake)
    attach(c.lake)
    made = versions.draft(c.lake)
    made.replace_by_month("marts", "fct_claim_header", claims.filter("submission_date_key BETWEEN 20250101 AND 20251231").drop(MONTH),
                          "submission_date_key")
    second = versions.publish(c.lake, {"raw": raw, "marts": {**first.places("marts"), "fct_claim_header": made}})
    names = ["v_claims_enriched", "v_financial_monthly", "v_provider_scorecard"]
    frames = [count_rows(c.spark.table(n), n).withColumn("version", F.lit("attached")) for n in names]
    for label, v in (("all", first), ("2025", second)):
        frames += [count_rows(published_view(c.lake, n, v.number), n).withColumn("version", F.lit(label)) for n in names]
    return union_all(frames).select("version", F.col("table_name").alias("view_name"), "row_count")


@query("batch_job")
def _(c: ClaimsLake) -> DataFrame:
    """The whole job from landing files to exports, on a lake of its own: rows of every table, view and export."""
    folder = c.lake.path("landing", "job")
    for t, df in c.source.tables().items():
        write_text_csv(df, f"{folder}/{t}.csv", packed_by="gzip")
    lake = Lake(c.spark, c.lake.path("landing", "job-lake"))
    run_pipeline(lake, Settings(folder, fail_on_critical=False, keep_landing=False))
    version = versions.open_version(lake)
    found = [count_rows(df, n).withColumn("part", F.lit(layer)) for layer, names in (("raw", RAW_TABLES), ("marts", None))
             for n, df in version.tables(layer, names).items()]
    views = smoke_check(version.tables("marts"), version.read("raw", "claims_header"),
                        lambda name, count: lake.replace("work", f"rows_of_{name}", count))
    found.append(views.select(F.col("view_name").alias("table_name"), "row_count", F.lit("view").alias("part")))
    for n in ("kpi_summary", "kpi_monthly_trend", "claims_detail", "provider_report", "dq_latest"):
        found.append(count_rows(lake.read("exports", n), n).withColumn("part", F.lit("export")))
    return union_all(found).select("part", F.col("table_name").alias("name"), "row_count")


@query("unread_numbers")
def _(c: ClaimsLake) -> DataFrame:
    """The load check over all tables, with amounts spoilt in five ways: counted by column."""
    billed = F.col("billed_amount_pkr")
    k = F.substring("claim_id", -2, 2)
    spoilt = (
        F.when(k == "07", F.concat(billed, F.lit("5"))).when(k == "11", F.lit("12,000.00")).when(k == "23", F.lit("abc"))
        .when(k == "42", F.lit("1e20")).when(k == "64", F.lit("")).otherwise(billed)
    )
    raw = {**c.raw, "claims_header": c.tables["claims_header"].withColumn("billed_amount_pkr", spoilt)}
    return engine.unread_numbers(raw).groupBy("table_name", "column_name").agg(F.count("*").alias("lost"))


@query("dq_dirty_rules")
def _(c: ClaimsLake) -> DataFrame:
    """Rows failed by rule over raw tables on which each rule fails somewhere, and whether the gate stops there."""
    raw = dirtied(c.raw)
    found = engine.results(raw, engine.failed_records(raw))
    return found.select("rule_id", "rows_failed", ((F.col("severity") == "critical") & ~F.col("passed")).alias("stops"))


@query("gate_verdict")
def _(c: ClaimsLake) -> DataFrame:
    """What the gate would stop on: critical rules that failed, and the load check of numbers."""
    lost = c.quality.unread.agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(engine.UNREAD).alias("rule_id"))
    return engine.critical_failures(c.quality.results).select("rule_id").union(lost)


@query("ingest_audit")
def _(c):
    _ = c.raw
    return ingest_audit(c.lake).drop("loaded_at")


@query("reconcile_counts")
def _(c):
    return reconcile(c.source.tables(), c.raw)


@query("layer_counts")
def _(c):
    _ = c.marts
    return layer_counts(c.lake)


@query("claims_in_date_range")
def _(c):
    return consumers.claims_between(c.star, "2025-01-01", "2025-12-31", consumers.DETAIL_COLUMNS)


@query("parse_date_sql_function")
def _(c):
    register_sql_functions(c.spark)
    return c.tables["members"].select("member_id", F.expr("parse_claim_date(enrolment_date)").alias("enrolled_on"))


@query("masked_identifier_check")
def _(c):
    masked = F.col("masked_cnic").rlike(r"\*")
    return c.tables["members"].agg(F.count(F.lit(1)).alias("members"), F.count_if(masked).alias("masked"),
                                F.count_if(~masked).alias("unmasked"))


# -- staging ---------------------------------------------------------------------
def _staged(table: str) -> None:
    query(f"stg_{table}")(lambda c: c.staged(table))


for _t in RAW_TABLES:
    _staged(_t)


# -- cleaning --------------------------------------------------------------------
@query("members_cleaned")
def _(c):
    return cleaning.clean_members(c.staged("members"))


@query("claims_deduplicated")
def _(c):
    return cleaning.first_per_signature(c.staged("claims_header"), c.repeated)


def _claims_cleaned(c: ClaimsLake) -> DataFrame:
    return cleaning.clean_claims(
        c.staged("claims_header"), cleaning.clean_members(c.staged("members")), c.staged("providers"), c.repeated)


query("claims_cleaned")(_claims_cleaned)


@query("claim_lines_cleaned")
def _(c):
    return cleaning.clean_lines(c.staged("claims_lines"), _claims_cleaned(c))


# -- dimensions and facts --------------------------------------------------------
@query("calendar_activity")
def _(c):
    """The whole calendar with what was submitted on each day."""
    daily = c.star["fct_claim_header"].groupBy("submission_date_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("billed_amount_pkr").alias("_b"))
    d = c.star["dim_date"]
    return d.join(daily, F.col("date_key") == F.col("submission_date_key"), "left").select(
        *d.columns, F.coalesce("_n", F.lit(0)).alias("claims_submitted"),
        F.coalesce(F.col("_b").cast("double"), F.lit(0.0)).alias("billed_pkr"))


def _activity(c: ClaimsLake, dim: DataFrame, key: str) -> DataFrame:
    per = c.star["fct_claim_header"].groupBy(key).agg(
        F.count(F.lit(1)).alias("claim_count"), F.sum("billed_amount_pkr").alias("billed_pkr"))
    return F.broadcast(dim).join(per, key).select(*dim.columns, "claim_count", "billed_pkr")


@query("claim_status_activity")
def _(c):
    return _activity(c, dim_claim_status(c.spark), "status")


@query("claim_type_activity")
def _(c):
    return _activity(c, dim_claim_type(c.spark), "claim_type")


def _stored(name: str) -> None:
    query(name)(lambda c: c.star[name].drop(MONTH))


for _t in ("dim_member", "dim_provider", "dim_employer_group", "dim_policy", "dim_diagnosis", "dim_procedure",
           "fct_claim_header", "fct_claim_line", "fct_monthly_member_summary"):
    _stored(_t)


@query("as_of_member_join")
def _(c):
    """Cleaned claims with the member version valid on the submission date."""
    claims = _claims_cleaned(c).select("claim_id", "member_id", "submission_date")
    versions = c.star["dim_member"].select("member_id", "member_sk", "valid_from", "valid_to")
    j = as_of_join(claims, versions, "member_id", "submission_date")
    return j.select("claim_id", "member_id", "submission_date", "member_sk", F.col("member_sk").isNotNull().alias("covered"))


# -- views -----------------------------------------------------------------------
def _view(name: str) -> None:
    query(name)(lambda c: STAR_VIEWS[name](c.star))


for _t in STAR_VIEWS:
    _view(_t)


@query("v_duplicate_candidates")
def _(c):
    return risk.v_duplicate_candidates(c.tables["claims_header"])


@query("view_smoke_check")
def _(c):
    return smoke_check(c.star, c.tables["claims_header"])


query("ibnr_by_month")(lambda c: financial.ibnr_by_month(c.star))
query("upcoding_proxy")(lambda c: risk.upcoding_proxy(c.star))


# -- measures --------------------------------------------------------------------
def _measures(name: str, by: str, names: list[str]) -> None:
    query(name)(lambda c: measures.evaluate(c.star, names, [by]))


_measures("measures_core_by_month", "year_month", [
    "Total Billed", "Total Approved", "Total Paid", "Total Member Share", "Total Savings", "Claim Count",
    "Approval Rate", "Savings Rate", "Member Cost Share", "Avg Claim Value"])
_measures("measures_premium_by_industry", "industry", ["Earned Premium", "Loss Ratio", "Medical Loss Ratio"])
_measures("measures_pmpm_by_month", "year_month", ["Member Months", "PMPM Paid", "PMPM Billed"])
_measures("measures_operations_by_type", "claim_type", [
    "Denied Claims", "Denial Rate", "Auto Adjudicated", "Auto Adjudication Rate", "Avg TAT Submit to Adjudicate",
    "Median TAT", "P90 TAT", "Avg TAT Adjudicate to Pay", "Open Claims", "Backlog Billed"])
_measures("measures_utilisation_by_age", "age_band", [
    "Distinct Members", "Utilisation per 1000", "Avg Length of Stay", "Line Count", "Line Billed"])
_measures("measures_network_by_employer", "employer_name", ["OON Paid", "OON Share"])
query("measure_top10_provider_spend")(lambda c: measures.top_provider_spend(c.star))
query("duplicate_claim_flag")(lambda c: risk.duplicate_claim_flag(c.tables["claims_header"]))
query("time_intelligence")(lambda c: measures.time_intelligence(c.star))
query("ibnr_estimate_by_type")(lambda c: measures.ibnr_estimate(c.star, ["claim_type"]))


@query("members_of_ranges")
def _(c):
    """Distinct members of each three months by claim type and over all types, from the stored bitmaps alone."""
    bits = c.summaries["member_bitmaps"]
    by_type = summaries.rolling_members(bits, 3, by=("claim_type",))
    return by_type.unionByName(summaries.rolling_members(bits, 3).withColumn("claim_type", F.lit("all")))


@query("members_of_a_year")
def _(c):
    return summaries.distinct_members(c.summaries["member_bitmaps"], 202501, 202512, by=("claim_type",))


@query("turnaround_of_ranges")
def _(c):
    """Mean, median and 90th percentile of turnaround days over three ranges of months, from the stored counts alone."""
    counts, found = c.summaries["turnaround_counts"], []
    for a, b in ((202407, 202506), (202501, 202503), (202507, None)):
        one = summaries.turnaround(counts, a, b, by=("adjudication_mode",)).withColumn("month_from", F.lit(a))
        found += [one, summaries.turnaround(counts, a, b).withColumns({"month_from": F.lit(a), "adjudication_mode": F.lit("all")})]
    return union_all(found)


@query("member_history")
def _(c):
    return versions_of(member_snapshots(c.tables["members"]), "member_id", "taken")


@query("claims_as_of_history")
def _(c):
    """Claims with city and policy of their member as the snapshots show them for the day of submission."""
    history = versions_of(member_snapshots(c.tables["members"]), "member_id", "taken")
    claims = _claims_cleaned(c).select("claim_id", "member_id", "submission_date")
    return as_of_last(claims, history, "member_id", "submission_date", ["city", "policy_id"])


@query("claims_table_function")
def _(c):
    register_range_function(c.star)
    return c.spark.sql("""
        SELECT claim_id, claim_type, paid_amount_pkr FROM claims_submitted_between(DATE'2025-01-15', DATE'2025-03-10')""")


@query("row_level_filter")
def _(c):
    """A user mapped to all employer groups of one industry sees those groups' claims only."""
    users = c.star["dim_employer_group"].select(
        F.concat(F.lower("industry"), F.lit("@example.org")).alias("email"), "group_id")
    claims = enriched(c.star, ["claim_id", "employer_group_id", "paid_amount_pkr"])
    return restrict(claims, users, "asia@example.org").select("claim_id", "employer_group_id", "paid_amount_pkr")


@query("billed_by_admission_month")
def _(c):
    """The calendar in its other role: by admission instead of submission."""
    e = enriched(c.star, ["year_month", "billed_amount_pkr"], on_date="admission_date_key")
    return e.filter(F.col("year_month").isNotNull()).groupBy(F.col("year_month").alias("admission_month")).agg(
        F.count(F.lit(1)).alias("claim_count"), F.sum("billed_amount_pkr").alias("billed_pkr"))


@query("drill_through_flagged_providers")
def _(c):
    flagged = consumers.flagged_providers(c.star).select("provider_id")
    return consumers.drill_through(c.star, "provider_id", flagged, consumers.DETAIL_COLUMNS)


@query("drill_through_frequent_members")
def _(c):
    frequent = risk.v_high_frequency_members(c.star).select("member_id")
    return consumers.drill_through(c.star, "member_id", frequent, ["member_id", *consumers.DETAIL_COLUMNS])


query("saved_filters")(lambda c: consumers.saved_filter_totals(c.star))


# -- data quality ----------------------------------------------------------------
def _without(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


query("dq_results")(lambda c: _without(c.quality.results, "run_ts", "rule_no"))


@query("dq_failed_records")
def _(c):
    run = c.quality
    return c.lake.read("dq", "dq_failed_records").filter(F.col("run_id") == run.run_id).drop("captured_at")


query("dq_latest_run")(lambda c: _without(engine.latest_run(c.quality_history), "run_ts", "rule_no"))
query("dq_trend")(lambda c: engine.trend(c.quality_history))
query("dq_scores")(lambda c: engine.scores(c.quality.results))


@query("dq_report")
def _(c):
    """The nested report, flattened to one plain row."""
    r = engine.report(c.quality.results)
    dims = ["completeness", "validity", "consistency", "uniqueness", "accuracy", "timeliness"]
    tables = ["claims_header", "claims_lines", "members", "providers", "policies", "employer_groups"]
    return r.select(
        "run_id", "overall_score", F.size("rules").cast("bigint").alias("rules"),
        F.size("critical_failures").cast("bigint").alias("critical_failures"),
        *[F.col("dimension_scores")[d].alias(d) for d in dims], *[F.col("table_scores")[t].alias(t) for t in tables])


query("dq_page_totals")(lambda c: engine.page_totals(c.quality.results))
query("dq_failures_by_dimension")(lambda c: engine.failures_by_dimension(c.quality.results))
query("dq_defect_reconciliation")(lambda c: engine.reconcile_defects(c.quality.results, injected_defects(c.source)))
query("warehouse_assertions")(lambda c: assertions.evaluate(c.models()))
query("planted_assertions")(lambda c: assertions.evaluate(planted_marts(c.models())))

# -- consumers -------------------------------------------------------------------
query("filtered_executive_monthly")(lambda c: consumers.executive_monthly(c.star, consumers.Filters(
    date_from="2024-10-01", date_to="2026-03-31", claim_types=("Inpatient", "Outpatient", "Emergency"),
    networks=("In-Network",))))
query("filter_domains")(lambda c: consumers.filter_domains(c.star))
query("executive_monthly")(lambda c: consumers.executive_monthly(c.star))
query("executive_headline")(lambda c: consumers.executive_headline(c.star))
query("status_mix")(lambda c: consumers.value_counts(c.star, "status"))
query("volume_by_type")(lambda c: consumers.value_counts(c.star, "claim_type"))
query("spend_by_city")(lambda c: consumers.spend_by_city(c.star))
query("operations_headline")(lambda c: consumers.operations_headline(c.star))
query("turnaround_histogram")(lambda c: consumers.turnaround_histogram(c.star))
query("adjudication_funnel")(lambda c: consumers.adjudication_funnel(c.star))
query("top_loss_ratios")(lambda c: consumers.top_loss_ratios(c.star))
query("top_share_of_spend")(lambda c: consumers.top_share_of_spend(c.star))
query("top_network_multiples")(lambda c: consumers.top_network_multiples(c.star))
query("flagged_providers")(lambda c: consumers.flagged_providers(c.star))
query("kpi_summary")(lambda c: consumers.kpi_summary(c.star))
query("kpi_monthly_trend")(lambda c: consumers.kpi_monthly_trend(c.star))
query("claims_detail")(lambda c: consumers.claims_detail(c.star))
query("provider_report")(lambda c: consumers.provider_report(c.star))
