"""Financial views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medledger.functions import ratio
from medledger.plans.enriched import Star, enriched
from medledger.sources.schemas import OPEN_STATUSES, WINDOW_MONTHS

def rows() -> Column:
    return F.count(F.lit(1))


def v_financial_monthly(star: Star) -> DataFrame:
    c = enriched(star, ["year_month", "fiscal_year", "billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr",
                        "member_share_pkr", "savings_pkr"])
    m = (
        c.filter(F.col("year_month").isNotNull())
        .groupBy("year_month", "fiscal_year")
        .agg(
            rows().alias("claim_count"),
            F.sum("billed_amount_pkr").alias("billed_pkr"),
            F.sum("approved_amount_pkr").alias("approved_pkr"),
            F.sum("paid_amount_pkr").alias("paid_pkr"),
            F.sum("member_share_pkr").alias("member_share_pkr"),
            F.sum("savings_pkr").alias("savings_pkr"),
        )
    )
    return m.withColumns({
        "approval_rate": ratio("approved_pkr", "billed_pkr"),
        "savings_rate": ratio("savings_pkr", "billed_pkr"),
        "member_cost_share": ratio("member_share_pkr", "billed_pkr"),
    }).orderBy("year_month")


def v_mlr_by_group(star: Star) -> DataFrame:
    """Every employer group is kept; the premium is always that of the whole window."""
    claims = star["fct_claim_header"].groupBy("employer_group_sk").agg(
        F.sum("paid_amount_pkr").alias("_paid"), rows().alias("_n"))
    g = star["dim_employer_group"].join(claims, "employer_group_sk", "left")
    premium = F.col("monthly_premium_pkr") * WINDOW_MONTHS
    zero = F.lit(0).cast("decimal(28,2)")
    paid = F.coalesce("_paid", zero)
    return g.select(
        F.col("group_id").alias("employer_group_id"), "employer_name", "industry", "lives_covered",
        "monthly_premium_pkr",
        premium.alias("earned_premium_pkr"),
        paid.alias("paid_pkr"),
        F.coalesce("_n", F.lit(0)).alias("claim_count"),
        ratio(paid, premium).alias("medical_loss_ratio"),
    ).orderBy(F.desc_nulls_last("medical_loss_ratio"), "employer_group_id")


def v_pmpm(star: Star) -> DataFrame:
    """Per member per month; only months in which a member claimed count as member-months."""
    m = star["fct_monthly_member_summary"].groupBy("month_start").agg(
        rows().alias("member_months"), F.sum("paid_amount_pkr").alias("paid_pkr"),
        F.sum("billed_amount_pkr").alias("billed_pkr"))
    return m.select(
        F.date_format("month_start", "yyyy-MM").alias("year_month"),
        "member_months", "paid_pkr", "billed_pkr",
        ratio("paid_pkr", "member_months").alias("pmpm_paid_pkr"),
        ratio("billed_pkr", "member_months").alias("pmpm_billed_pkr"),
    ).orderBy("year_month")


def ibnr_by_month(star: Star) -> DataFrame:
    """Reserve per incurred (admission) month: open billed x paid/approved over all claims.

    The conversion rate is a one-row scalar subquery.
    """
    rate = star["fct_claim_header"].agg(
        ratio(F.sum("paid_amount_pkr"), F.sum("approved_amount_pkr")).alias("r"))
    c = enriched(star, ["year_month", "status", "billed_amount_pkr"], on_date="admission_date_key")
    m = (
        c.filter(F.col("status").isin(*OPEN_STATUSES) & F.col("year_month").isNotNull())
        .groupBy(F.col("year_month").alias("incurred_month"))
        .agg(rows().alias("open_claim_count"), F.sum("billed_amount_pkr").alias("open_billed_pkr"))
    )
    m = m.withColumn("conversion_rate", rate.scalar())
    return m.withColumn("ibnr_pkr", F.col("open_billed_pkr").cast("double") * F.col("conversion_rate"))
