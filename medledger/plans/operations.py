"""Operational views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medledger.functions import ageing_bucket, days_between, mean_of
from medledger.operators.ranking import add_ranks
from medledger.plans.enriched import Star, enriched
from medledger.plans.financial import rows
from medledger.sources.schemas import OPEN_STATUSES, WINDOW_END


def quantile(column: str, p: float) -> Column:
    """Exact and interpolated. Day counts have few distinct values, so the aggregate's
    value-to-count map stays small and is merged map-side."""
    return F.percentile(column, F.lit(p))


def v_operations_monthly(star: Star) -> DataFrame:
    c = enriched(star, ["year_month", "is_denied", "is_auto", "tat_submit_to_adjudicate", "tat_total"])
    return (
        c.filter(F.col("year_month").isNotNull())
        .groupBy("year_month")
        .agg(
            rows().alias("claim_count"),
            F.sum("is_denied").alias("denied_count"),
            mean_of("is_denied").alias("denial_rate"),
            mean_of("is_auto").alias("auto_adjudication_rate"),
            mean_of("tat_submit_to_adjudicate").alias("tat_adj_mean"),
            quantile("tat_submit_to_adjudicate", 0.5).alias("tat_adj_median"),
            quantile("tat_submit_to_adjudicate", 0.9).alias("tat_adj_p90"),
            mean_of("tat_total").alias("tat_total_mean"),
            quantile("tat_total", 0.9).alias("tat_total_p90"),
        )
        .orderBy("year_month")
    )


def v_denial_reasons(star: Star) -> DataFrame:
    denied = star["fct_claim_header"].filter((F.col("status") == "Denied") & F.col("denial_reason_code").isNotNull())
    by_code = denied.groupBy("denial_reason_code").agg(
        rows().alias("denial_count"), F.sum("billed_amount_pkr").alias("denied_billed_pkr"))
    ranked = add_ranks(by_code, {"denial_count": "rank_by_frequency", "denied_billed_pkr": "rank_by_value"})
    return ranked.orderBy(F.desc_nulls_last("denial_count"), "denial_reason_code")


def v_claims_ageing(star: Star) -> DataFrame:
    """Days from submission to the end of the window; a later submission counts as 0-30."""
    c = enriched(star, ["claim_date", "status", "billed_amount_pkr"])
    open_ = c.filter(F.col("status").isin(*OPEN_STATUSES) & F.col("claim_date").isNotNull())
    days = days_between(F.lit(WINDOW_END).cast("date"), "claim_date")
    return (
        open_.groupBy(ageing_bucket(days).alias("ageing_bucket"))
        .agg(rows().alias("open_claim_count"), F.sum("billed_amount_pkr").alias("open_billed_pkr"))
        .orderBy("ageing_bucket")
    )
