"""Provider-network views. Facts are added up per provider key before the provider look-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medledger.functions import mean_of, ratio
from medledger.operators.ranking import ranked_running_sum
from medledger.plans.enriched import Star, look_up, with_flags
from medledger.plans.financial import rows


def provider_totals(star: Star, *aggs) -> DataFrame:
    return with_flags(star["fct_claim_header"]).groupBy("provider_sk").agg(*aggs)


def provider_fold(star: Star, who: list[str], **sums) -> DataFrame:
    """Sums by provider: the claims are added up by surrogate key, and the versions of a provider once more
    by the columns of ``who``, so that a provider is one row however many versions it has."""
    per_version = provider_totals(star, *(c.alias(n) for n, c in sums.items()))
    return look_up(per_version, star, who).groupBy(*who).agg(*(F.sum(n).alias(n) for n in sums))


def v_network_cost_diff(star: Star) -> DataFrame:
    """Mean unit price in and out of network for the same procedure; both sides must exist.

    Pairs of procedure and provider hardly repeat, so adding up per pair would shuffle every line.
    The slim provider side (key and network) is joined first and the lines are then folded to one
    row per procedure before their only shuffle.
    """
    net = star["fct_claim_line"].filter(F.col("procedure_sk").isNotNull()).select(
        "procedure_sk", "provider_sk", "unit_price_pkr").join(
        star["dim_provider"].select("provider_sk", "network_status"), "provider_sk")

    def mean_where(network: str):
        here = F.col("network_status") == network
        return mean_of(F.when(here, F.col("unit_price_pkr")))

    by_proc = net.groupBy("procedure_sk").agg(
        mean_where("In-Network").alias("in_network_avg_pkr"),
        mean_where("Out-of-Network").alias("out_network_avg_pkr"))
    both = by_proc.filter(F.col("in_network_avg_pkr").isNotNull() & F.col("out_network_avg_pkr").isNotNull())
    return (
        both.join(star["dim_procedure"].select("procedure_sk", "procedure_code", "description"), "procedure_sk")
        .select("procedure_code", "description", "in_network_avg_pkr", "out_network_avg_pkr",
                ratio("out_network_avg_pkr", "in_network_avg_pkr").alias("oon_cost_multiple"))
        .orderBy(F.desc_nulls_last("oon_cost_multiple"), "procedure_code")
    )


def v_provider_scorecard(star: Star) -> DataFrame:
    who = ["provider_id", "hospital_name", "provider_city", "provider_type", "network_status", "provider_tier"]
    t = provider_fold(
        star, who, claim_count=rows(), billed_pkr=F.sum("billed_amount_pkr"), billed_n=F.count("billed_amount_pkr"),
        paid_pkr=F.sum("paid_amount_pkr"), denied=F.sum("is_denied"), denied_n=F.count("is_denied"),
        savings_pkr=F.sum("savings_pkr"))
    return t.select(
        *who, "claim_count", "billed_pkr", "paid_pkr", ratio("billed_pkr", "billed_n").alias("avg_claim_value_pkr"),
        ratio("denied", "denied_n").alias("denial_rate"), "savings_pkr",
    ).orderBy(F.desc_nulls_last("billed_pkr"), "provider_id")


def provider_spend(star: Star) -> DataFrame:
    return provider_fold(star, ["provider_id", "hospital_name"], paid_pkr=F.sum("paid_amount_pkr"))


def v_provider_concentration(star: Star) -> DataFrame:
    ranked = ranked_running_sum(provider_spend(star), "paid_pkr", "provider_id", "spend_rank", "_through")
    total = star["fct_claim_header"].agg(F.sum("paid_amount_pkr").alias("t")).scalar()
    return ranked.withColumn("_total", total).select(
        "provider_id", "hospital_name", "paid_pkr",
        ratio("paid_pkr", "_total", positive=False).alias("spend_share"),
        "spend_rank",
        ratio("_through", "_total", positive=False).alias("cumulative_share"),
    ).orderBy("spend_rank")
