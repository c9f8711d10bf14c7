"""Fraud and waste signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medledger.functions import mean_of, ratio
from medledger.operators.cleaning import SIGNATURE
from medledger.operators.duplicates import repeated_signatures, signature_copies
from medledger.operators.joins import null_safe_join
from medledger.operators.ranking import shared
from medledger.plans.enriched import Star, look_up
from medledger.plans.financial import rows
from medledger.plans.network import provider_fold


def v_provider_anomaly(star: Star, sigmas: int = 2) -> DataFrame:
    """Mean claim value of a provider against all providers of its type."""
    who = ["provider_id", "hospital_name", "provider_type", "network_status"]
    t = provider_fold(star, who, claim_count=rows(), billed=F.sum("billed_amount_pkr"), n=F.count("billed_amount_pkr"))
    # Provider grain, read by the peer statistics and by the join: shared, so the claims are added up once.
    p = shared(t).select(*who, "claim_count", ratio("billed", "n").alias("avg_claim_value"))
    peers = p.groupBy("provider_type").agg(
        F.avg("avg_claim_value").alias("peer_mean"), F.stddev_pop("avg_claim_value").alias("peer_sd"))
    v, m, s = F.col("avg_claim_value"), F.col("peer_mean"), F.col("peer_sd")
    return p.join(peers, "provider_type").select(
        *who, "claim_count", "avg_claim_value", "peer_mean", "peer_sd",
        ratio(v - m, s).alias("z_score"),
        ((s > 0) & (v > m + sigmas * s)).alias("is_anomalous"),
    ).orderBy(F.desc_nulls_last("z_score"), "provider_id")


def v_duplicate_candidates(raw_headers: DataFrame) -> DataFrame:
    """Raw signatures seen more than once: a row for each of their claim ids, in order.

    It is the list of ids unnested, so a signature of any size keeps one shape: ``occurrence_count``
    is that of the signature, ``copies`` that of the claim id within it.
    """
    return signature_copies(raw_headers).select(*SIGNATURE, "occurrence_count", "claim_id", "copies").orderBy(
        F.desc("occurrence_count"), F.desc("billed_amount_pkr"), *SIGNATURE, "claim_id")


def duplicate_claim_flag(raw_headers: DataFrame) -> DataFrame:
    """Every claim with 1 if its signature occurs more than once. Counted by aggregation and joined
    back, so a very common signature is never one window partition."""
    repeated = repeated_signatures(raw_headers).select(*SIGNATURE, F.lit(1).alias("duplicate_claim_flag"))
    j = null_safe_join(raw_headers.select("claim_id", *SIGNATURE), repeated, SIGNATURE, "left")
    return j.withColumn("duplicate_claim_flag", F.coalesce("duplicate_claim_flag", F.lit(0)))


def v_high_frequency_members(star: Star, sigmas: int = 2) -> DataFrame:
    """Members with more claims than mean + 2 sigma. Population statistics are one scalar row."""
    per_sk = star["fct_claim_header"].groupBy("member_sk").agg(
        rows().alias("claim_count"), F.sum("paid_amount_pkr").alias("paid_pkr"))
    # The versions of a member are added up once more; read by the statistics and by the filter, so shared.
    per_member = shared(look_up(per_sk, star, ["member_id"]).groupBy("member_id").agg(
        F.sum("claim_count").alias("claim_count"), F.sum("paid_pkr").alias("paid_pkr")))
    stats = per_member.agg(F.struct(
        mean_of("claim_count").alias("mean_freq"), F.stddev_pop("claim_count").alias("sd_freq")).alias("s"))
    m = per_member.withColumn("_s", stats.scalar())
    mean, sd = F.col("_s.mean_freq"), F.col("_s.sd_freq")
    return (
        m.filter((sd > 0) & (F.col("claim_count") > mean + sigmas * sd))
        .select("member_id", "claim_count", "paid_pkr", mean.alias("mean_freq"),
                ratio(F.col("claim_count") - mean, sd).alias("z_score"))
        .orderBy(F.desc("claim_count"), "member_id")
    )


def upcoding_proxy(star: Star) -> DataFrame:
    """Share of a provider's billed value per procedure category, against providers of its type.

    The peer mean and sigma are over the providers of the type that bill the category at all.
    """
    proc = star["dim_procedure"].select("procedure_sk", "category")
    per = (
        star["fct_claim_line"].select("provider_sk", "procedure_sk", "line_billed_pkr").join(proc, "procedure_sk")
        .groupBy("provider_sk", "category").agg(F.sum("line_billed_pkr").alias("category_billed_pkr"))
    )
    per = look_up(per, star, ["provider_id", "provider_type"]).groupBy("provider_id", "provider_type", "category").agg(
        F.sum("category_billed_pkr").alias("category_billed_pkr"))
    total = per.groupBy("provider_id", "provider_type").agg(F.sum("category_billed_pkr").alias("_total"))
    share = null_safe_join(per, total, ["provider_id", "provider_type"])
    p = share.select("provider_id", "provider_type", "category", "category_billed_pkr",
                     ratio("category_billed_pkr", "_total").alias("category_share"))
    peers = p.groupBy("provider_type", "category").agg(
        F.avg("category_share").alias("peer_mean_share"), F.stddev_pop("category_share").alias("_sd"))
    return p.join(peers, ["provider_type", "category"]).select(
        "provider_id", "provider_type", "category", "category_billed_pkr", "category_share", "peer_mean_share",
        ratio(F.col("category_share") - F.col("peer_mean_share"), F.col("_sd")).alias("z_score"))
