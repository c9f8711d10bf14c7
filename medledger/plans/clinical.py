"""Clinical and utilisation views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medledger.functions import date_of_key, days_between, mean_of, ratio
from medledger.plans.enriched import Star
from medledger.plans.financial import rows
from medledger.sources.schemas import STAY_TYPES

READMIT_DAYS = 30


def _by_code(star: Star, dim: str, sk: str, attrs: list[str], with_quantity: bool) -> DataFrame:
    """Add the lines up per key first, then look the key up: the join sees one row per code."""
    sums = [rows().alias("line_count")]
    if with_quantity:
        sums.append(F.sum("quantity").alias("total_quantity"))
    sums += [F.sum("line_billed_pkr").alias("billed_pkr"), F.sum("line_approved_pkr").alias("approved_pkr")]
    per_key = star["fct_claim_line"].filter(F.col(sk).isNotNull()).groupBy(sk).agg(*sums)
    return per_key.join(star[dim].select(sk, *attrs), sk).drop(sk).select(
        *attrs, *[c for c in per_key.columns if c != sk])


def v_top_diagnoses(star: Star) -> DataFrame:
    return _by_code(star, "dim_diagnosis", "diagnosis_sk", ["diagnosis_code", "description", "chapter"], False).orderBy(
        F.desc_nulls_last("line_count"), "diagnosis_code")


def v_top_procedures(star: Star) -> DataFrame:
    return _by_code(star, "dim_procedure", "procedure_sk", ["procedure_code", "description", "category"], True).orderBy(
        F.desc_nulls_last("billed_pkr"), "procedure_code")


def v_utilisation(star: Star) -> DataFrame:
    """Claims per thousand current members; the population is a scalar subquery."""
    population = star["dim_member"].filter("is_current").agg(rows().alias("n"))
    stay = F.when(F.col("claim_type").isin(*STAY_TYPES), F.col("length_of_stay"))
    u = star["fct_claim_header"].groupBy("claim_type").agg(
        rows().alias("claim_count"), mean_of(stay).alias("avg_length_of_stay"), F.sum("paid_amount_pkr").alias("paid_pkr"))
    return u.select(
        "claim_type", "claim_count",
        ratio(1000 * F.col("claim_count"), population.scalar(), positive=False).alias("claims_per_1000_members"),
        "avg_length_of_stay", "paid_pkr",
    ).orderBy(F.desc_nulls_last("claim_count"), "claim_type")


def admissions(star: Star) -> DataFrame:
    """Stays with the chapter of their first line; claims without lines drop out."""
    first_line = (
        star["fct_claim_line"].filter(F.col("claim_type").isin(*STAY_TYPES))
        .groupBy("claim_id")
        .agg(F.min_by("diagnosis_sk", F.struct("line_no", "claim_line_id")).alias("diagnosis_sk"))
    )
    stays = star["fct_claim_header"].filter(
        F.col("claim_type").isin(*STAY_TYPES) & F.col("admission_date_key").isNotNull()
    ).select("claim_id", "member_sk", date_of_key("admission_date_key").alias("admit_day"))
    return (
        stays.join(first_line, "claim_id")
        .join(star["dim_diagnosis"].select("diagnosis_sk", "chapter"), "diagnosis_sk")
        .drop("diagnosis_sk")
    )


def v_readmissions(star: Star, within: int = READMIT_DAYS) -> DataFrame:
    """Pairs of stays of one member and chapter, 1 to 30 days apart.

    Days are cut into blocks as long as the window. The later stay sits in its own block; the
    earlier one is copied to its block and the next, so every pair meets in exactly one block.
    The equi-join key (member, chapter, block) splits a member with very many stays over time,
    and no pair further apart than two blocks is ever formed.
    """
    day_no = F.datediff("admit_day", F.lit("1970-01-01").cast("date"))
    # The keys of the join are tested here, so both sides read the same admissions, shuffled once.
    a = admissions(star).withColumn("at", F.floor(day_no / within)).filter(
        "member_sk IS NOT NULL AND chapter IS NOT NULL AND at IS NOT NULL")
    block = F.col("at")
    early = a.select("member_sk", "chapter", F.col("claim_id").alias("index_claim_id"),
                     F.col("admit_day").alias("index_day"),
                     F.explode(F.array(block, block + 1)).alias("block"))
    late = a.select("member_sk", "chapter", F.col("claim_id").alias("readmit_claim_id"),
                    F.col("admit_day").alias("readmit_day"), block.alias("block"))
    gap = days_between("readmit_day", "index_day")
    return (
        early.join(late, ["member_sk", "chapter", "block"])
        .filter(gap.between(1, within))
        .select("member_sk", "chapter", "index_claim_id", "readmit_claim_id", gap.alias("days_between"))
    )
