"""Cleaning rules between staging and the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medledger.functions import days_between
from medledger.sources.schemas import CALENDAR_END, CALENDAR_START, MAX_AGE, WINDOW_END

# What makes two claims the same business event.
SIGNATURE = ["member_id", "provider_id", "admission_date", "billed_amount_pkr"]


def clean_members(members: DataFrame) -> DataFrame:
    """Drop members without a birth date, born after the window, or older than 120."""
    dob = F.col("date_of_birth")
    return members.filter(
        dob.isNotNull() & (dob <= F.lit(WINDOW_END).cast("date")) & F.col("age_years").between(0, MAX_AGE)
    )


def repeated_signatures(headers: DataFrame) -> DataFrame:
    """(signature): the hashes of signatures that more than one row has. Found narrow; where two signatures share a hash,
    it may stand for rows that are alone in theirs."""
    return headers.groupBy(F.xxhash64(*SIGNATURE).alias("signature")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("signature")


def first_per_signature(headers: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The first claim id of each signature, over all staged headers, valid or not.

    Written as ``row_number() = 1`` so that Spark plans a group limit on both sides of the
    shuffle: each map task keeps one row per signature, and a signature that owns a third of the
    table sends one row per map task.

    With the ``repeated_signatures``, stored so that Spark knows how few they are, only rows of those are shuffled.
    """
    if repeated is not None:
        keyed = headers.withColumn("_signature", F.xxhash64(*SIGNATURE))
        listed = repeated.select(F.col("signature").alias("_signature"))
        alone, others = (keyed.join(listed, "_signature", how).drop("_signature") for how in ("left_anti", "left_semi"))
        return alone.union(first_per_signature(others))
    w = Window.partitionBy(*SIGNATURE).orderBy(F.col("claim_id").asc_nulls_last())
    return headers.withColumn("dup_rank", F.row_number().over(w)).filter("dup_rank = 1").drop("dup_rank")


def is_sound(c=F.col) -> Column:
    """Row checks of a header; a NULL on either side of a comparison drops the row."""
    billed, approved, paid = c("billed_amount_pkr"), c("approved_amount_pkr"), c("paid_amount_pkr")
    return (
        c("adjudication_mode").isNotNull()
        & (billed > 0)
        & (approved >= 0)
        & (paid >= 0)
        & (approved <= billed)
        & (paid <= approved)
        & (c("discharge_date") >= c("admission_date"))
    )


def sound_claims(headers: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """De-duplicate, then check rows. The order matters: an unsound first copy hides its duplicates."""
    return first_per_signature(headers, repeated).filter(is_sound()).withColumns({
        "days_discharge_to_submit": days_between("submission_date", "discharge_date"),
        "days_submit_to_adjudicate": days_between("adjudication_date", "submission_date"),
        "days_adjudicate_to_pay": days_between("payment_date", "adjudication_date"),
        "length_of_stay": days_between("discharge_date", "admission_date"),
    })


def clean_claims(headers: DataFrame, cleaned_members: DataFrame, providers: DataFrame,
                 repeated: DataFrame | None = None) -> DataFrame:
    """Sound claims of known members and providers."""
    return (
        sound_claims(headers, repeated)
        .join(providers.select("provider_id"), "provider_id", "left_semi")
        .join(cleaned_members.select("member_id"), "member_id", "left_semi")
    )


def is_sound_line() -> Column:
    return (F.col("line_billed_pkr") >= 0) & (F.col("line_approved_pkr") >= 0) & (F.col("quantity") > 0)


def clean_lines(lines: DataFrame, claims: DataFrame) -> DataFrame:
    """Sound lines of surviving claims. Inner, as the reference semantics have it: claim ids are
    unique once the critical uniqueness rule has passed."""
    return lines.filter(is_sound_line()).join(claims.select("claim_id"), "claim_id")


def date_spine(spark: SparkSession) -> DataFrame:
    span = F.sequence(F.lit(CALENDAR_START).cast("date"), F.lit(CALENDAR_END).cast("date"))
    return spark.range(1).select(F.explode(span).alias("date_day"))
