"""Stored monthly summaries that merge exactly over any range of months, without reading the claims again.

Distinct members are kept as bitmaps over dense member numbers, turnaround days as how many claims took how long. Both are
small, are replaced a month at a time, and give for a range what the aggregate over its claims would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medledger.plans.enriched import Star
from medledger.sources.lake import MONTH, Lake

SUMMARIES = ("member_numbers", "member_bitmaps", "turnaround_counts")
SPREAD = 4096


def month_index(month: Column | str) -> Column:
    """Months since year 0 of a yyyymm number."""
    m = F.col(month) if isinstance(month, str) else month
    return F.floor(m / 100).cast("int") * 12 + m % 100 - 1


def month_number(index: Column) -> Column:
    return (F.floor(index / 12) * 100 + index % 12 + 1).cast("int")


def number_members(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(member_sk, member_no): a number from 1 on for each member key, without gaps, and for good.

    Members that ``known`` numbers keep their numbers, and the others follow; so bitmaps stored before stay right. Keys
    are numbered within 4,096 hash parts, which the parts' counts (a row each) shift: no task sees all members.
    """
    keys = members.select("member_sk").filter("member_sk IS NOT NULL").distinct()
    if known is not None:
        keys = keys.join(known, "member_sk", "left_anti")
    dealt = keys.withColumn("part", F.pmod(F.xxhash64("member_sk"), F.lit(SPREAD)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("member_sk"))
    numbered = dealt.withColumn("place", place).join(shift, "part").select(
        "member_sk", (F.col("shift") + F.col("place")).alias("member_no"))
    if known is None:
        return numbered
    last = known.agg(F.coalesce(F.max("member_no"), F.lit(0)).alias("n")).scalar()
    return known.select("member_sk", "member_no").union(numbered.select("member_sk", F.col("member_no") + last))


def member_bitmaps(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """(submission_month, claim_type, block, bits): which members claimed, 32,768 numbers a block.

    A member's claims are one row a task before they are shuffled, with the months and types they have, however many there
    are; the one shuffle by member is also that of the join with the numbers.
    """
    per_member = fact.filter(F.col(MONTH).isNotNull()).groupBy("member_sk").agg(
        F.collect_set(F.struct(MONTH, "claim_type")).alias("in"))
    used = per_member.join(numbers, "member_sk").select("member_no", F.explode("in").alias("in")).select("member_no", "in.*")
    return used.groupBy(
        MONTH, "claim_type", F.bitmap_bucket_number("member_no").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("member_no")).alias("bits"))


def turnaround_counts(fact: DataFrame) -> DataFrame:
    """(submission_month, adjudication_mode, days, claims): how many claims took so many days to be adjudicated."""
    took = F.col("tat_submit_to_adjudicate").alias("days")
    return fact.filter(F.col(MONTH).isNotNull() & F.col("tat_submit_to_adjudicate").isNotNull()).groupBy(
        MONTH, "adjudication_mode", took).agg(F.count("*").alias("claims"))


def build_summaries(lake: Lake, marts: Star, known: DataFrame | None = None) -> dict[str, DataFrame]:
    """Store the summaries of all months; ``known`` are the member numbers of an earlier version."""
    numbers = lake.replace("summaries", "member_numbers", number_members(marts["dim_member"], known))
    fact = marts["fct_claim_header"]
    return {
        "member_numbers": numbers,
        "member_bitmaps": lake.replace_all_partitions("summaries", "member_bitmaps", member_bitmaps(fact, numbers), MONTH),
        "turnaround_counts": lake.replace_all_partitions("summaries", "turnaround_counts", turnaround_counts(fact), MONTH),
    }


def refresh_month(lake: Lake, marts: Star, month: int) -> None:
    """Build one month (yyyymm) anew: its partitions are replaced, the others stay, and only its claims are read.

    A month that has no claims any more keeps what it had; new members are numbered after the known ones first.
    """
    fact = marts["fct_claim_header"].filter(F.col(MONTH) == month)
    known = lake.read("summaries", "member_numbers")
    fresh = number_members(marts["dim_member"], known).join(known, "member_sk", "left_anti")
    fresh.write.mode("append").parquet(lake.path("summaries", "member_numbers"))
    numbers = lake.read("summaries", "member_numbers")
    lake.replace_partition("summaries", "member_bitmaps", member_bitmaps(fact, numbers), MONTH)
    lake.replace_partition("summaries", "turnaround_counts", turnaround_counts(fact), MONTH)


def in_months(summary: DataFrame, month_from: int | None, month_to: int | None) -> DataFrame:
    """A range of months (yyyymm, both inclusive): only their folders are read."""
    if month_from is not None:
        summary = summary.filter(F.col(MONTH) >= month_from)
    return summary if month_to is None else summary.filter(F.col(MONTH) <= month_to)


def distinct_members(bitmaps: DataFrame, month_from: int | None = None, month_to: int | None = None,
                     by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct Members of a range of months, by claim type or month if asked: the bits of a block are put together,
    then counted. Equal to ``count(DISTINCT member_sk)`` over the claims."""
    merged = in_months(bitmaps, month_from, month_to).groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("distinct_members"))


def rolling_members(bitmaps: DataFrame, months: int = 3, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct members of each month and the ``months`` - 1 before it, up to the last month stored: each stored block
    counts for so many months, so a range is never read twice."""
    last = bitmaps.agg(F.max(MONTH).alias("m")).scalar()
    index = month_index(MONTH)
    counts_for = F.explode(F.sequence(index, index + months - 1))
    spread = bitmaps.select(*by, "block", "bits", counts_for.alias("index")).withColumn(MONTH, month_number(F.col("index")))
    return distinct_members(spread.filter(F.col(MONTH) <= last), by=(MONTH, *by))


def turnaround(counts: DataFrame, month_from: int | None = None, month_to: int | None = None,
               by: tuple[str, ...] = ()) -> DataFrame:
    """Claims, mean, median and 90th percentile of the days to adjudication over a range of months, exact: equal days are
    added up first, and the percentiles weigh each by its number of claims."""
    merged = in_months(counts, month_from, month_to).groupBy(*by, "days").agg(F.sum("claims").alias("claims"))
    return merged.groupBy(*by).agg(
        F.sum("claims").alias("claims"),
        (F.sum(F.col("days") * F.col("claims")) / F.sum("claims")).alias("tat_mean"),
        F.percentile("days", F.lit(0.5), F.col("claims")).alias("tat_median"),
        F.percentile("days", F.lit(0.9), F.col("claims")).alias("tat_p90"))
