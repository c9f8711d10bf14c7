"""Repeated keys and signatures, without ever gathering one group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medledger.operators.cleaning import SIGNATURE
from medledger.operators.joins import null_safe_join

BLOCK = 100_000


def repeated_signatures(headers: DataFrame) -> DataFrame:
    return headers.groupBy(*SIGNATURE).agg(
        F.count(F.lit(1)).alias("occurrence_count"), F.min("claim_id").alias("first_claim_id")
    ).filter("occurrence_count > 1")


def signature_copies(headers: DataFrame) -> DataFrame:
    """One row per (repeated signature, claim id) with the number of copies of that id."""
    rows = headers.select(*SIGNATURE, "claim_id")
    hit = null_safe_join(rows, repeated_signatures(headers), SIGNATURE)
    return hit.groupBy(*SIGNATURE, "occurrence_count", "first_claim_id", "claim_id").agg(
        F.count(F.lit(1)).alias("copies"))


def spread_copies(df: DataFrame, n: str, block: int = BLOCK) -> DataFrame:
    """Repeat each row ``n`` times. A row is first cut into blocks that are dealt out over the
    cluster, so one huge count is not expanded by one task; ``block`` numbers the blocks."""
    blocks = df.filter(F.col(n) > 0).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / block))))
    take = F.least(F.lit(block).cast("bigint"), F.col(n) - F.col("block") * block)
    dealt = blocks.repartition(F.xxhash64(*df.columns, "block"))
    return dealt.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), take))).drop("_i", n)


def surplus_claims(headers: DataFrame) -> DataFrame:
    """All claims of a repeated signature but the first by claim id (NULL ids sort last)."""
    c = signature_copies(headers)
    is_first = F.col("claim_id").eqNullSafe(F.col("first_claim_id"))
    surplus = c.withColumn("_surplus", F.col("copies") - F.when(is_first, 1).otherwise(0))
    return spread_copies(surplus, "_surplus").select(F.col("claim_id").alias("record_key"))
