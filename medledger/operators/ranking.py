"""Global ranks and running totals that no single task has to hold.

A window without a partition key would send every row to one task. Instead a row's bucket is worked out from its value
alone, by a step function that keeps the order: steps of a four-thousandth of the value. Buckets are ranked on their own,
and the buckets' totals, a narrow row each, shift the results. Nothing is sampled and no job runs before the query does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps by which a value has to grow to be e times as large.
STEPS = 4096


def bucket_of(value: str) -> Column:
    """A whole number that never falls as the value grows; NULL for NULL. Values are finite.

    Buckets number a few hundred thousand for amounts from cents to quadrillions, and 12 million for all doubles.
    """
    v = F.col(value).cast("double")
    size = F.floor((F.ln(F.abs(v)) + 750) * STEPS) + 1  # the least double is e**-745
    return F.when(v > 0, size).when(v < 0, -size).when(v == 0, F.lit(0).cast("bigint"))


def shared(df: DataFrame) -> DataFrame:
    """``df``, of which every reader reads all columns. Readers that Spark would prune differently then have one plan in
    common up to the last shuffle, and it runs once."""
    return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(2)) >= 0)  # always so, which only the data can tell


def running_totals(df: DataFrame, value: str, sums: list[str], ties: list[Column]) -> DataFrame:
    """Adds ``<s>_through``, the sum of ``s`` over all rows up to and including this one, in the
    order ``value`` descending (NULLs last), then ``ties``.

    Callers first fold equal values together, so that a bucket holds distinct values that differ by less than a
    four-thousandth: of amounts with two decimals around a million, 25,000 at most.
    """
    ranged = df.withColumn("_bucket", bucket_of(value))
    per_bucket = ranged.groupBy("_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.orderBy(F.desc_nulls_last("_bucket")).rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    shift = per_bucket.select(
        F.col("_bucket").alias("_of"), *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums])
    inside = (Window.partitionBy("_bucket").orderBy(F.col(value).desc_nulls_last(), *ties)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        ranged.withColumns({f"_in_{s}": F.sum(s).over(inside) for s in sums})
        .join(shift, F.col("_bucket").eqNullSafe(F.col("_of")))
        .withColumns({f"{s}_through": F.col(f"_in_{s}") + F.col(f"_before_{s}") for s in sums})
        .drop("_bucket", "_of", *[f"_in_{s}" for s in sums], *[f"_before_{s}" for s in sums])
    )


def ranked_running_sum(df: DataFrame, value: str, tie_id: str, rank_name: str, total_name: str) -> DataFrame:
    """``row_number`` and running sum of ``value``, highest first, over the whole of ``df``.

    The order among equal values is by the MD5 of ``tie_id``, then ``tie_id``. Equal values are
    folded into 256 hash slots first, so even a value shared by a third of the rows is spread out.
    """
    digest = F.md5(F.col(tie_id).cast("string"))
    rows = shared(df).withColumn("_slot", F.coalesce(F.substring(digest, 1, 2), F.lit("~")))
    folded = rows.groupBy(value, "_slot").agg(F.count(F.lit(1)).cast("bigint").alias("_n"), F.sum(value).alias("_sum"))
    marks = running_totals(shared(folded), value, ["_n", "_sum"], [F.col("_slot")])
    marks = marks.select(F.col(value).alias("_mark"), F.col("_slot").alias("_mark_slot"),
                         (F.col("_n_through") - F.col("_n")).alias("_n_before"),
                         (F.col("_sum_through") - F.coalesce(F.col("_sum"), F.lit(0))).alias("_sum_before"))
    place = Window.partitionBy(value, "_slot").orderBy(digest, tie_id)
    local = rows.withColumn("_place", F.row_number().over(place))
    j = local.join(marks, F.col(value).eqNullSafe(F.col("_mark")) & (F.col("_slot") == F.col("_mark_slot")))
    return (
        j.withColumn(rank_name, (F.col("_n_before") + F.col("_place")).cast("bigint"))
        # all rows of a slot share one value, so the sum within it is place x value
        .withColumn(total_name, F.col("_sum_before") + F.coalesce(F.col("_place") * F.col(value), F.lit(0)))
        .drop("_slot", "_place", "_mark", "_mark_slot", "_n_before", "_sum_before")
    )


def add_ranks(df: DataFrame, ranks: dict[str, str]) -> DataFrame:
    """SQL ``rank()``, highest first, of each value column in ``ranks`` (value -> rank name):
    one more than the rows strictly above."""
    rows = shared(df)
    out = rows
    for value, name in ranks.items():
        values = rows.groupBy(value).agg(F.count(F.lit(1)).cast("bigint").alias("_n"))
        marks = running_totals(shared(values), value, ["_n"], []).select(
            F.col(value).alias("_mark"), (F.col("_n_through") - F.col("_n") + 1).alias(name))
        out = out.join(marks, F.col(value).eqNullSafe(F.col("_mark"))).drop("_mark")
    return out
