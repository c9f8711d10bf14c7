"""Versions of dimension rows from snapshots, and the version that held at a time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medledger.functions.scalars import OPEN_END

#: A key is hot if it has more than this part of all rows.
HOT = 1024


def versions_of(snapshots: DataFrame, key: str, taken: str, tracked: list[str] | None = None) -> DataFrame:
    """Versions from whole snapshots of a table, told apart by the date in ``taken``: the tracked columns with
    ``valid_from``, ``valid_to`` (exclusive; 9999-12-31 while it lasts) and ``is_current``.

    A version begins where a key is new, comes back, or has other values than in the snapshot before (by a hash of the
    tracked columns), and ends at the first snapshot that no longer shows it. A key that returns unchanged after it was
    missing gets a second version. Of rows that repeat a key in one snapshot the least by hash counts. A null key names
    nothing and is left out. The window of a key sees a row for each snapshot that shows it.
    """
    columns = tracked or [c for c in snapshots.columns if c not in (key, taken)]
    rows = snapshots.filter(F.col(key).isNotNull() & F.col(taken).isNotNull()).select(
        key, F.col(taken).alias("_taken"), F.struct(F.xxhash64(*columns).alias("h"), *columns).alias("_row"))
    rows = rows.groupBy(key, "_taken").agg(F.min("_row").alias("_row"))
    dates = rows.select("_taken").distinct()
    following = dates.select("_taken", F.lead("_taken").over(Window.orderBy("_taken")).alias("_next"))  # a row a snapshot
    of_key = Window.partitionBy(key).orderBy("_taken")
    same = (F.lag("_next").over(of_key) == F.col("_taken")) & (F.lag("_row.h").over(of_key) == F.col("_row.h"))
    marked = rows.join(F.broadcast(following), "_taken").withColumn("_begins", ~F.coalesce(same, F.lit(False)))
    # A version's last snapshot is the one before the next beginning.
    run = F.sum(F.col("_begins").cast("int")).over(of_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = marked.withColumn("_run", run).groupBy(key, "_run").agg(
        F.min("_taken").alias("valid_from"), F.max_by("_next", "_taken").alias("_to"), F.any_value("_row").alias("_row"))
    return whole.select(
        key, *[F.col(f"_row.{c}").alias(c) for c in columns], "valid_from",
        F.coalesce("_to", F.lit(OPEN_END).cast("date")).alias("valid_to"), F.col("_to").isNull().alias("is_current"))


def overlaps(versions: DataFrame, key: str) -> DataFrame:
    """Neighbouring versions of a key of which the first ends after the second begins."""
    nxt = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from", "valid_to"))
    return versions.withColumn("next_from", nxt).filter("next_from < valid_to")


def as_of_last(facts: DataFrame, versions: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """Each fact with ``columns`` of the version that holds for its key at the time ``at`` (``valid_from`` inclusive,
    ``valid_to`` exclusive); null where none does.

    Facts and versions are one sequence by time, along which the last version is carried on: a key with many versions
    multiplies no row, and all facts come out once. Facts of a hot key, of which there are fewer than ``HOT``, are dealt
    over so many groups that none has more than the others, and its versions go to each. Versions of a key must not
    overlap (``overlaps``). Facts with a null key or time get nulls.
    """
    total = facts.agg(F.count("*").alias("n")).scalar()
    counted = facts.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n"))
    salts = F.ceil(F.col("_n") * HOT / total).cast("int")
    hot = F.broadcast(counted.filter(F.col("_n") * HOT > total).select("_hot", salts.alias("_salts")))

    def dealt(df: DataFrame, of: Column) -> DataFrame:
        return df.join(hot, of == F.col("_hot"), "left").withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_hot")

    names = [f"_f{k}" for k in range(len(facts.columns))]
    f = facts.toDF(*names)
    k, t = (F.col(names[facts.columns.index(c)]) for c in (key, at))
    salt = F.pmod(F.xxhash64(*names), F.col("_salts")).cast("int")
    left = dealt(f, k).select(
        k.alias("_key"), t.alias("_at"), salt.alias("_salt"), F.lit(1).alias("_side"), F.struct(*names).alias("_fact"))
    held = F.struct(F.col("valid_to").alias("to"), *columns)
    right = dealt(versions.filter(F.col(key).isNotNull()), F.col(key)).select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.explode(F.expr("sequence(0, _salts - 1)")).alias("_salt"),
        F.lit(0).alias("_side"), held.alias("_version"))
    along = Window.partitionBy("_key", "_salt").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = left.filter("_key IS NOT NULL AND _at IS NOT NULL")
    filled = named.unionByName(right, allowMissingColumns=True).withColumn("_last", F.last("_version", ignorenulls=True).over(along))
    holds = F.col("_last.to") > F.col("_at")
    out = filled.filter("_side = 1").select(
        "_fact.*", *[F.when(holds, F.col(f"_last.{c}")).alias(c) for c in columns])
    unnamed = left.filter("_key IS NULL OR _at IS NULL").select("_fact.*")
    final = out.unionByName(unnamed, allowMissingColumns=True)
    return reduce(lambda df, x: df.withColumnRenamed(*x), zip(names, facts.columns, strict=True), final)
