"""Joins the star offers beyond plain key look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_of_join(fact: DataFrame, versions: DataFrame, key: str, on_date: str, how: str = "left",
               valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Each fact row with the version of ``key`` valid on ``on_date``; both ends inclusive.

    The key is the equality that carries the shuffle; the validity window is tested within it.
    """
    v = versions.withColumnRenamed(key, "_version_key")
    at = F.col(on_date)
    cond = (F.col(key) == F.col("_version_key")) & at.between(F.col(valid_from), F.col(valid_to))
    return fact.join(v, cond, how).drop("_version_key")


def restrict(df: DataFrame, user_groups: DataFrame, user: str, group_col: str = "employer_group_id") -> DataFrame:
    """Row-level filter: only rows of the employer groups mapped to ``user``."""
    allowed = user_groups.filter(F.col("email") == user).select(F.col("group_id").alias(group_col))
    return df.join(allowed, group_col, "left_semi")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL with NULL; keeps the left copy of the keys, or for a full join
    whichever side has one."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = one if cond is None else cond & one
    joined = left.join(r, cond, how)
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"_r_{k}") for k in keys})
    return joined.drop(*[f"_r_{k}" for k in keys])
