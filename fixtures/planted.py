"""Marts with planted violations: each kind of warehouse assertion fails on some row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _planted(df: DataFrame, key: str, changes: dict[str, dict[str, object]], twice: str | None = None) -> DataFrame:
    """``df`` with columns changed where the last two letters of ``key`` say so, and rows of one ending twice."""
    end = F.substring(F.col(key).cast("string"), -2, 2)
    columns = []
    for f in df.schema.fields:
        c: Column = F.col(f.name)
        for ending, value in changes.get(f.name, {}).items():
            c = F.when(end == ending, value if isinstance(value, Column) else F.lit(value)).otherwise(c)
        columns.append(c.cast(f.dataType).alias(f.name))
    changed = df.select(*columns)
    return changed if twice is None else changed.union(changed.filter(end == twice))


def planted_marts(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The models with violations by the endings of their natural keys."""
    claims = models["stg_claims_header"]
    return {
        **models,
        "stg_claims_header": claims.filter(F.substring("claim_id", -1, 1) == "1"),
        "fct_claim_header": _planted(models["fct_claim_header"], "claim_id", {
            "member_sk": {"02": "nobody"}, "provider_sk": {"03": None}, "status": {"04": "Lost"},
            "approved_amount_pkr": {"05": F.col("billed_amount_pkr") + 1}, "paid_amount_pkr": {"06": F.col("approved_amount_pkr") + 1},
            "length_of_stay": {"07": -1}, "member_share_pkr": {"32": -1}, "adjudication_mode": {"33": None},
            "claim_type": {"34": "Spa"}, "policy_sk": {"35": "none"}}, twice="36"),
        "fct_claim_line": _planted(models["fct_claim_line"], "claim_line_id", {
            "claim_id": {"01": "none", "02": None}, "procedure_sk": {"03": "none"}}, twice="04"),
        "fct_monthly_member_summary": _planted(models["fct_monthly_member_summary"], "member_id", {
            "claim_count": {"07": 0}, "member_sk": {"08": "nobody"}}, twice="10"),
        "dim_member": _planted(models["dim_member"], "member_id", {
            "age_years": {"11": 200}, "gender": {"13": "X"}, "relationship": {"14": "Cousin"}, "policy_id": {"16": "none"},
            "is_current": {"17": None}}, twice="19"),
        "dim_provider": _planted(models["dim_provider"], "provider_id", {"network_status": {"03": "Maybe"}}),
        "dim_policy": _planted(models["dim_policy"], "policy_id", {"plan_tier": {"02": "Tin"}}, twice="03"),
        "dim_date": _planted(models["dim_date"], "date_key", {"fiscal_year": {"02": None}}, twice="05"),
    }
