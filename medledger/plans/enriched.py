"""The denormalised claim, built from only the dimensions a query asks for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medledger.sources.lake import MONTH

Star = Mapping[str, DataFrame]

# column of the enriched claim -> column of the dimension that supplies it
FROM_DATE = {
    "claim_date": "date_day", "year_month": "year_month", "month_number": "month_number",
    "month_name_short": "month_name_short", "calendar_year": "calendar_year", "fiscal_year": "fiscal_year",
}
FROM_MEMBER = {
    "member_id": "member_id", "gender": "gender", "age_band": "age_band", "member_city": "city",
    "relationship": "relationship",
}
FROM_GROUP = {
    "employer_group_id": "group_id", "employer_name": "employer_name", "industry": "industry",
    "monthly_premium_pkr": "monthly_premium_pkr", "lives_covered": "lives_covered",
}
FROM_PROVIDER = {
    "provider_id": "provider_id", "hospital_name": "hospital_name", "provider_city": "city",
    "provider_type": "provider_type", "network_status": "network_status", "provider_tier": "tier",
}
FROM_POLICY = {"plan_tier": "plan_tier"}

# key column of the fact -> (dimension, its key, supplied columns)
LOOKUPS = {
    "submission_date_key": ("dim_date", "date_key", FROM_DATE),
    "member_sk": ("dim_member", "member_sk", FROM_MEMBER),
    "employer_group_sk": ("dim_employer_group", "employer_group_sk", FROM_GROUP),
    "provider_sk": ("dim_provider", "provider_sk", FROM_PROVIDER),
    "policy_sk": ("dim_policy", "policy_sk", FROM_POLICY),
}

# Output order of the full view.
ENRICHED_COLUMNS = [
    "claim_id", "claim_sk", *FROM_DATE, *FROM_MEMBER, *FROM_GROUP, *FROM_PROVIDER, *FROM_POLICY,
    "claim_type", "status", "adjudication_mode", "denial_reason_code",
    "billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr", "member_share_pkr", "savings_pkr",
    "length_of_stay", "tat_submit_to_adjudicate", "tat_adjudicate_to_pay", "tat_total", "is_denied", "is_auto",
]


def look_up(df: DataFrame, star: Star, wanted: list[str], on_date: str = "submission_date_key") -> DataFrame:
    """Left-join the dimensions that supply ``wanted``; the others are not touched.

    Surrogate keys are unique, so leaving a dimension out never changes the row count. That is
    what lets a monthly total run without shuffling the fact for a member join.
    """
    for fk, (dim, key, supplies) in LOOKUPS.items():
        need = {out: src for out, src in supplies.items() if out in wanted and out not in df.columns}
        if not need:
            continue
        fk = on_date if fk == "submission_date_key" else fk
        side = star[dim].select(F.col(key).alias(f"_{key}"), *[F.col(s).alias(o) for o, s in need.items()])
        if dim == "dim_date":  # 1,461 rows, always
            side = F.broadcast(side)
        df = df.join(side, F.col(fk) == F.col(f"_{key}"), "left").drop(f"_{key}")
    return df


def with_flags(fact: DataFrame) -> DataFrame:
    return fact.withColumns({
        "is_denied": (F.col("status") == "Denied").cast("int"),
        "is_auto": (F.col("adjudication_mode") == "Auto").cast("int"),
    })


def enriched(star: Star, columns: list[str] | None = None, on_date: str = "submission_date_key") -> DataFrame:
    """One row per claim. ``on_date`` picks the date role (submission by default, or admission...)."""
    columns = columns or ENRICHED_COLUMNS
    return look_up(with_flags(star["fct_claim_header"]), star, columns, on_date).select(*columns)


def submitted_between(fact: DataFrame, date_from: str | None, date_to: str | None) -> DataFrame:
    """Cut a fact by submission date, both ends inclusive, on its own keys: whole months are pruned
    as folders and the rest is a pushed integer comparison; the calendar is not needed for it."""
    bounds = [(">=", date_from), ("<=", date_to)]
    for op, day in bounds:
        if day:
            key = int(day.replace("-", ""))
            fact = fact.filter(f"submission_date_key {op} {key}")
            if MONTH in fact.columns:
                fact = fact.filter(f"{MONTH} {op} {key // 100}")
    return fact


def v_claims_enriched(star: Star) -> DataFrame:
    return enriched(star)
