"""Typed projections of the raw text tables: no filtering, no cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medledger.functions import (
    age_in_years,
    canonical_city,
    parse_date,
    parse_flag,
    parse_int,
    parse_number,
    text_or_null,
)
from medledger.functions.scalars import SHARE
from medledger.sources.schemas import RAW_COLUMNS, WINDOW_END

DATE, NUMBER, INT, CITY, FLAG, OPTIONAL = "date", "number", "int", "city", "flag", "optional"

_CONVERT = {
    DATE: parse_date,
    NUMBER: parse_number,
    INT: parse_int,
    CITY: canonical_city,
    FLAG: parse_flag,
    OPTIONAL: text_or_null,
    SHARE: lambda c: parse_number(c, SHARE),
}

# Columns that change type; every other raw column passes through as text.
TYPED = {
    "employer_groups": {"city": CITY, "contract_start": DATE, "contract_end": DATE, "lives_covered": INT,
                        "monthly_premium_pkr": NUMBER},
    "policies": {"annual_limit_pkr": NUMBER, "room_rent_cap_pkr": NUMBER, "deductible_pkr": NUMBER,
                 "copay_pct": SHARE, "maternity_covered": FLAG, "pre_existing_waiting_months": INT},
    "providers": {"city": CITY, "panel_since": DATE},
    "members": {"date_of_birth": DATE, "city": CITY, "enrolment_date": DATE, "termination_date": DATE},
    "diagnoses": {},
    "procedures": {"typical_cost_pkr": NUMBER},
    "claims_header": {
        **{f"{step}_date": DATE for step in ("admission", "discharge", "submission", "adjudication", "payment")},
        **{c: NUMBER for c in ("billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr", "member_share_pkr")},
        "denial_reason_code": OPTIONAL, "adjudication_mode": OPTIONAL,
    },
    "claims_lines": {"line_no": INT, "quantity": NUMBER, "unit_price_pkr": NUMBER, "line_billed_pkr": NUMBER,
                     "line_approved_pkr": NUMBER},
}


def parsed_twin(c: str) -> str:
    return f"{c}|parsed"


def with_parsed(table: str, raw: DataFrame) -> DataFrame:
    """The raw text columns with a parsed twin next to each date and number."""
    twins = {c: k for c, k in TYPED[table].items() if k in (DATE, NUMBER, INT, SHARE)}
    return raw.select("*", *[_CONVERT[k](c).alias(parsed_twin(c)) for c, k in twins.items()])


def stage(table: str, raw: DataFrame) -> DataFrame:
    kinds = TYPED[table]
    out = raw.select(*[
        _CONVERT[kinds[c]](c).alias(c) if c in kinds else F.col(c) for c in RAW_COLUMNS[table]
    ])
    if table == "members":
        out = out.withColumn("age_years", age_in_years("date_of_birth", WINDOW_END))
    return out


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {t: stage(t, df) for t, df in raw.items()}
