"""The data-quality rule catalogue.

A rule says what fails, as one of four shapes the engine knows how to run together:

* ``RowCheck``     a predicate on one row; all row checks of a table share one scan
* ``UniqueKey``    values of a key that occur more than once (one failure per value)
* ``FirstOnly``    rows that repeat an earlier row's business signature
* ``KnownParent``  rows whose key has no match in another table (a missing key has none)

Predicates follow SQL: a NULL predicate is not a failure.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from enum import StrEnum

from pyspark.sql import Column
from pyspark.sql import functions as F

from medledger.functions import canonical_city, days_between
from medledger.operators.staging import parsed_twin
from medledger.sources.schemas import (
    ADJUDICATION_MODES,
    CLAIM_STATUSES,
    CLAIM_TYPES,
    GENDERS,
    MAX_AGE,
    NETWORKS,
    PLAN_TIERS,
    PROVIDER_TYPES,
    RELATIONSHIPS,
    WINDOW_END,
)


class Severity(StrEnum):
    CRITICAL = "critical"
    HIGH = "high"
    MEDIUM = "medium"
    LOW = "low"


class Dimension(StrEnum):
    COMPLETENESS = "completeness"
    VALIDITY = "validity"
    CONSISTENCY = "consistency"
    UNIQUENESS = "uniqueness"
    ACCURACY = "accuracy"
    TIMELINESS = "timeliness"


# Weight of a severity in the score.
WEIGHT = {Severity.CRITICAL: 8, Severity.HIGH: 4, Severity.MEDIUM: 2, Severity.LOW: 1}

# The column that names a failing row, per table.
RECORD_KEY = {
    "claims_header": "claim_id", "claims_lines": "claim_line_id", "members": "member_id",
    "providers": "provider_id", "policies": "policy_id", "employer_groups": "group_id",
}


@dataclass(frozen=True)
class RowCheck:
    fails: Callable[[], Column]


@dataclass(frozen=True)
class UniqueKey:
    key: str


@dataclass(frozen=True)
class FirstOnly:
    """Over the business signature of claim headers, as raw text."""


@dataclass(frozen=True)
class KnownParent:
    key: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class Rule:
    id: str
    name: str
    dimension: Dimension
    severity: Severity
    table: str
    column: str | None
    check: RowCheck | UniqueKey | FirstOnly | KnownParent
    description: str = ""
    threshold: float = 0.0  # greatest failing share that still passes

    def __post_init__(self):
        if not 0.0 <= self.threshold <= 1.0:
            raise ValueError(f"threshold of {self.id} must be between 0 and 1")


# -- predicate building blocks ---------------------------------------------------
# A check reads raw text by column name and the parsed value through ``parsed``; the engine adds
# the parsed columns once per row, however many checks use them.
def parsed(c: str) -> Column:
    return F.col(f"`{parsed_twin(c)}`")


def missing(c: str) -> RowCheck:
    return RowCheck(lambda: F.col(c).isNull() | (F.col(c) == ""))


def not_one_of(c: str, values: tuple[str, ...], when_present: bool = False) -> RowCheck:
    def fails() -> Column:
        bad = ~F.col(c).isin(*values)
        return bad & (F.col(c) != "") if when_present else bad
    return RowCheck(fails)


def given(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & (F.col(c) != "")
    return out


def earlier(c: str, than: str) -> Column:
    return parsed(c) < parsed(than)


def more_days_than(later: str, since: str, limit: int) -> RowCheck:
    return RowCheck(lambda: given(later, since) & (days_between(parsed(later), parsed(since)) > limit))


def exceeds(c: str, limit_col: str) -> RowCheck:
    return RowCheck(lambda: parsed(c) > parsed(limit_col))


def untidy_city(c: str = "city") -> RowCheck:
    return RowCheck(lambda: (F.col(c) != canonical_city(c)) | (F.col(c) != F.trim(F.col(c))))


def _implausible_age() -> Column:
    dob, end = parsed("date_of_birth"), F.lit(WINDOW_END).cast("date")
    return dob.isNull() | (dob > end) | (days_between(end, dob) > MAX_AGE * 365)


def _denial_mismatch() -> Column:
    status, reason = F.col("status"), F.col("denial_reason_code")
    no_reason = reason.isNull() | (reason == "")
    return ((status == "Denied") & no_reason) | ((status != "Denied") & (reason != ""))


def _copay_out_of_range() -> Column:
    c = parsed("copay_pct")
    return (c < 0) | (c > 1)


def _line_off() -> Column:
    expected = parsed("unit_price_pkr") * parsed("quantity")
    return F.abs(parsed("line_billed_pkr") - expected) > 1


H, L, M, P, O, G = "claims_header", "claims_lines", "members", "providers", "policies", "employer_groups"
_C, _V, _K = Dimension.COMPLETENESS, Dimension.VALIDITY, Dimension.CONSISTENCY
_U, _A, _T = Dimension.UNIQUENESS, Dimension.ACCURACY, Dimension.TIMELINESS
CRIT, HIGH, MED, LOW = Severity.CRITICAL, Severity.HIGH, Severity.MEDIUM, Severity.LOW

# Identifier, name, dimension, severity, table and column of each rule.
RULES: list[Rule] = [
    Rule("C-HDR-ADJMODE", "Adjudication mode is populated", _C, MED, H, "adjudication_mode", missing("adjudication_mode")),
    Rule("C-HDR-CLAIMID", "Claim id is present", _C, CRIT, H, "claim_id", missing("claim_id")),
    Rule("C-HDR-MEMBERID", "Member id is present on claim", _C, CRIT, H, "member_id", missing("member_id")),
    Rule("C-HDR-PROVIDERID", "Provider id is present on claim", _C, CRIT, H, "provider_id", missing("provider_id")),
    Rule("C-LINE-CLAIMID", "Claim line references a claim", _C, CRIT, L, "claim_id", missing("claim_id")),
    Rule("C-MBR-DOB", "Member date of birth is present", _C, HIGH, M, "date_of_birth", missing("date_of_birth")),
    Rule("C-MBR-POLICY", "Member policy id is present", _C, HIGH, M, "policy_id", missing("policy_id")),
    Rule("V-HDR-STATUS", "Claim status is a known value", _V, HIGH, H, "status", not_one_of("status", CLAIM_STATUSES)),
    Rule("V-HDR-CTYPE", "Claim type is a known value", _V, HIGH, H, "claim_type", not_one_of("claim_type", CLAIM_TYPES)),
    Rule("V-HDR-ADJMODE", "Adjudication mode value is valid", _V, LOW, H, "adjudication_mode",
         not_one_of("adjudication_mode", ADJUDICATION_MODES, when_present=True)),
    Rule("V-MBR-GENDER", "Member gender is valid", _V, MED, M, "gender", not_one_of("gender", GENDERS)),
    Rule("V-MBR-REL", "Member relationship is valid", _V, LOW, M, "relationship", not_one_of("relationship", RELATIONSHIPS)),
    Rule("V-PRV-NETWORK", "Provider network status is valid", _V, MED, P, "network_status",
         not_one_of("network_status", NETWORKS)),
    Rule("V-PRV-TYPE", "Provider type is valid", _V, LOW, P, "provider_type", not_one_of("provider_type", PROVIDER_TYPES)),
    Rule("V-POL-TIER", "Plan tier is valid", _V, LOW, O, "plan_tier", not_one_of("plan_tier", PLAN_TIERS)),
    Rule("V-POL-COPAY", "Copay percentage in range", _V, LOW, O, "copay_pct", RowCheck(_copay_out_of_range)),
    Rule("V-HDR-DATEPARSE", "Submission date is parseable", _V, MED, H, "submission_date",
         RowCheck(lambda: given("submission_date") & parsed("submission_date").isNull())),
    Rule("V-MBR-AGE", "Member age is plausible", _V, HIGH, M, "date_of_birth", RowCheck(_implausible_age)),
    Rule("K-HDR-DISCHARGE", "Discharge is not before admission", _K, HIGH, H, "discharge_date",
         RowCheck(lambda: earlier("discharge_date", "admission_date"))),
    Rule("K-HDR-SUBMIT", "Submission is not before discharge", _K, MED, H, "submission_date",
         RowCheck(lambda: given("submission_date", "discharge_date") & earlier("submission_date", "discharge_date"))),
    Rule("K-MBR-CITY", "Member city is canonical", _K, LOW, M, "city", untidy_city()),
    Rule("K-PRV-CITY", "Provider city is canonical", _K, LOW, P, "city", untidy_city()),
    Rule("K-GRP-CITY", "Employer city is canonical", _K, LOW, G, "city", untidy_city()),
    Rule("K-HDR-DENIAL", "Denial reason consistent with status", _K, MED, H, "denial_reason_code", RowCheck(_denial_mismatch)),
    Rule("U-HDR-CLAIMID", "Claim id is unique", _U, CRIT, H, "claim_id", UniqueKey("claim_id")),
    Rule("U-LINE-ID", "Claim line id is unique", _U, CRIT, L, "claim_line_id", UniqueKey("claim_line_id")),
    Rule("U-MBR-ID", "Member id is unique", _U, CRIT, M, "member_id", UniqueKey("member_id")),
    Rule("U-PRV-ID", "Provider id is unique", _U, CRIT, P, "provider_id", UniqueKey("provider_id")),
    Rule("U-HDR-BIZDUP", "No duplicate business claims", _U, HIGH, H, None, FirstOnly()),
    Rule("A-HDR-APPR-BILLED", "Approved not greater than billed", _A, HIGH, H, "approved_amount_pkr",
         exceeds("approved_amount_pkr", "billed_amount_pkr")),
    Rule("A-HDR-PAID-APPR", "Paid not greater than approved", _A, HIGH, H, "paid_amount_pkr",
         exceeds("paid_amount_pkr", "approved_amount_pkr")),
    Rule("A-HDR-NONNEG", "Billed amount is positive", _A, HIGH, H, "billed_amount_pkr",
         RowCheck(lambda: parsed("billed_amount_pkr") <= 0)),
    Rule("A-LINE-MATH", "Line billed equals price x quantity", _A, LOW, L, "line_billed_pkr", RowCheck(_line_off)),
    Rule("T-HDR-ADJ-LAG", "Adjudication within SLA", _T, LOW, H, "adjudication_date",
         more_days_than("adjudication_date", "submission_date", 60)),
    Rule("T-HDR-PAYMENT", "Payment after adjudication", _T, MED, H, "payment_date",
         RowCheck(lambda: given("payment_date", "adjudication_date") & earlier("payment_date", "adjudication_date"))),
    Rule("T-HDR-SUBMIT-LAG", "Submission within filing limit", _T, LOW, H, "submission_date",
         more_days_than("submission_date", "discharge_date", 30)),
    Rule("R-HDR-MEMBER-FK", "Claim member exists", _V, HIGH, H, "member_id", KnownParent("member_id", M, "member_id")),
    Rule("R-HDR-PROVIDER-FK", "Claim provider exists", _V, HIGH, H, "provider_id",
         KnownParent("provider_id", P, "provider_id")),
    Rule("R-LINE-CLAIM-FK", "Claim line parent exists", _V, HIGH, L, "claim_id", KnownParent("claim_id", H, "claim_id")),
]


def rules_by_dimension(rules: list[Rule] | None = None) -> dict[Dimension, list[Rule]]:
    return {d: [r for r in (RULES if rules is None else rules) if r.dimension == d] for d in Dimension}
