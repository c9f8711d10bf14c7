"""Warehouse assertions: 80 generic column checks and 9 business checks, each a failure count.

Row checks of one table (not null, accepted values, business conditions) share one aggregation;
uniqueness and references of all tables share one more.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medledger.sources.landing import union_all
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

Models = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Checks:
    """The generic checks of one model."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


def _key(*cols: str) -> Checks:
    return Checks(unique=cols, not_null=cols)


GENERIC: dict[str, Checks] = {
    "stg_employer_groups": _key("group_id"),
    "stg_policies": _key("policy_id"),
    "stg_providers": _key("provider_id"),
    "stg_members": _key("member_id"),
    "stg_diagnoses": _key("diagnosis_code"),
    "stg_procedures": _key("procedure_code"),
    "stg_claims_header": Checks(not_null=("claim_id",)),
    "stg_claims_lines": Checks(not_null=("claim_line_id",)),
    "dim_date": Checks(unique=("date_key",), not_null=("date_key", "date_day", "fiscal_year")),
    "dim_member": Checks(("member_sk",), ("member_sk", "member_id", "is_current"),
                         {"gender": GENDERS, "relationship": RELATIONSHIPS}, {"policy_id": ("dim_policy", "policy_id")}),
    "dim_provider": Checks(("provider_sk",), ("provider_sk", "provider_id"),
                           {"network_status": NETWORKS, "provider_type": PROVIDER_TYPES}),
    "dim_employer_group": _key("employer_group_sk", "group_id"),
    "dim_policy": Checks(("policy_sk", "policy_id"), ("policy_sk", "policy_id"), {"plan_tier": PLAN_TIERS}),
    "dim_diagnosis": _key("diagnosis_sk", "diagnosis_code"),
    "dim_procedure": _key("procedure_sk", "procedure_code"),
    "dim_claim_status": Checks(("claim_status_sk", "status"), ("claim_status_sk",), {"status": CLAIM_STATUSES}),
    "dim_claim_type": Checks(("claim_type_sk", "claim_type"), ("claim_type_sk",), {"claim_type": CLAIM_TYPES}),
    "fct_claim_header": Checks(
        ("claim_sk", "claim_id"), ("claim_sk", "claim_id", "member_sk", "provider_sk", "adjudication_mode"),
        {"status": CLAIM_STATUSES, "claim_type": CLAIM_TYPES, "adjudication_mode": ADJUDICATION_MODES},
        {"member_sk": ("dim_member", "member_sk"), "provider_sk": ("dim_provider", "provider_sk"),
         "policy_sk": ("dim_policy", "policy_sk")}),
    "fct_claim_line": Checks(
        ("claim_line_sk", "claim_line_id"), ("claim_line_sk", "claim_line_id", "claim_id"), {},
        {"claim_id": ("fct_claim_header", "claim_id"), "procedure_sk": ("dim_procedure", "procedure_sk"),
         "diagnosis_sk": ("dim_diagnosis", "diagnosis_sk")}),
    "fct_monthly_member_summary": Checks(
        ("member_month_sk",), ("member_month_sk", "member_sk"), {}, {"member_sk": ("dim_member", "member_sk")}),
}


def business_row_checks() -> dict[str, dict[str, Column]]:
    """What must not be true of any row, per model."""
    c = F.col
    negative = F.lit(False)
    for a in ("billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr", "member_share_pkr"):
        negative = negative | (c(a) < 0)
    return {
        "fct_claim_header": {
            "approved_le_billed": c("approved_amount_pkr") > c("billed_amount_pkr"),
            "paid_le_approved": c("paid_amount_pkr") > c("approved_amount_pkr"),
            "discharge_ge_admission": c("length_of_stay") < 0,
            "no_negative_amounts": negative,
        },
        "dim_member": {
            "no_impossible_ages": (c("age_years") < 0) | (c("age_years") > MAX_AGE)
            | (c("date_of_birth") > F.lit(WINDOW_END).cast("date")),
        },
        "fct_monthly_member_summary": {
            "member_months_positive": (c("claim_count") <= 0) | (c("billed_amount_pkr") < 0) | (c("paid_amount_pkr") < 0),
        },
    }


def _row(name: str, model: str, kind: str, column: str, n: Column) -> Column:
    return F.struct(F.lit(name).alias("assertion"), F.lit(model).alias("model"), F.lit(kind).alias("kind"),
                    F.lit(column).alias("column_name"), n.alias("failures"))


def _long(one_row: DataFrame, rows: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _counted(df: DataFrame, name: str, model: str, kind: str, column: str) -> DataFrame:
    return _long(df.agg(F.count(F.lit(1)).alias("n")), [_row(name, model, kind, column, F.col("n"))])


def row_assertions(models: Models) -> list[DataFrame]:
    business = business_row_checks()
    out = []
    for model, ch in GENERIC.items():
        bad: list[tuple[str, str, str, Column]] = []
        bad += [(f"not_null_{model}_{c}", "not_null", c, F.col(c).isNull()) for c in ch.not_null]
        bad += [(f"accepted_values_{model}_{c}", "accepted_values", c, ~F.col(c).isin(*vals)) for c, vals in ch.accepted.items()]
        bad += [(n, "business", "", cond) for n, cond in business.get(model, {}).items()]
        if not bad:
            continue
        one = models[model].agg(*[F.count_if(cond).alias(f"n{i}") for i, (_, _, _, cond) in enumerate(bad)])
        out.append(_long(one, [_row(n, model, kind, col, F.col(f"n{i}")) for i, (n, kind, col, _) in enumerate(bad)]))
    return out


def _key_readings() -> dict[str, list[tuple[str, str, int]]]:
    """By model, the columns to read as (column, key space, role). A key space is the parent's key column, or a unique
    column's own; role 0 holds the keys themselves, role 1, 2 … rows that refer to them."""
    spaces: dict[tuple[str, str], int] = {}
    read: dict[str, list[tuple[str, str, int]]] = {}
    for model, ch in GENERIC.items():
        for c in ch.unique:
            spaces[model, c] = 0
    for model, ch in GENERIC.items():
        for c, parent in ch.references.items():
            spaces[parent] = spaces.get(parent, 0) + 1
            read.setdefault(model, []).append((c, ".".join(parent), spaces[parent]))
    for model, c in spaces:
        read.setdefault(model, []).append((c, f"{model}.{c}", 0))
    return read


def digest(*columns: Column) -> list[Column]:
    """128 bits of the values, as long as a surrogate key's digest, in two whole numbers; a missing value is one of its own."""
    told = [x for c in columns for x in (c, c.isNull())]
    return [F.xxhash64(*told).alias("h"), F.xxhash64(F.lit(1), *told).alias("i")]


#: Puts an intermediate result away and reads it again, by which Spark knows its size.
Keep = Callable[[DataFrame], DataFrame]


def key_assertions(models: Models, keep: Keep | None = None) -> list[DataFrame]:
    """Uniqueness and references of all models from one aggregation.

    Each row gives the digests of its keys, tagged with the key space and the role they have there, from one scan of its
    model. Folded by (space, digest), with counts added up before the shuffle, a key says at once how often it occurs as a
    key and how many rows of each child refer to it: over one is a repeated key, none with children is a lost reference.
    Lines without a header are those that refer to no claim, and those without a claim id.

    With ``keep``, keys that nothing refers to are folded before by 64 bits alone, and the hashes that occur more than once,
    which may be of two keys, are put away: only their rows then go through the aggregation.
    """
    read = _key_readings()
    spaces = {space: n for n, space in enumerate(dict.fromkeys(space for columns in read.values() for _, space, _ in columns))}
    roles = 1 + max(role for columns in read.values() for _, _, role in columns)

    def tagged(of: dict[str, list[tuple[str, str, int]]]) -> DataFrame:
        return union_all([
            models[model].select(F.explode(F.array(*(
                F.struct(F.lit(spaces[space]).alias("space"), F.col(c).isNotNull().alias("given"),
                         *digest(F.col(c).cast("string")), F.lit(role).alias("role"))
                for c, space, role in columns))).alias("x")).select("x.*")
            for model, columns in of.items() if columns]).filter("given")

    rows = tagged(read)
    if keep is not None:
        shared = {space for columns in read.values() for _, space, role in columns if role}
        alone, others = ({model: [x for x in columns if (x[1] in shared) == kept] for model, columns in read.items()}
                         for kept in (False, True))
        hashed = tagged(alone).withColumn("signature", F.xxhash64("space", "h"))
        repeated = keep(hashed.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("signature"))
        rows = tagged(others).unionByName(hashed.join(repeated, "signature", "left_semi").drop("signature"))
    per_key = rows.groupBy("space", "h", "i").agg(
        *(F.count_if(F.col("role") == r).alias(f"n{r}") for r in range(roles)))
    found = per_key.groupBy("space").agg(
        F.count_if(F.col("n0") > 1).alias("r0"),
        *(F.sum(F.when(F.col("n0") == 0, F.col(f"n{r}")).otherwise(0)).alias(f"r{r}") for r in range(1, roles)))
    checks = []
    for model, columns in read.items():
        for c, space, role in columns:
            kind = "relationships" if role else "unique"
            if role or c in GENERIC[model].unique:
                checks.append((f"{kind}_{model}_{c}", model, kind, c, spaces[space], role))
            if (model, c, role > 0) == ("fct_claim_line", "claim_id", True):
                checks.append(("lines_have_header", model, "business", "", spaces[space], role))
    spark = per_key.sparkSession
    named = spark.createDataFrame(checks, "assertion string, model string, kind string, column_name string, space int, role int")
    of_keys = F.element_at(F.array(*(F.col(f"r{r}") for r in range(roles))), F.col("role") + 1)
    nameless = models["fct_claim_line"].agg(F.count_if(F.col("claim_id").isNull()).alias("n")).scalar()
    failures = F.coalesce(of_keys, F.lit(0)) + F.when(F.col("assertion") == "lines_have_header", nameless).otherwise(0)
    return [named.join(found, "space", "left").select(
        "assertion", "model", "kind", "column_name", failures.cast("bigint").alias("failures"))]


def business_set_assertions(models: Models) -> list[DataFrame]:
    h = models["fct_claim_header"]
    event = [F.col(c) for c in ("member_sk", "provider_sk", "admission_date_key", "billed_amount_pkr")]
    same = h.select(*digest(*event)).groupBy("h", "i").count().filter("count > 1")
    fact_rows = h.agg(F.count(F.lit(1)).alias("fact_rows"))
    more = fact_rows.withColumn("staged", models["stg_claims_header"].agg(F.count(F.lit(1)).alias("n")).scalar())
    return [
        _counted(same, "no_duplicate_business_claims", "fct_claim_header", "business", ""),
        _long(more, [_row("fct_reconciles_staging", "fct_claim_header", "business", "",
                          (F.col("fact_rows") > F.col("staged")).cast("bigint"))]),
    ]


def evaluate(models: Models, keep: Keep | None = None) -> DataFrame:
    """(assertion, model, kind, column_name, failures): 89 rows; all failures are 0 in a good build. ``keep`` stores repeated
    hashes of keys, if they are to be."""
    return union_all([*row_assertions(models), *key_assertions(models, keep), *business_set_assertions(models)])
