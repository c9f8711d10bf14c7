"""Nine dimensions and three facts.

Joins carry no broadcast hint where the dimension can grow (members, providers, groups, policies,
code books): Spark broadcasts those by measured size, before the run from statistics and during
it from the shuffle, and otherwise sorts and merges with skew splitting. Only the calendar (1,461
days) and the two inline code lists, whose size is fixed, are hinted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medledger.functions import age_band, date_key, date_of_key, surrogate_key
from medledger.functions.scalars import OPEN_END
from medledger.operators.cleaning import clean_members, date_spine, is_sound_line, sound_claims
from medledger.sources.lake import MONTH

DIMENSIONS = ("dim_date", "dim_member", "dim_provider", "dim_employer_group", "dim_policy", "dim_diagnosis",
              "dim_procedure", "dim_claim_status", "dim_claim_type")
FACTS = ("fct_claim_header", "fct_claim_line", "fct_monthly_member_summary")
MARTS = DIMENSIONS + FACTS

# Status -> (is_final, is_paid_state), claim type -> care setting.
STATUS_FLAGS = {
    "Paid": (True, True),
    "Partially Paid": (True, True),
    "Denied": (True, False),
    "Pending": (False, False),
    "In Review": (False, False),
}
CARE_SETTING = {
    "Inpatient": "Facility",
    "Daycare": "Facility",
    "Maternity": "Facility",
    "Emergency": "Facility",
    "Outpatient": "Ambulatory",
    "Diagnostic": "Ambulatory",
    "Pharmacy": "Ambulatory",
}


# -- dimensions ----------------------------------------------------------------
def dim_date(spark: SparkSession) -> DataFrame:
    d = F.col("date_day")
    iso_day = F.weekday(d) + 1
    fiscal = F.add_months(d, 6)  # the fiscal year starts in July
    return date_spine(spark).select(
        date_key("date_day").alias("date_key"),
        "date_day",
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day.alias("iso_day_of_week"),
        (iso_day >= 6).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_month_end"),
        F.year(fiscal).alias("fiscal_year"),
        F.quarter(fiscal).alias("fiscal_quarter"),
    )


def dim_member(members: DataFrame) -> DataFrame:
    ended = F.col("termination_date")
    return clean_members(members).select(
        surrogate_key("member_id", "enrolment_date").alias("member_sk"),
        "member_id", "masked_cnic", "name", "gender", "date_of_birth", "age_years",
        age_band("age_years").alias("age_band"),
        "city", "employer_group_id", "policy_id", "relationship", "enrolment_date", "termination_date",
        F.col("enrolment_date").alias("valid_from"),
        F.coalesce(ended, F.lit(OPEN_END).cast("date")).alias("valid_to"),
        ended.isNull().alias("is_current"),
    )


def dim_provider(providers: DataFrame) -> DataFrame:
    return providers.select(
        surrogate_key("provider_id", "panel_since").alias("provider_sk"),
        "provider_id", "hospital_name", "city", "provider_type", "network_status", "tier", "panel_since",
        F.col("panel_since").alias("valid_from"),
        F.lit(OPEN_END).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_employer_group(groups: DataFrame) -> DataFrame:
    rest = [c for c in groups.columns if c not in ("group_id", "name")]
    return groups.select(surrogate_key("group_id").alias("employer_group_sk"), "group_id",
                         F.col("name").alias("employer_name"), *rest)


def keyed_book(book: DataFrame, key: str, sk: str) -> DataFrame:
    """A code book with its surrogate key in front: policies, diagnoses, procedures."""
    return book.select(surrogate_key(key).alias(sk), *book.columns)


def dim_claim_status(spark: SparkSession) -> DataFrame:
    rows = [(s, final, paid) for s, (final, paid) in STATUS_FLAGS.items()]
    df = spark.createDataFrame(rows, "status string, is_final boolean, is_paid_state boolean")
    return df.select(surrogate_key("status").alias("claim_status_sk"), "*")


def dim_claim_type(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(list(CARE_SETTING.items()), "claim_type string, care_setting string")
    return df.select(surrogate_key("claim_type").alias("claim_type_sk"), "*")


#: Each dimension from the session and the staged tables by name, of which only its own is read.
DIMENSION_OF: dict[str, Callable[[SparkSession, Mapping[str, DataFrame]], DataFrame]] = {
    "dim_date": lambda spark, staged: dim_date(spark),
    "dim_member": lambda spark, staged: dim_member(staged["members"]),
    "dim_provider": lambda spark, staged: dim_provider(staged["providers"]),
    "dim_employer_group": lambda spark, staged: dim_employer_group(staged["employer_groups"]),
    "dim_policy": lambda spark, staged: keyed_book(staged["policies"], "policy_id", "policy_sk"),
    "dim_diagnosis": lambda spark, staged: keyed_book(staged["diagnoses"], "diagnosis_code", "diagnosis_sk"),
    "dim_procedure": lambda spark, staged: keyed_book(staged["procedures"], "procedure_code", "procedure_sk"),
    "dim_claim_status": lambda spark, staged: dim_claim_status(spark),
    "dim_claim_type": lambda spark, staged: dim_claim_type(spark),
}


def dimensions(spark: SparkSession, staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: make(spark, staged) for name, make in DIMENSION_OF.items()}


# -- facts ---------------------------------------------------------------------
def accepted_claims(headers: DataFrame, dims: Mapping[str, DataFrame], repeated: DataFrame | None = None) -> DataFrame:
    """One row per accepted claim, without what follows from its own columns (``header_fact``). ``repeated`` are the
    ``repeated_signatures``, if they are stored.

    "Known member" and "look up the member" are one inner join here (same rows as a semi-join
    followed by a left join, one shuffle of the fact less); likewise for providers. Terminated
    members keep their claims: the join is on the natural key, without a current-row filter.
    Members, the largest dimension, come first, while rows carry no surrogate key.
    """
    mbr = dims["dim_member"].select("member_id", "member_sk", "employer_group_id")
    prv = dims["dim_provider"].select("provider_id", "provider_sk")
    grp = dims["dim_employer_group"].select(F.col("group_id").alias("employer_group_id"), "employer_group_sk")
    pol = dims["dim_policy"].select("policy_id", "policy_sk")
    c = (
        sound_claims(headers, repeated)
        .join(mbr, "member_id")
        .join(prv, "provider_id")
        .join(grp, "employer_group_id", "left")
        .join(pol, "policy_id", "left")
    )
    return c.select(
        "claim_id", "member_sk", "provider_sk", "employer_group_sk", "policy_sk",
        "claim_type", "status", "adjudication_mode", "denial_reason_code",
        *[date_key(f"{step}_date").alias(f"{step}_date_key")
          for step in ("admission", "discharge", "submission", "adjudication", "payment")],
        "billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr", "member_share_pkr", "length_of_stay",
        F.col("days_submit_to_adjudicate").alias("tat_submit_to_adjudicate"),
        F.col("days_adjudicate_to_pay").alias("tat_adjudicate_to_pay"),
    )


def _with_others(rows: DataFrame, columns: list[Column], used: set[str]) -> DataFrame:
    """``columns``, then those of ``rows`` that are none of ``used``: the month a lake adds."""
    return rows.select(*columns, *[c for c in rows.columns if c not in used])


def header_fact(claims: DataFrame) -> DataFrame:
    """Accepted claims with the rest of the fact's columns, each a function of its row."""
    kept = [F.col(c) for c in claims.columns if c != MONTH]
    at = claims.columns.index("length_of_stay")
    to_adjudicate, to_pay = F.col("tat_submit_to_adjudicate"), F.col("tat_adjudicate_to_pay")
    savings = (F.col("billed_amount_pkr") - F.col("approved_amount_pkr")).cast("decimal(18,2)").alias("savings_pkr")
    return _with_others(claims, [
        surrogate_key("claim_id").alias("claim_sk"), *kept[:at], savings, *kept[at:],
        (to_adjudicate + F.coalesce(to_pay, F.lit(0))).alias("tat_total"), F.lit(1).alias("claim_count"),
    ], {*claims.columns} - {MONTH})


def fct_claim_header(headers: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per accepted claim."""
    return header_fact(accepted_claims(headers, dims))


def odd_procedures(lines: DataFrame, procedures: DataFrame) -> DataFrame:
    """(procedure_code, procedure_known) of the codes in use that the book lacks, and of those that it has more than once,
    a row each time. Codes are found narrow, so lines need not be shuffled to look up codes that are in the book once."""
    book = procedures.select("procedure_code")
    used = lines.filter(is_sound_line() & F.col("procedure_code").isNotNull()).select("procedure_code").distinct()
    lacking = used.join(book, "procedure_code", "left_anti").withColumn("procedure_known", F.lit(False))
    repeated = book.groupBy("procedure_code").agg(F.count(F.lit(1)).cast("int").alias("n")).filter("n > 1")
    times = F.explode(F.sequence(F.lit(1), F.col("n")))
    return lacking.union(repeated.withColumn("_i", times).select("procedure_code", F.lit(True)))


def accepted_lines(lines: DataFrame, header_fact: DataFrame, dims: Mapping[str, DataFrame], odd: DataFrame) -> DataFrame:
    """One row per sound line of an accepted claim, without what follows from its own columns (``line_fact``); keys of
    member and provider come with the header. ``odd`` are the ``odd_procedures``; a code that is none of them is in the
    book once. Headers come first: what the code books add then is in no shuffle of the lines."""
    hdr = header_fact.select("claim_id", "member_sk", "provider_sk", "submission_date_key", "claim_type", "status")
    dia = dims["dim_diagnosis"].select("diagnosis_code", "diagnosis_sk")
    j = (
        lines.filter(is_sound_line())
        .join(hdr, "claim_id")
        .join(odd, "procedure_code", "left")
        .join(dia, "diagnosis_code", "left")
    )
    known = F.col("procedure_code").isNotNull() & F.coalesce("procedure_known", F.lit(True))
    return j.select(
        "claim_line_id", "claim_id", "line_no", "member_sk", "provider_sk", "diagnosis_sk", known.alias("procedure_known"),
        "submission_date_key", "claim_type", "status", "procedure_code", "diagnosis_code", "quantity",
        "unit_price_pkr", "line_billed_pkr", "line_approved_pkr",
    )


def line_fact(lines: DataFrame) -> DataFrame:
    """Accepted lines with the rest of the fact's columns, each a function of its row."""
    procedure_sk = F.when(F.col("procedure_known"), surrogate_key("procedure_code")).alias("procedure_sk")
    return _with_others(lines, [
        surrogate_key("claim_line_id").alias("claim_line_sk"),
        *[F.col(c) for c in ("claim_line_id", "claim_id", "line_no", "member_sk", "provider_sk", "diagnosis_sk")], procedure_sk,
        *[F.col(c) for c in ("submission_date_key", "claim_type", "status", "procedure_code", "diagnosis_code", "quantity",
                             "unit_price_pkr", "line_billed_pkr", "line_approved_pkr")],
        (F.col("line_billed_pkr") - F.col("line_approved_pkr")).cast("decimal(18,2)").alias("line_savings_pkr"),
    ], {*lines.columns} - {MONTH})


def fct_claim_line(lines: DataFrame, header_fact: DataFrame, dims: Mapping[str, DataFrame], odd: DataFrame | None = None) -> DataFrame:
    """One row per sound line of an accepted claim. ``odd`` are the ``odd_procedures``, if they are stored."""
    odd = odd_procedures(lines, dims["dim_procedure"]) if odd is None else odd
    return line_fact(accepted_lines(lines, header_fact, dims, odd))


def parts_of_claims(df: DataFrame, n: int) -> list[DataFrame]:
    """The rows dealt out to ``n`` parts by claim, with all rows of a claim in one of them."""
    return [df] if n == 1 else [df.filter(F.pmod(F.xxhash64("claim_id"), F.lit(n)) == k) for k in range(n)]


def fct_monthly_member_summary(header_fact: DataFrame, member_dim: DataFrame) -> DataFrame:
    """Member x month. Claims are added up before the member join, so a busy member is at most one
    row per month when it is shuffled."""
    month = F.trunc(date_of_key("submission_date_key"), "month")
    amounts = ["billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr", "member_share_pkr"]
    per_month = (
        header_fact.filter(F.col("submission_date_key").isNotNull())
        .groupBy("member_sk", month.alias("month_start"))
        .agg(F.count(F.lit(1)).alias("claim_count"), *[F.sum(a).alias(a) for a in amounts])
    )
    mbr = member_dim.select("member_sk", "member_id", "employer_group_id", "policy_id")
    return per_month.join(mbr, "member_sk").select(
        surrogate_key("member_id", "month_start").alias("member_month_sk"),
        "member_sk", "member_id", "employer_group_id", "policy_id", "month_start",
        date_key("month_start").alias("month_key"),
        "claim_count", *amounts,
    )
