"""Business-intelligence measures over the star, evaluated in a filter context.

``evaluate(star, names, by, where)`` groups by any enriched columns. Each base table (claims,
lines, member-months, groups, members) is aggregated once, by those of the ``by`` columns it can
be sliced by; as in a BI model, a column that does not filter a table leaves its total unsliced.
Ratios are derived from the aggregates and are NULL over zero.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medledger.functions import mean_of, ratio
from medledger.operators.joins import null_safe_join
from medledger.plans.enriched import (
    ENRICHED_COLUMNS,
    FROM_DATE,
    FROM_GROUP,
    FROM_MEMBER,
    FROM_PROVIDER,
    Star,
    enriched,
    look_up,
)
from medledger.plans.financial import rows
from medledger.plans.operations import quantile
from medledger.sources.schemas import OPEN_STATUSES, STAY_TYPES, WINDOW_MONTHS

def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


@dataclass(frozen=True)
class Aggregate:
    """One aggregate of one base table, and the columns it reads."""

    base: str
    build: Callable[[], Column]
    reads: tuple[str, ...] = ()


def _sum(base: str, column: str) -> Aggregate:
    return Aggregate(base, lambda: F.sum(column), (column,))


def _mean(column: str) -> Aggregate:
    return Aggregate("claims", lambda: mean_of(column), (column,))


def is_open() -> Column:
    return F.col("status").isin(*OPEN_STATUSES)


TAT = "tat_submit_to_adjudicate"

AGGREGATES: dict[str, Aggregate] = {
    "Total Billed": _sum("claims", "billed_amount_pkr"),
    "Total Approved": _sum("claims", "approved_amount_pkr"),
    "Total Paid": _sum("claims", "paid_amount_pkr"),
    "Total Member Share": _sum("claims", "member_share_pkr"),
    "Total Savings": _sum("claims", "savings_pkr"),
    "Claim Count": Aggregate("claims", rows),
    "Denied Claims": Aggregate("claims", lambda: count_where(F.col("status") == "Denied"), ("status",)),
    "Auto Adjudicated": Aggregate(
        "claims", lambda: count_where(F.col("adjudication_mode") == "Auto"), ("adjudication_mode",)),
    "Avg TAT Submit to Adjudicate": _mean(TAT),
    "Median TAT": Aggregate("claims", lambda: quantile(TAT, 0.5), (TAT,)),
    "P90 TAT": Aggregate("claims", lambda: quantile(TAT, 0.9), (TAT,)),
    "Avg TAT Adjudicate to Pay": _mean("tat_adjudicate_to_pay"),
    "Open Claims": Aggregate("claims", lambda: count_where(is_open()), ("status",)),
    "Backlog Billed": Aggregate(
        "claims", lambda: F.sum(F.when(is_open(), F.col("billed_amount_pkr"))), ("status", "billed_amount_pkr")),
    "Distinct Members": Aggregate("claims", lambda: F.count_distinct("member_sk"), ("member_sk",)),
    "Avg Length of Stay": Aggregate(
        "claims", lambda: mean_of(F.when(F.col("claim_type").isin(*STAY_TYPES), F.col("length_of_stay"))),
        ("claim_type", "length_of_stay")),
    "OON Paid": Aggregate(
        "claims", lambda: F.sum(F.when(F.col("network_status") == "Out-of-Network", F.col("paid_amount_pkr"))),
        ("network_status", "paid_amount_pkr")),
    "Line Count": Aggregate("lines", rows),
    "Line Billed": _sum("lines", "line_billed_pkr"),
    "Member Months": Aggregate("member_months", rows),
    "Earned Premium": Aggregate(
        "groups", lambda: F.sum(F.col("monthly_premium_pkr") * WINDOW_MONTHS), ("monthly_premium_pkr",)),
    "Covered Members": Aggregate("members", lambda: F.count_distinct("member_sk"), ("member_sk",)),
}

# measure -> (numerator, denominator, factor)
RATIOS: dict[str, tuple[str, str, int]] = {
    "Approval Rate": ("Total Approved", "Total Billed", 1),
    "Savings Rate": ("Total Savings", "Total Billed", 1),
    "Member Cost Share": ("Total Member Share", "Total Billed", 1),
    "Avg Claim Value": ("Total Billed", "Claim Count", 1),
    "Loss Ratio": ("Total Paid", "Earned Premium", 1),
    "Medical Loss Ratio": ("Total Paid", "Earned Premium", 1),
    "PMPM Paid": ("Total Paid", "Member Months", 1),
    "PMPM Billed": ("Total Billed", "Member Months", 1),
    "Denial Rate": ("Denied Claims", "Claim Count", 1),
    "Auto Adjudication Rate": ("Auto Adjudicated", "Claim Count", 1),
    "Utilisation per 1000": ("Claim Count", "Covered Members", 1000),
    "OON Share": ("OON Paid", "Total Paid", 1),
}

# Columns each base table can be sliced by.
SLICED_BY: dict[str, tuple[str, ...]] = {
    "claims": tuple(ENRICHED_COLUMNS),
    "lines": (*FROM_DATE, *FROM_MEMBER, *FROM_PROVIDER, "claim_type", "status"),
    "member_months": (*FROM_DATE, *FROM_MEMBER),
    "groups": tuple(FROM_GROUP),
    "members": tuple(FROM_MEMBER),
}


def _base(star: Star, base: str, columns: list[str]) -> DataFrame:
    if base == "claims":
        return enriched(star, columns) if columns else star["fct_claim_header"].select(F.lit(1).alias("_one"))
    if base == "lines":
        return look_up(star["fct_claim_line"], star, columns)
    if base == "member_months":
        return look_up(star["fct_monthly_member_summary"], star, columns, on_date="month_key")
    if base == "groups":
        return star["dim_employer_group"].withColumnRenamed("group_id", "employer_group_id")
    return star["dim_member"].withColumnRenamed("city", "member_city")


def _is_plain(name: str) -> bool:
    return name in AGGREGATES


def needed_aggregates(names: list[str]) -> list[str]:
    out: list[str] = []
    for n in names:
        parts = [n] if _is_plain(n) else list(RATIOS[n][:2])
        out += [p for p in parts if p not in out]
    return out


def evaluate(star: Star, names: list[str], by: list[str] | None = None, where: Column | None = None,
             where_reads: tuple[str, ...] = ()) -> DataFrame:
    """One row per combination of ``by`` seen in any base table, one column per measure: an industry without
    claims keeps its premium.

    ``where`` filters the claims and, where the columns it reads (``where_reads``) allow, the other
    base tables.
    """
    by = by or []
    wanted = needed_aggregates(names)
    by_base: dict[str, list[str]] = {}
    for n in wanted:
        by_base.setdefault(AGGREGATES[n].base, []).append(n)
    by_base.setdefault("claims", [])

    def fold(base: str) -> tuple[DataFrame, list[str]]:
        keys = [c for c in by if c in SLICED_BY[base]]
        reads = list(dict.fromkeys([*keys, *where_reads, *(r for n in by_base[base] for r in AGGREGATES[n].reads)]))
        if base != "claims":
            reads = [c for c in reads if c in SLICED_BY[base] or c in keys]
        if base == "claims" and "member_sk" in reads:
            reads.remove("member_sk")
            facts = look_up(star["fct_claim_header"], star, [c for c in reads if c in ENRICHED_COLUMNS])
        else:
            facts = _base(star, base, reads)
        if where is not None and all(c in SLICED_BY[base] for c in where_reads):
            facts = facts.filter(where)
        aggs = [AGGREGATES[n].build().alias(n) for n in by_base[base]] or [rows().alias("_rows")]
        return facts.groupBy(*keys).agg(*aggs), keys

    out, _ = fold("claims")
    for base in (b for b in by_base if b != "claims"):
        side, keys = fold(base)
        if keys:
            out = null_safe_join(out, side, keys, "full")
        else:  # one row: attach each total as a scalar subquery
            for n in by_base[base]:
                out = out.withColumn(n, side.select(n).scalar())
    for n in names:
        if not _is_plain(n):
            num, den, factor = RATIOS[n]
            out = out.withColumn(n, ratio(F.col(f"`{num}`") * factor, F.col(f"`{den}`"), positive=False))
    return out.select(*by, *[F.col(f"`{n}`") for n in names])


# -- measures that are not a plain aggregate -------------------------------------
def top_provider_spend(star: Star, n: int = 10) -> DataFrame:
    """Paid by the ``n`` highest-spend providers (ties at the edge included) and its share."""
    spend = star["fct_claim_header"].groupBy("provider_sk").agg(F.sum("paid_amount_pkr").alias("paid"))
    edge = spend.orderBy(F.desc_nulls_last("paid")).limit(n).agg(F.min("paid").alias("edge"))
    # Compared by value in a filter over provider totals: no ranking of all providers.
    top = spend.filter(F.col("paid") >= edge.scalar()).agg(F.sum("paid").alias("Top10 Provider Spend"))
    total = spend.agg(F.sum("paid").alias("t"))
    t = top.withColumn("Total Paid", total.scalar())
    return t.select("Top10 Provider Spend",
                    ratio(F.col("`Top10 Provider Spend`"), F.col("`Total Paid`"), positive=False)
                    .alias("Provider Concentration"))


def ibnr_estimate(star: Star, by: list[str] | None = None) -> DataFrame:
    by = by or []
    m = evaluate(star, ["Backlog Billed", "Total Paid", "Total Approved"], by)
    conv = ratio(F.col("`Total Paid`"), F.col("`Total Approved`"), positive=False)
    return m.withColumn("IBNR Estimate", F.col("`Backlog Billed`").cast("double") * conv).select(
        *by, "IBNR Estimate")


def month_calendar(star: Star) -> DataFrame:
    """The 48 calendar months, so that frames over rows are frames over months."""
    return star["dim_date"].groupBy("year_month").agg(
        F.first("calendar_year").alias("calendar_year"), F.first("fiscal_year").alias("fiscal_year"))


def time_intelligence(star: Star, where: Column | None = None, where_reads: tuple[str, ...] = ()) -> DataFrame:
    """Year to date, fiscal year to date, prior year and rolling quarter, per month with claims.

    Windows run over at most 48 month rows, the fixed calendar.
    """
    m = evaluate(star, ["Total Paid", "Total Billed", "Claim Count", "Denied Claims", "Member Months"],
                 ["year_month"], where, where_reads)
    m = m.select("year_month", *[F.col(f"`{c}`").alias(a) for c, a in [
        ("Total Paid", "paid"), ("Total Billed", "billed"), ("Claim Count", "n"), ("Denied Claims", "denied"),
        ("Member Months", "mm")]])
    dense = month_calendar(star).join(m, "year_month", "left")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    year = Window.partitionBy("calendar_year").orderBy("year_month").rowsBetween(*so_far)
    fiscal = Window.partitionBy("fiscal_year").orderBy("year_month").rowsBetween(*so_far)
    line = Window.orderBy("year_month")
    quarter = line.rowsBetween(-2, Window.currentRow)

    def last_year(c: str) -> Column:
        return F.lag(c, 12).over(line)

    w = dense.select(
        "year_month", "n",
        F.sum("paid").over(year).alias("Paid YTD"),
        F.sum("billed").over(year).alias("Billed YTD"),
        F.sum("paid").over(fiscal).alias("Paid Fiscal YTD"),
        last_year("paid").alias("Paid PY"),
        last_year("n").alias("Claim Count PY"),
        ratio(last_year("denied"), last_year("n"), positive=False).alias("Denial Rate PY"),
        F.sum("paid").over(quarter).alias("Paid Rolling 3M"),
        ratio(F.sum("paid").over(quarter), F.sum("mm").over(quarter), positive=False).alias("PMPM Rolling 3M"),
        F.col("paid"),
    )
    py = F.col("`Paid PY`")
    w = w.withColumn("Paid YoY %", ratio(F.col("paid") - py, py, positive=False))
    return w.filter(F.col("n").isNotNull()).drop("n", "paid")
