"""Aggregations behind the dashboard pages and the exported report."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medledger.functions import mean_of, ratio
from medledger.plans.enriched import Star, enriched, look_up, submitted_between
from medledger.plans.financial import rows, v_financial_monthly, v_mlr_by_group
from medledger.plans.network import provider_fold, provider_spend, v_network_cost_diff, v_provider_scorecard
from medledger.plans.operations import quantile
from medledger.plans.risk import v_provider_anomaly
from medledger.sources.landing import union_all
from medledger.sources.schemas import FUNNEL_ORDER


@dataclass(frozen=True)
class Filters:
    """Selections of a page; an empty one does not filter."""

    date_from: str | None = None
    date_to: str | None = None
    employers: tuple[str, ...] = ()
    claim_types: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    networks: tuple[str, ...] = ()

    def condition(self) -> Column:
        """The value selections; the date range is cut on the fact's own keys."""
        out = F.lit(True)
        for column, values in (("employer_name", self.employers), ("claim_type", self.claim_types),
                               ("member_city", self.cities), ("network_status", self.networks)):
            if values:
                out = out & F.col(column).isin(*values)
        return out

    def reads(self) -> list[str]:
        out = []
        for column, values in (("employer_name", self.employers), ("claim_type", self.claim_types),
                               ("member_city", self.cities), ("network_status", self.networks)):
            if values:
                out.append(column)
        return out


def filtered(star: Star, filters: Filters | None, columns: list[str]) -> DataFrame:
    """The enriched claims a page works on, with its filter below the aggregation."""
    f = filters or Filters()
    star = ChainMap({"fct_claim_header": submitted_between(star["fct_claim_header"], f.date_from, f.date_to)}, star)
    extra = [c for c in f.reads() if c not in columns]
    return enriched(star, [*columns, *extra]).filter(f.condition()).select(*columns)


def claims_between(star: Star, date_from: str, date_to: str, columns: list[str] | None = None) -> DataFrame:
    """Parameterised date-range read with plain numeric amounts."""
    cut = ChainMap({"fct_claim_header": submitted_between(star["fct_claim_header"], date_from, date_to)}, star)
    c = enriched(cut, columns)
    return c.withColumns({a: F.col(a).cast("double") for a in (
        "billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr") if a in c.columns})


def filter_domains(star: Star) -> DataFrame:
    """What the page filters offer: bounds of the claim date and the sorted values of four columns.

    One pass over five columns of the claims: each row gives its five keys, folded to distinct ones before they are
    shuffled, and these meet the dimensions in one join. The claims themselves are never joined.
    """
    claims = star["fct_claim_header"]
    keys = ["submission_date_key", "employer_group_sk", "claim_type", "member_sk", "provider_sk"]
    each = F.array(*(F.struct(F.lit(k).alias("of"), F.col(k).cast("string").alias("key")) for k in keys))
    used = claims.select(F.explode(each).alias("x")).select("x.*").distinct()

    def offer(key: str, dim: str, dim_key: str, name: str, column: str) -> DataFrame:
        return star[dim].select(F.lit(key).alias("of"), F.col(dim_key).cast("string").alias("key"), F.lit(name).alias("filter"),
                                F.col(column).cast("string").alias("value"))

    offers = union_all([
        offer("submission_date_key", "dim_date", "date_key", "claim_date", "date_day"),
        offer("employer_group_sk", "dim_employer_group", "employer_group_sk", "employer_name", "employer_name"),
        offer("claim_type", "dim_claim_type", "claim_type", "claim_type", "claim_type"),
        offer("member_sk", "dim_member", "member_sk", "member_city", "city"),
        offer("provider_sk", "dim_provider", "provider_sk", "network_status", "network_status"),
    ])
    is_date = F.col("filter") == "claim_date"
    found = used.join(offers, ["of", "key"]).filter("value IS NOT NULL").groupBy(
        "filter", F.when(~is_date, F.col("value")).alias("value")).agg(F.min("value").alias("least"), F.max("value").alias("most"))
    row = lambda name, value: F.struct(name.alias("filter"), value.alias("value"))
    bounds = F.array(row(F.lit("claim_date_min"), F.col("least")), row(F.lit("claim_date_max"), F.col("most")))
    shown = F.when(is_date, bounds).otherwise(F.array(row(F.col("filter"), F.col("value"))))
    return found.select(F.explode(shown).alias("x")).select("x.*").orderBy("filter", "value")


def executive_monthly(star: Star, filters: Filters | None = None) -> DataFrame:
    c = filtered(star, filters, ["year_month", "billed_amount_pkr", "paid_amount_pkr", "claim_id", "is_denied"])
    return c.filter(F.col("year_month").isNotNull()).groupBy("year_month").agg(
        F.sum("billed_amount_pkr").alias("billed"), F.sum("paid_amount_pkr").alias("paid"),
        F.count("claim_id").alias("claims"), F.sum("is_denied").alias("denied")).orderBy("year_month")


def last_change(monthly: DataFrame, columns: list[str]) -> DataFrame:
    """Per cent change of the last month over the one before it; NULL over zero or without one.

    Only the two latest months are kept, so the ordering window sees two rows.
    """
    two = monthly.orderBy(F.desc("year_month")).limit(2)
    w = Window.orderBy("year_month")
    changes = two.select("year_month", *[
        (ratio(F.col(c) - F.lag(c).over(w), F.lag(c).over(w), positive=False) * 100).alias(f"{c}_delta") for c in columns])
    return changes.orderBy(F.desc("year_month")).limit(1).drop("year_month")


def executive_headline(star: Star, filters: Filters | None = None) -> DataFrame:
    c = filtered(star, filters, ["billed_amount_pkr", "paid_amount_pkr", "savings_pkr", "is_denied"])
    head = c.agg(
        rows().alias("claims"), F.sum("billed_amount_pkr").alias("billed"), F.sum("paid_amount_pkr").alias("paid"),
        (mean_of("is_denied") * 100).alias("denial_rate_pct"),
        (F.coalesce(ratio(F.sum("savings_pkr"), F.sum("billed_amount_pkr"), positive=False), F.lit(0.0)) * 100)
        .alias("savings_rate_pct"))
    names = ["claims", "billed", "paid"]
    change = last_change(executive_monthly(star, filters), names)
    packed = change.select(F.struct(*change.columns).alias("d")).scalar()
    return head.withColumn("_d", packed).select(*head.columns, *[F.col(f"_d.{n}_delta").alias(f"{n}_delta_pct") for n in names])


def value_counts(star: Star, column: str, filters: Filters | None = None) -> DataFrame:
    return filtered(star, filters, [column]).filter(F.col(column).isNotNull()).groupBy(column).agg(
        rows().alias("count")).orderBy(F.desc("count"), column)


def spend_by_city(star: Star, filters: Filters | None = None) -> DataFrame:
    """Paid per member first, city second: a busy member is one row when it meets the member table."""
    per_member = filtered(star, filters, ["member_sk", "paid_amount_pkr"]).groupBy("member_sk").agg(
        F.sum("paid_amount_pkr").alias("paid"))
    c = look_up(per_member, star, ["member_city"])
    return c.filter(F.col("member_city").isNotNull()).groupBy("member_city").agg(
        F.sum("paid").alias("paid_amount_pkr")).orderBy("paid_amount_pkr", "member_city")


def operations_headline(star: Star, filters: Filters | None = None) -> DataFrame:
    c = filtered(star, filters, ["is_auto", "tat_submit_to_adjudicate"])
    tat = "tat_submit_to_adjudicate"
    return c.agg((mean_of("is_auto") * 100).alias("auto_rate_pct"), mean_of(tat).alias("tat_mean"),
                 F.median(tat).alias("tat_median"), quantile(tat, 0.9).alias("tat_p90"))


def turnaround_histogram(star: Star, bins: int = 40, filters: Filters | None = None) -> DataFrame:
    """Equal-width bins between the least and greatest turnaround, counted per adjudication mode."""
    tat = F.col("tat_submit_to_adjudicate")
    c = filtered(star, filters, ["adjudication_mode", "tat_submit_to_adjudicate"]).filter(tat.isNotNull())
    # Day counts first (few distinct values), bins second: the claims are read once per mode and day.
    days = c.groupBy("adjudication_mode", "tat_submit_to_adjudicate").agg(rows().alias("n"))
    bounds = days.agg(F.struct(F.min(tat).cast("double").alias("lo"), F.max(tat).cast("double").alias("hi")).alias("b"))
    h = days.withColumn("_b", bounds.scalar())
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    # The greatest value would fall one past the last bin; a single value has no width to divide.
    b = F.when(lo == hi, 1).otherwise(F.least(F.width_bucket(tat.cast("double"), lo, hi, F.lit(bins)), F.lit(bins)))
    width = (hi - lo) / bins
    return h.groupBy("adjudication_mode", b.cast("int").alias("bin"), lo.alias("_lo"), width.alias("_w")).agg(
        F.sum("n").alias("claim_count")).select(
        "adjudication_mode", "bin", (F.col("_lo") + (F.col("bin") - 1) * F.col("_w")).alias("bin_start"),
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_end"), "claim_count")


def adjudication_funnel(star: Star, filters: Filters | None = None) -> DataFrame:
    """All five statuses in their fixed order, zero where no claim has one."""
    spark = star["fct_claim_header"].sparkSession
    stages = spark.createDataFrame(list(enumerate(FUNNEL_ORDER, start=1)), "stage int, status string")
    counts = filtered(star, filters, ["status"]).groupBy("status").agg(rows().alias("n"))
    return stages.join(counts, "status", "left").select(
        "stage", "status", F.coalesce("n", F.lit(0)).alias("claim_count")).orderBy("stage")


def top_loss_ratios(star: Star, n: int = 15) -> DataFrame:
    return v_mlr_by_group(star).limit(n).select("employer_group_id", "employer_name", "medical_loss_ratio")


def top_share_of_spend(star: Star, n: int = 10) -> DataFrame:
    """The n providers that lead ``v_provider_concentration``, by its order but without ranking the others."""
    order = (F.desc_nulls_last("paid_pkr"), F.md5("provider_id"), F.col("provider_id"))
    total = star["fct_claim_header"].agg(F.sum("paid_amount_pkr").alias("t")).scalar()
    top = provider_spend(star).orderBy(*order).limit(n).withColumn("_total", total)
    return top.agg((F.sum(ratio("paid_pkr", "_total", positive=False)) * 100).alias("top_share_pct"))


def top_network_multiples(star: Star, n: int = 15) -> DataFrame:
    d = v_network_cost_diff(star).filter(F.col("oon_cost_multiple").isNotNull()).limit(n)
    return d.select("procedure_code", "description", "oon_cost_multiple")


def flagged_providers(star: Star) -> DataFrame:
    return v_provider_anomaly(star).filter("is_anomalous").select(
        "provider_id", "hospital_name", "provider_type", "avg_claim_value", "z_score")


def scorecard_page(star: Star, n: int = 50) -> DataFrame:
    return v_provider_scorecard(star).limit(n)


def kpi_summary(star: Star) -> DataFrame:
    t = star["fct_claim_header"].agg(
        rows().alias("total_claims"), F.sum("billed_amount_pkr").alias("total_billed"),
        F.sum("approved_amount_pkr").alias("total_approved"), F.sum("paid_amount_pkr").alias("total_paid"))
    return t.withColumns({
        "approval_rate": ratio("total_approved", "total_billed", positive=False),
        "savings_rate": ratio(F.col("total_billed") - F.col("total_approved"), "total_billed", positive=False),
    })


def kpi_monthly_trend(star: Star) -> DataFrame:
    return v_financial_monthly(star).select("year_month", "billed_pkr", "approved_pkr", "paid_pkr", "approval_rate")


# The columns of the exported claims detail.
DETAIL_COLUMNS = [
    "claim_id", "claim_date", "employer_name", "provider_id", "hospital_name", "member_city", "network_status",
    "claim_type", "status", "adjudication_mode", "billed_amount_pkr", "approved_amount_pkr", "paid_amount_pkr",
    "savings_pkr",
]


def claims_detail(star: Star) -> DataFrame:
    return enriched(star, DETAIL_COLUMNS)


def provider_report(star: Star, n: int = 60) -> DataFrame:
    """Count, paid, mean and billed of the ``n`` providers with the highest billed total."""
    p = provider_fold(
        star, ["provider_id", "hospital_name"], claim_count=rows(), total_paid=F.sum("paid_amount_pkr"),
        total_billed=F.sum("billed_amount_pkr"), billed_n=F.count("billed_amount_pkr"))
    mean = F.coalesce(ratio("total_billed", "billed_n"), F.lit(0.0)).alias("avg_claim_value")
    return p.select("provider_id", "hospital_name", "claim_count", "total_paid", mean, "total_billed").orderBy(
        F.desc_nulls_last("total_billed"), "provider_id").limit(n)


def drill_through(star: Star, column: str, keys: str | DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All claims of one provider or member, or of a frame of them. The keys are found in the
    dimension first, and the fact is cut by surrogate key through a semi-join."""
    dim, sk = {"provider_id": ("dim_provider", "provider_sk"), "member_id": ("dim_member", "member_sk")}[column]
    found = star[dim].filter(F.col(column) == keys) if isinstance(keys, str) else star[dim].join(keys, column, "left_semi")
    cut = ChainMap({"fct_claim_header": star["fct_claim_header"].join(found.select(sk), sk, "left_semi")}, star)
    return enriched(cut, columns)


def denied_only() -> Column:
    return F.col("status") == "Denied"


def out_of_network_only() -> Column:
    return F.col("network_status") == "Out-of-Network"


SAVED_FILTERS: dict[str, Callable[[], Column]] = {"denied only": denied_only, "out-of-network only": out_of_network_only}


def saved_filter_totals(star: Star) -> DataFrame:
    """Count and billed under each saved filter, from one pass over the claims."""
    e = enriched(star, ["status", "network_status", "billed_amount_pkr"])
    one = e.agg(*[
        F.struct(F.count_if(cond()).alias("claim_count"), F.sum(F.when(cond(), F.col("billed_amount_pkr"))).alias("billed_pkr"))
        .alias(name) for name, cond in SAVED_FILTERS.items()])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("saved_filter"), F.col(f"`{n}`.claim_count").alias("claim_count"),
                 F.col(f"`{n}`.billed_pkr").alias("billed_pkr")) for n in SAVED_FILTERS])).alias("r")).select("r.*")
