"""The reporting views by name, over the stored star: of this session's build, or of a published version."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medledger.plans import clinical, financial, network, operations, risk
from medledger.plans.enriched import Star, v_claims_enriched
from medledger.sources import versions
from medledger.sources.lake import MONTH, Lake
from medledger.sources.landing import count_rows, union_all

STAR_VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "v_claims_enriched": v_claims_enriched,
    "v_financial_monthly": financial.v_financial_monthly,
    "v_mlr_by_group": financial.v_mlr_by_group,
    "v_pmpm": financial.v_pmpm,
    "v_operations_monthly": operations.v_operations_monthly,
    "v_denial_reasons": operations.v_denial_reasons,
    "v_claims_ageing": operations.v_claims_ageing,
    "v_top_diagnoses": clinical.v_top_diagnoses,
    "v_top_procedures": clinical.v_top_procedures,
    "v_utilisation": clinical.v_utilisation,
    "v_readmissions": clinical.v_readmissions,
    "v_network_cost_diff": network.v_network_cost_diff,
    "v_provider_scorecard": network.v_provider_scorecard,
    "v_provider_concentration": network.v_provider_concentration,
    "v_provider_anomaly": risk.v_provider_anomaly,
    "v_high_frequency_members": risk.v_high_frequency_members,
}
RAW_VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {"v_duplicate_candidates": risk.v_duplicate_candidates}

MUST_HAVE_ROWS = ("v_claims_enriched", "v_financial_monthly", "v_provider_scorecard")


def view(name: str, star: Star, raw_headers: DataFrame) -> DataFrame:
    return RAW_VIEWS[name](raw_headers) if name in RAW_VIEWS else STAR_VIEWS[name](star)


def all_views(star: Star, raw_headers: DataFrame) -> dict[str, DataFrame]:
    return {n: view(n, star, raw_headers) for n in [*STAR_VIEWS, *RAW_VIEWS]}


def register_views(star: Star, raw_headers: DataFrame) -> int:
    """Make every view callable by name from SQL (``load_view``); returns how many there are."""
    built = all_views(star, raw_headers)
    for name, df in built.items():
        df.createOrReplaceTempView(name)
    return len(built)


def load_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


CLAIMS_BETWEEN = "claims_submitted_between"


def register_range_function(star: Star, name: str = CLAIMS_BETWEEN) -> None:
    """A SQL table function of this session: the claims submitted between two dates, both inclusive.

    ``SELECT … FROM claims_submitted_between(DATE'2025-01-01', DATE'2025-03-31')``. The call is put in place of its body,
    so the two dates become limits on the month folders, which are pruned, and on the date key, which is pushed to the
    files; columns that are not asked for are not read.
    """
    fact = star["fct_claim_header"]
    fact.createOrReplaceTempView(f"_{name}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fact.schema.fields)
    number = "(year({0}) * 100 + month({0}))".format
    key = "(year({0}) * 10000 + month({0}) * 100 + day({0}))".format
    fact.sparkSession.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(date_from DATE, date_to DATE) RETURNS TABLE ({columns})
        RETURN SELECT {', '.join(fact.columns)} FROM _{name}
        WHERE {MONTH} BETWEEN {number(f'{name}.date_from')} AND {number(f'{name}.date_to')}
          AND submission_date_key BETWEEN {key(f'{name}.date_from')} AND {key(f'{name}.date_to')}""")


def attach(lake: Lake, number: int | None = None) -> versions.Version:
    """Make every view of a published version callable by name in this session, in SQL too.

    The version is resolved once: whatever is published later, these names keep their data until they are attached
    anew. Nothing is computed here; a view reads the version's tables when it is queried.
    """
    version = versions.open_version(lake, number)
    register_views(version.tables("marts"), version.read("raw", "claims_header"))
    register_range_function(version.tables("marts"))
    return version


def published_view(lake: Lake, name: str, number: int | None = None) -> DataFrame:
    """One view of a published version, without registering names."""
    version = versions.open_version(lake, number)
    return view(name, version.tables("marts"), version.read("raw", "claims_header"))


def smoke_check(star: Star, raw_headers: DataFrame, keep: Callable[[str, DataFrame], DataFrame] = lambda name, count: count) -> DataFrame:
    """Row count of every view, and whether the three that must not be empty have rows. ``keep`` stores the count of a view
    by its name, if it is to be; then the views are counted one after another, and one at a time has its shuffles on disk."""
    counts = union_all([keep(n, count_rows(df, n)) for n, df in all_views(star, raw_headers).items()])
    ok = ~F.col("table_name").isin(*MUST_HAVE_ROWS) | (F.col("row_count") > 0)
    return counts.select(F.col("table_name").alias("view_name"), "row_count", ok.alias("ok"))
