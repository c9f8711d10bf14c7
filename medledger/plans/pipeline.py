"""The layered batch job: landing files, gate, star schema, views, exports."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medledger.functions import register_sql_functions
from medledger.operators import star as star_ops
from medledger.operators.cleaning import repeated_signatures
from medledger.operators.staging import stage, stage_all
from medledger.plans import consumers
from medledger.plans.summaries import SUMMARIES, build_summaries
from medledger.plans.views import register_views
from medledger.quality import assertions, engine
from medledger.sources import commits, versions
from medledger.sources.lake import Lake, OnUse
from medledger.sources.landing import AUDIT, count_rows, ingest_all, union_all
from medledger.sources.schemas import RAW_TABLES


@dataclass(frozen=True)
class Settings:
    landing_dir: str
    fail_on_critical: bool = True
    run_assertions: bool = True
    export: bool = True
    on_malformed: str = "stop"  # or "keep": rows that cannot be read are stored aside and the load goes on
    keep_landing: bool = True  # or not: the landing files are deleted once all eight tables are loaded, refused rows too


class AssertionsFailed(RuntimeError):
    pass


#: Beyond so many lines they meet their headers in parts, of which one at a time has its shuffle on disk. Each part reads the
#: stored lines once more, so there are few.
LINES_A_PART, MOST_PARTS = 50_000_000, 4


def marts_on_use(lake: Lake, raw: Mapping[str, DataFrame]) -> OnUse:
    """The nine dimensions and three facts, each written when it is first asked for; a fact reads the stored tables it
    builds on, so the cleaned claims are computed once, and whoever asks for no lines has none written."""
    staged = OnUse(RAW_TABLES, lambda t: stage(t, raw[t]))

    def store(name: str) -> DataFrame:
        if name == "fct_claim_header":
            headers = staged["claims_header"]
            # stored first, so that Spark knows how few they are before it plans the headers
            repeated = lake.replace("work", "repeated_signatures", repeated_signatures(headers))
            claims = star_ops.accepted_claims(headers, marts, repeated)
            return lake.replace_by_month("marts", name, claims, "submission_date_key", star_ops.header_fact)
        if name == "fct_claim_line":
            lines = staged["claims_lines"]
            # stored first, so that Spark knows how few they are before it plans the lines
            odd = lake.replace("work", "odd_procedures", star_ops.odd_procedures(lines, marts["dim_procedure"]))
            headers = marts["fct_claim_header"]
            n = min(MOST_PARTS, max(1, math.ceil(raw["claims_lines"].count() / LINES_A_PART)))
            parts = zip(star_ops.parts_of_claims(lines, n), star_ops.parts_of_claims(headers, n), strict=True)
            return lake.replace_by_month(
                "marts", name, [star_ops.fct_claim_line(some, of, marts, odd) for some, of in parts], "submission_date_key")
        if name == "fct_monthly_member_summary":
            return lake.replace("marts", name, star_ops.fct_monthly_member_summary(marts["fct_claim_header"], marts["dim_member"]))
        return lake.replace("marts", name, star_ops.DIMENSION_OF[name](lake.spark, staged))

    marts = OnUse(star_ops.MARTS, store)
    return marts


def build_marts(lake: Lake, raw: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Write all nine dimensions and three facts."""
    return dict(marts_on_use(lake, raw or lake.tables("raw", RAW_TABLES)))


def staged_models(stored: Lake | versions.Version) -> dict[str, DataFrame]:
    return {f"stg_{t}": df for t, df in stage_all(stored.tables("raw", RAW_TABLES)).items()}


def check_marts(lake: Lake | versions.Version, marts: dict[str, DataFrame]) -> None:
    keep = (lambda keys: lake.replace("work", "repeated_keys", keys)) if isinstance(lake, Lake) else None
    found = assertions.evaluate({**staged_models(lake), **marts}, keep)
    bad = found.filter("failures > 0").select("assertion", "failures").collect()
    if bad:  # at most 89 rows
        raise AssertionsFailed(", ".join(f"{r.assertion}={r.failures}" for r in bad))


def export_reports(lake: Lake, marts: dict[str, DataFrame], run: engine.QualityRun) -> None:
    def out(name: str, df: DataFrame, fmt: str = "parquet") -> None:
        with lake.writing():
            df.write.mode("overwrite").format(fmt).save(lake.path("exports", name))

    out("kpi_summary", consumers.kpi_summary(marts))
    out("kpi_monthly_trend", consumers.kpi_monthly_trend(marts))
    out("claims_detail", consumers.claims_detail(marts))
    out("provider_report", consumers.provider_report(marts))
    out("dq_latest", engine.latest_run(lake.read("dq", "dq_results")))
    out("dq_report", engine.report(run.results), "json")


def publish_marts(lake: Lake, raw: dict[str, Lake], marts: Lake, run_id: int | None = None) -> versions.Version:
    """Make stored raw tables (by where each lies), mart tables and, if there are, their summaries the newest version."""
    tables = {"raw": raw, "marts": dict.fromkeys(star_ops.MARTS, marts)}
    if marts.exists("summaries", "member_numbers"):
        tables["summaries"] = dict.fromkeys(SUMMARIES, marts)
    return versions.publish(lake, tables, quality_run=run_id)


def known_members(lake: Lake) -> DataFrame | None:
    """The member numbers of the newest version, which the next one goes on with."""
    if not versions.numbers(lake):
        return None
    newest = versions.open_version(lake)
    return newest.read("summaries", "member_numbers") if "summaries" in newest.about["tables"] else None


def run_pipeline(lake: Lake, settings: Settings) -> dict[str, DataFrame]:
    """Landing files to a published version. Raw and mart tables are written to a folder of their own, and readers see
    them once all is checked: a run that stops, wherever it does, leaves the version before it as the newest.

    Stops with ``MalformedRows`` on rows that cannot be read (unless told to keep them aside), with ``QualityGateError``
    before the star is built if a critical rule fails, and with ``AssertionsFailed`` before it is published. Quality runs
    and exports are kept for the lake as a whole.
    """
    made = versions.draft(lake)
    ingest_all(made, settings.landing_dir, settings.on_malformed)
    if not settings.keep_landing:
        for t in RAW_TABLES:
            commits.delete_folder(lake.spark, f"{settings.landing_dir}/{t}.csv")
    raw = made.tables("raw", RAW_TABLES)
    register_sql_functions(lake.spark)
    run = engine.run(lake, raw)
    if settings.fail_on_critical:
        engine.check_gate(run.results, run.unread)
    marts = build_marts(made, raw)
    if settings.run_assertions:
        check_marts(made, marts)
    build_summaries(made, marts, known_members(lake))
    publish_marts(lake, dict.fromkeys((*RAW_TABLES, AUDIT), made), made, run.run_id)
    register_views(marts, raw["claims_header"])
    if settings.export:
        export_reports(lake, marts, run)
    return marts


def layer_counts(lake: Lake) -> DataFrame:
    """Rows per stored table of the raw and mart layers."""
    frames = []
    for layer, names in (("raw", RAW_TABLES), ("marts", star_ops.MARTS)):
        frames += [count_rows(lake.read(layer, n), n).withColumn("layer", F.lit(layer)) for n in names]
    return union_all(frames).select("layer", "table_name", "row_count")
