"""Command line: ``python -m medledger run --landing DIR --lake DIR``, or one step: ``ingest``, ``quality``, ``marts``
(which publishes a version), ``views`` (checks the views of a version), ``show --view NAME``.

Exit codes: 0 done, 1 an assertion or the check of the views failed, 2 a critical data-quality rule failed, 3 a landing
file holds rows that cannot be read.
"""

from __future__ import annotations

import argparse
import sys

from medledger.plans.pipeline import (
    AssertionsFailed,
    Settings,
    build_marts,
    check_marts,
    known_members,
    publish_marts,
    run_pipeline,
)
from medledger.plans.summaries import build_summaries
from medledger.plans.views import RAW_VIEWS, STAR_VIEWS, published_view, smoke_check
from medledger.quality import engine
from medledger.session import build_session
from medledger.sources import versions
from medledger.sources.lake import Lake
from medledger.sources.landing import AUDIT, MalformedRows, ingest_all
from medledger.sources.schemas import RAW_TABLES

VIEWS = (*STAR_VIEWS, *RAW_VIEWS)


def arguments(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="medledger")
    p.add_argument("step", choices=["run", "ingest", "quality", "marts", "views", "show"])
    p.add_argument("--lake", required=True, help="root folder of the stored layers")
    p.add_argument("--landing", help="folder of the landing CSV files (run, ingest)")
    p.add_argument("--master", help="Spark master, if not set by the launcher")
    p.add_argument("--ignore-critical", action="store_true", help="report critical failures without stopping")
    p.add_argument("--no-export", action="store_true")
    p.add_argument("--keep-malformed", action="store_true", help="store rows that cannot be read aside and go on")
    p.add_argument("--version", type=int, help="number of a published version (views, show); the newest by default")
    p.add_argument("--view", help="name of a view (show)")
    a = p.parse_args(argv)
    if a.step in ("run", "ingest") and not a.landing:
        p.error(f"{a.step} needs --landing")
    if a.step == "show" and a.view not in VIEWS:
        p.error(f"--view is one of {', '.join(VIEWS)}")
    return a


def ingest(lake: Lake, landing: str, on_malformed: str) -> None:
    made = versions.draft(lake)
    ingest_all(made, landing, on_malformed).show(truncate=False)
    versions.publish(lake, {"raw": dict.fromkeys((*RAW_TABLES, AUDIT), made)}, versions.LANDED)


def quality(lake: Lake, stop: bool) -> None:
    run = engine.run(lake, versions.open_version(lake, kind=versions.LANDED).tables("raw", RAW_TABLES))
    engine.scores(run.results).orderBy("scope", "name").show(50, truncate=False)
    engine.report(run.results).write.mode("overwrite").json(lake.path("exports", "dq_report"))
    if stop:
        engine.check_gate(run.results, run.unread)


def marts(lake: Lake) -> None:
    """Build the star from the tables that landed last, aside; publish it once it is checked."""
    landed, made = versions.open_version(lake, kind=versions.LANDED), versions.draft(lake)
    built = build_marts(made, landed.tables("raw", RAW_TABLES))
    check_marts(landed, built)
    build_summaries(made, built, known_members(lake))
    publish_marts(lake, landed.places("raw"), made)


def checked_views(lake: Lake, number: int | None) -> int:
    version = versions.open_version(lake, number)
    found = smoke_check(version.tables("marts"), version.read("raw", "claims_header"))
    rows = found.orderBy("view_name").collect()  # a row for each view
    for r in rows:
        print(f"version {version.number}  {r.view_name:28s} {r.row_count:12d}  {'ok' if r.ok else 'EMPTY'}")
    return 0 if all(r.ok for r in rows) else 1


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    lake = Lake(build_session(a.master), a.lake)
    malformed = "keep" if a.keep_malformed else "stop"
    try:
        if a.step == "run":
            run_pipeline(lake, Settings(a.landing, fail_on_critical=not a.ignore_critical, export=not a.no_export,
                                        on_malformed=malformed))
        elif a.step == "ingest":
            ingest(lake, a.landing, malformed)
        elif a.step == "quality":
            quality(lake, stop=not a.ignore_critical)
        elif a.step == "marts":
            marts(lake)
        elif a.step == "views":
            return checked_views(lake, a.version)
        else:
            published_view(lake, a.view, a.version).show(50, truncate=False)
    except engine.QualityGateError as e:
        print(e, file=sys.stderr)
        return e.exit_code
    except AssertionsFailed as e:
        print(e, file=sys.stderr)
        return 1
    except MalformedRows as e:
        print(e, file=sys.stderr)
        return 3
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
