"""What the batch job holds on disk at once: packed tables, landing files that are done with, one shuffle at a time."""

import pytest
from pyspark.sql import functions as F

from fixtures.planted import planted_marts
from medledger import catalogue
from medledger.operators import star as star_ops
from medledger.plans import pipeline, views
from medledger.plans.demo import ClaimsLake
from medledger.quality import assertions
from medledger.sources.lake import Lake
from medledger.sources.landing import ingest_table, refused_rows
from medledger.sources.schemas import RAW_COLUMNS, RAW_TABLES


def codecs(folder) -> set[str]:
    return {p.name.split(".")[-2] for p in folder.rglob("*.parquet")}


def test_landed_tables_are_packed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    columns = RAW_COLUMNS["diagnoses"]
    (tmp_path / "in/diagnoses.csv").write_text(",".join(columns) + '\nD1,one,A\nD2,"tw\no",B\nD3,three\n')
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest_table(lake, str(tmp_path / "in"), "diagnoses", on_malformed="keep")
    assert codecs(tmp_path / "lake/raw/diagnoses") == {"zstd"}
    assert sorted(r.description for r in lake.read("raw", "diagnoses").collect()) == ["one", "tw\no"]
    assert refused_rows(lake, "diagnoses").count() == 1


def test_parts_of_a_fact_are_one_table_with_an_end_mark_at_the_end(spark, tmp_path):
    lake, mark = Lake(spark, str(tmp_path)), tmp_path / "marts/f/_SUCCESS"
    rows = spark.range(0, 600).selectExpr("cast(id AS string) AS claim_id", "cast(20250101 + 100 * (id % 2) AS int) AS day")
    stops = rows.limit(1).withColumn("claim_id", F.expr("raise_error('the cluster is gone')").cast("string"))
    lake.replace_by_month("marts", "f", rows, "day")
    assert mark.exists()
    with pytest.raises(Exception, match="the cluster is gone"):
        lake.replace_by_month("marts", "f", [rows, stops], "day")
    assert not mark.exists()
    nameless = rows.union(spark.sql("SELECT CAST(NULL AS string), 20250301"))
    parts = star_ops.parts_of_claims(nameless, 4)
    assert len(parts) == 4 and all(p.count() for p in parts) and star_ops.parts_of_claims(rows, 1) == [rows]
    stored = lake.replace_by_month("marts", "f", parts, "day")
    assert mark.exists() and stored.count() == 601 and stored.drop("submission_month").exceptAll(nameless).isEmpty()


def test_only_rows_of_repeated_hashes_are_folded_by_digest(spark, claims, tmp_path):
    lake, kept = Lake(spark, str(tmp_path)), []

    def keep(keys):
        kept.append(lake.replace("work", f"keys_{len(kept)}", keys))
        return kept[-1]

    sound = claims.models()
    assert assertions.evaluate(sound, keep).filter("failures > 0").isEmpty() and kept[0].isEmpty()
    planted = planted_marts(sound)
    planted["fct_claim_line"] = planted["fct_claim_line"].withColumn(
        "claim_line_sk", F.expr("CASE right(claim_line_id, 1) WHEN '5' THEN 'same' WHEN '6' THEN NULL ELSE claim_line_sk END"))
    found = sorted(map(str, assertions.evaluate(planted, keep).collect()))
    assert found == sorted(map(str, assertions.evaluate(planted).collect())) and len(found) == 89
    assert len(kept) == 2 and kept[1].columns == ["signature"] and kept[1].count() > 1


def test_views_are_counted_one_after_another_if_their_counts_are_kept(claims):
    kept = {}

    def keep(name, count):
        kept[name] = count
        return count

    headers = claims.tables["claims_header"]
    found = views.smoke_check(claims.star, headers, keep)
    assert set(kept) == {*views.STAR_VIEWS, *views.RAW_VIEWS} and all(c.columns == ["table_name", "row_count"] for c in kept.values())
    assert sorted(map(str, found.collect())) == sorted(map(str, views.smoke_check(claims.star, headers).collect()))


def test_the_batch_job_keeps_no_landing_files_and_stores_raw_tables_once(spark, claims, tmp_path, monkeypatch):
    job = ClaimsLake(spark, claims.source.sf_dir)
    job.lake = Lake(spark, str(tmp_path / "lake"))
    monkeypatch.setattr(catalogue, "claims_lake", lambda *_: job)
    monkeypatch.setattr(pipeline, "LINES_A_PART", 2000)
    asked, deal = [], star_ops.parts_of_claims
    monkeypatch.setattr(pipeline.star_ops, "parts_of_claims", lambda df, n: asked.append(n) or deal(df, n))
    rows = {(r.part, r.name): r.row_count for r in catalogue.QUERIES["batch_job"](spark, claims.source.sf_dir).collect()}
    assert asked == [3, 3] and len(rows) == 42  # 6,000 lines
    for layer, tables in (("raw", {t: claims.tables[t] for t in RAW_TABLES}), ("marts", claims.marts)):
        assert {n: rows[layer, n] for n in tables} == {n: df.count() for n, df in tables.items()}
    left = tmp_path / "lake/landing"
    assert not list((left / "job").glob("*.csv")) and not (tmp_path / "lake/raw").exists()
    assert codecs(left / "job-lake") == {"zstd"}


def test_landing_files_stay_unless_told_otherwise():
    assert pipeline.Settings("somewhere").keep_landing
