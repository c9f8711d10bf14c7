"""Published versions, commits and run ids, with builds that stop half way and writers at the same time."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from medledger.operators.star import MARTS
from medledger.plans import pipeline, views
from medledger.quality import engine
from medledger.sources import commits, versions
from medledger.sources.lake import Lake
from medledger.sources.schemas import RAW_TABLES
from tests.test_quality import raw  # noqa: F401
from tests.test_sources import write_landing


def copied(claims, lake, share=1.0):
    """A draft with the fixture's raw and mart tables, claims cut to a share."""
    made = versions.draft(lake)
    for t in RAW_TABLES:
        made.replace("raw", t, claims.raw[t])
    for t in MARTS:
        df = claims.marts[t]
        made.replace("marts", t, df.filter(F.rand(1) < share) if t == "fct_claim_header" else df)
    return made


def published(lake, made):
    return pipeline.publish_marts(lake, dict.fromkeys(RAW_TABLES, made), made)


def test_one_writer_gets_a_number(spark, tmp_path):
    folder = str(tmp_path / "commits")
    assert commits.numbers(spark, folder) == []
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: commits.create(spark, folder, 5, {"by": k}), range(8)))
        assert sum(made) == 1 and commits.read(spark, folder, 5) == {"by": made.index(True)}
        taken = list(pool.map(lambda k: commits.claim_next(spark, folder, {"by": k}), range(8)))
    assert sorted(taken) == list(range(6, 14)) == commits.numbers(spark, folder)[1:]
    assert {commits.read(spark, folder, n)["by"] for n in taken} == set(range(8))
    assert not [p for p in (tmp_path / "commits").iterdir() if p.name.startswith("_")]


def test_two_quality_runs_at_once(spark, lake, raw):  # noqa: F811
    dirty = raw([dict(adjudication_mode="")])
    clean = raw([{}])
    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(lambda r: engine.run(lake, r), (dirty, clean))
    assert {a.run_id, b.run_id} == {1, 2}
    rows = lake.read("dq", "dq_results").groupBy("run_id").count().collect()
    assert sorted(map(tuple, rows)) == [(1, 39), (2, 39)]
    failed = lake.read("dq", "dq_failed_records").select("run_id").collect()
    assert [r.run_id for r in failed] == [a.run_id]
    with pytest.raises(engine.RunExists):
        engine.run(lake, clean, run_id=1)
    assert engine.run(lake, clean, run_id=7).run_id == 7 and engine.claim_run_id(lake) == 8


def test_run_ids_go_on_where_a_lake_without_markers_ended(spark, lake):
    old = spark.range(3).select((F.col("id") + 4).cast("int").alias("run_id"), F.lit("x").alias("rule_id"))
    lake.replace_partition("dq", "dq_results", old, "run_id")
    assert engine.claim_run_id(lake) == 7
    with pytest.raises(engine.RunExists):
        engine.claim_run_id(lake, 5)


def test_readers_keep_their_version(spark, claims, lake):
    with pytest.raises(versions.NoVersion):
        versions.open_version(lake)
    first = published(lake, copied(claims, lake))
    opened = views.attach(lake)
    n = claims.marts["fct_claim_header"].count()
    assert (first.number, opened.number) == (1, 1) and spark.table("v_claims_enriched").count() == n
    half = copied(claims, lake, 0.5)
    published(lake, half)
    m = half.read("marts", "fct_claim_header").count()
    assert 0 < m < n and spark.table("v_claims_enriched").count() == n  # until attached anew
    assert views.attach(lake).number == 2 and spark.table("v_claims_enriched").count() == m
    assert views.published_view(lake, "v_claims_enriched", 1).count() == n
    assert versions.numbers(lake) == [1, 2]
    assert versions.expire(lake, keep=1) == [1] and versions.numbers(lake) == [2]
    with pytest.raises(versions.NoVersion):
        versions.open_version(lake, 1)
    assert not commits.exists(spark, first.places("marts")["dim_date"].root)
    assert versions.open_version(lake).read("marts", "dim_date").count() > 0


def test_versions_may_share_tables(spark, lake):
    a, b = versions.draft(lake), versions.draft(lake)
    a.replace("marts", "one", spark.range(3))
    a.replace("marts", "two", spark.range(4))
    b.replace("marts", "two", spark.range(5))
    lake.replace("marts", "three", spark.range(6))
    versions.publish(lake, {"marts": {"one": a, "two": a, "three": lake}})
    versions.publish(lake, {"marts": {**versions.open_version(lake).places("marts"), "two": b}}, label="x")
    assert {n: df.count() for n, df in versions.open_version(lake).tables("marts").items()} == {"one": 3, "two": 5, "three": 6}
    assert versions.open_version(lake).about["label"] == "x"
    assert versions.expire(lake, 1) == [1]  # its folder is still in use
    assert {n: df.count() for n, df in versions.open_version(lake).tables("marts").items()} == {"one": 3, "two": 5, "three": 6}
    with pytest.raises(ValueError, match="not stored under"):
        versions.publish(lake, {"marts": {"one": Lake(spark, lake.root + "-elsewhere")}})


def test_views_by_name_in_a_new_session(spark, claims, lake):
    made = copied(claims, lake)
    published(lake, made)
    other = spark.newSession()
    assert not other.catalog.tableExists("v_pmpm")
    views.attach(Lake(other, lake.root))
    want = views.STAR_VIEWS["v_pmpm"](claims.marts).orderBy("year_month").collect()
    assert other.sql("SELECT * FROM v_pmpm ORDER BY year_month").collect() == want


def test_a_build_that_stops_half_way_is_not_seen(spark, claims, lake, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_landing(claims, landing)
    settings = pipeline.Settings(str(landing), export=False, run_assertions=False)
    pipeline.run_pipeline(lake, settings)
    want = sorted(map(str, views.published_view(lake, "v_financial_monthly").collect()))

    def stops(*_):
        raise RuntimeError("the cluster is gone")

    with monkeypatch.context() as m:
        m.setattr(pipeline.star_ops, "fct_claim_line", stops)
        with pytest.raises(RuntimeError, match="gone"):
            pipeline.run_pipeline(lake, settings)
    assert versions.numbers(lake) == [1]
    assert sorted(map(str, views.published_view(lake, "v_financial_monthly").collect())) == want
    drafts = versions.draft(lake)
    drafts.replace("marts", "dim_date", claims.marts["dim_date"])
    with pytest.raises(ValueError, match="not stored whole"):
        published(lake, drafts)
    assert versions.numbers(lake) == [1]
