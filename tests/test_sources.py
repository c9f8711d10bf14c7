import pytest
from pyspark.sql import functions as F

from medledger.quality import engine
from medledger.sources.landing import ingest_all, ingest_table, read_text_csv, reconcile
from medledger.sources.lake import MONTH
from medledger.sources.schemas import RAW_COLUMNS, RAW_TABLES


def test_csv_keeps_dirt(spark, tmp_path):
    p = tmp_path / "diagnoses.csv"
    p.write_text('diagnosis_code,description,chapter\n1,,karachi \n2,"a ""b"", c",KARACHI\n3, x,\n', encoding="utf-8")
    rows = read_text_csv(spark, str(p), "diagnoses").orderBy("diagnosis_code").collect()
    assert [tuple(r) for r in rows] == [("1", "", "karachi "), ("2", 'a "b", c', "KARACHI"), ("3", " x", "")]


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    p = tmp_path / "diagnoses.csv"
    p.write_text("diagnosis_code,other,chapter\n1,a,b\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        read_text_csv(spark, str(p), "diagnoses").collect()


def test_missing_file_is_an_error(lake, tmp_path):
    with pytest.raises(FileNotFoundError, match="members"):
        ingest_table(lake, str(tmp_path), "members")


def write_landing(claims, folder):
    """One CSV file per table, as the landing zone holds them."""
    for t in RAW_TABLES:
        claims.raw[t].toPandas().to_csv(folder / f"{t}.csv", index=False)


def test_ingest_counts_reconcile(claims, lake, tmp_path):
    write_landing(claims, tmp_path)
    audit = {r.table_name: r.row_count for r in ingest_all(lake, str(tmp_path)).collect()}
    assert audit == {t: claims.raw[t].count() for t in RAW_TABLES}
    stored = lake.tables("raw", RAW_TABLES)
    assert reconcile(claims.raw, stored).filter("NOT matches").count() == 0
    for t in ("members", "claims_header"):
        assert stored[t].columns == RAW_COLUMNS[t]
        assert stored[t].exceptAll(claims.raw[t]).count() == 0
    # a second load replaces, never adds
    assert {r.table_name: r.row_count for r in ingest_all(lake, str(tmp_path)).collect()} == audit


def test_reconcile_reports_a_difference(spark):
    a, b = spark.range(3), spark.range(2)
    r = reconcile({"t": a, "u": a}, {"t": b, "u": a}).orderBy("table_name").collect()
    assert [(x.table_name, x.source_rows, x.stored_rows, x.matches) for x in r] == [("t", 3, 2, False), ("u", 3, 3, True)]


def test_month_folders_are_pruned(claims):
    from medledger.plans.enriched import submitted_between

    fact = claims.marts["fct_claim_header"]
    cut = submitted_between(fact, "2025-01-15", "2025-02-10").select("claim_id", "billed_amount_pkr")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert f"({MONTH}" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(submission_date_key,20250115)" in plan
    schema = plan.split("ReadSchema:")[1]
    assert "paid_amount_pkr" not in schema and "billed_amount_pkr" in schema
    want = fact.filter(F.col("submission_date_key").between(20250115, 20250210)).count()
    assert cut.count() == want > 0


@pytest.mark.parametrize("line", ["1,a,b,extra", "1,a", '1,"a\nb",c'])
def test_malformed_rows_stop_the_load(spark, tmp_path, line):
    p = tmp_path / "diagnoses.csv"
    p.write_text(f"diagnosis_code,description,chapter\n2,x,y\n{line}\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED"):
        read_text_csv(spark, str(p), "diagnoses").collect()


def test_line_breaks_in_fields(spark, tmp_path):
    p = tmp_path / "diagnoses.csv"
    p.write_text('diagnosis_code,description,chapter\n1,"a\nb",c\n2,x,y\n', encoding="utf-8")
    rows = read_text_csv(spark, str(p), "diagnoses", multi_line=True).orderBy("diagnosis_code").collect()
    assert [tuple(r) for r in rows] == [("1", "a\nb", "c"), ("2", "x", "y")]


def test_an_unreadable_table_is_not_an_absent_one(lake, tmp_path):
    assert not lake.exists("dq", "dq_results")
    with pytest.raises(Exception, match="gone|schema|Parquet|FILE|footer"):
        folder = tmp_path / "lake" / "dq" / "dq_results"
        folder.mkdir(parents=True)
        (folder / "part-0.parquet").write_text("no parquet")
        assert lake.exists("dq", "dq_results") is None


def test_numbers_that_staging_would_lose(spark, frame):
    names = " ".join(RAW_COLUMNS["claims_header"])
    at = RAW_COLUMNS["claims_header"].index("billed_amount_pkr")
    values = ["12,000.00", "abc", "1e20", "10.005", "", "10.50", "-3", "1e3", " 7 "]
    rows = [tuple(f"C{i}" if k == 0 else v if k == at else "" for k in range(len(RAW_COLUMNS["claims_header"]))) for i, v in enumerate(values)]
    lost = engine.unread_numbers({"claims_header": frame(names, rows)}).orderBy("record_key").collect()
    assert [(r.record_key, r.column_name, r.raw_value) for r in lost] == [(f"C{i}", "billed_amount_pkr", values[i]) for i in range(4)]
    with pytest.raises(engine.QualityGateError, match=engine.UNREAD):
        engine.check_gate(spark.createDataFrame([], "rule_id string, severity string, passed boolean"),
                          engine.unread_numbers({"claims_header": frame(names, rows)}))
