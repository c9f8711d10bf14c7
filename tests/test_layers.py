"""Tables are stored on use, packed, and no shuffle carries what follows from a row or looks up what is in a book once."""

import time

from pyspark.sql import functions as F

from medledger.functions import surrogate_key
from medledger.operators import star as star_ops
from medledger.operators.cleaning import first_per_signature, repeated_signatures
from medledger.operators.staging import stage
from medledger.plans import consumers
from medledger.plans.clinical import v_readmissions
from medledger.plans.pipeline import marts_on_use
from medledger.quality import engine
from medledger.quality.rules import RULES, KnownParent, UniqueKey
from medledger.session import tune
from medledger.sources.lake import Lake, OnUse
from medledger.sources.landing import ingest_table, write_text_csv
from medledger.sources.schemas import RAW_COLUMNS
from tests.test_cleaning import HEADER

ROWS = {
    "members": {"member_id": "M1", "date_of_birth": "1980-01-01", "enrolment_date": "2024-01-01"},
    "providers": {"provider_id": "P1"},
    "claims_header": HEADER,
    "claims_lines": {"claim_id": "C1", "claim_line_id": "L1", "quantity": "1", "line_billed_pkr": "2.00", "line_approved_pkr": "1.00"},
}


def raw_of(spark, asked):
    def make(name):
        asked.append(name)
        row = [ROWS.get(name, {}).get(c, "") for c in RAW_COLUMNS[name]]
        return spark.createDataFrame([row], ", ".join(f"{c} string" for c in RAW_COLUMNS[name]))
    return OnUse(RAW_COLUMNS, make)


def test_a_dimension_reads_and_stores_nothing_else(spark, tmp_path):
    asked, lake = [], Lake(spark, str(tmp_path))
    marts = marts_on_use(lake, raw_of(spark, asked))
    assert [r.member_id for r in marts["dim_member"].collect()] == ["M1"]
    assert asked == ["members"] and [p.name for p in (tmp_path / "marts").iterdir()] == ["dim_member"]


def test_headers_need_no_lines(spark, tmp_path):
    asked, lake = [], Lake(spark, str(tmp_path))
    marts = marts_on_use(lake, raw_of(spark, asked))
    assert marts["fct_claim_header"].count() == 1
    assert not {"claims_lines", "procedures", "diagnoses"} & {*asked}
    assert not lake.exists("marts", "fct_claim_line") and "fct_claim_line" in marts
    assert set(dict(marts)) == set(star_ops.MARTS) and lake.exists("marts", "fct_claim_line")


def test_stored_tables_are_packed_and_their_shuffles_deleted(spark, tmp_path):
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    Lake(spark, str(tmp_path)).replace("raw", "t", spark.range(9))
    assert list((tmp_path / "raw/t").glob("*.zstd.parquet"))
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec
    with Lake(spark, str(tmp_path)).writing():
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_shuffles_of_a_query_are_deleted_when_it_is_done(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    tune(spark)
    before, until = shuffles(), time.time() + 20
    counted = spark.range(0, 99, 1, 4).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(counted.collect()) == 7
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert len(counted.collect()) == 7  # it is made once more if need be


def test_packed_landing_files_are_loaded_whole(spark, tmp_path):
    providers = spark.range(0, 500, 1, 3).select(*[F.concat(F.lit(f'{c}, "'), "id").alias(c) for c in RAW_COLUMNS["providers"]])
    write_text_csv(providers, str(tmp_path / "in/providers.csv"), packed_by="gzip")
    assert len(list((tmp_path / "in/providers.csv").glob("*.csv.gz"))) == 3
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest_table(lake, str(tmp_path / "in"), "providers")
    found = lake.read("raw", "providers")
    assert found.count() == 500 and found.exceptAll(providers).isEmpty()


def test_procedures_are_looked_up_as_often_as_the_book_has_them(spark):
    lines = spark.createDataFrame(
        [(code, code, "C1") for code in ("once", "twice", "lacking", None)], "claim_line_id string, procedure_code string, claim_id string",
    ).selectExpr("claim_line_id", "claim_id", "1 AS line_no", "procedure_code", "'D' AS diagnosis_code", "2.00BD AS quantity",
                 "1.00BD AS unit_price_pkr", "9.00BD AS line_billed_pkr", "4.00BD AS line_approved_pkr")
    header = spark.sql("SELECT 'C1' AS claim_id, 'm' AS member_sk, 'p' AS provider_sk, 20250101 AS submission_date_key, "
                       "'Inpatient' AS claim_type, 'Paid' AS status")
    book = spark.createDataFrame([("once",), ("twice",), ("twice",), ("unused",), (None,)], "procedure_code string")
    dims = {"dim_procedure": star_ops.keyed_book(book, "procedure_code", "procedure_sk"),
            "dim_diagnosis": star_ops.keyed_book(spark.sql("SELECT 'D' AS diagnosis_code"), "diagnosis_code", "diagnosis_sk")}
    found = star_ops.fct_claim_line(lines, header, dims)
    want = lines.join(dims["dim_procedure"], "procedure_code", "left").select("procedure_code", "procedure_sk")
    assert sorted(map(str, found.select("procedure_code", "procedure_sk").collect())) == sorted(map(str, want.collect()))
    assert found.count() == 5 and found.filter(F.col("procedure_sk") == surrogate_key("procedure_code")).count() == 3


def test_what_follows_from_a_row_is_not_shuffled(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lines = spark.range(3).selectExpr(
        "cast(id AS string) AS claim_line_id", "'C' AS claim_id", "1 AS line_no", "'m' AS member_sk", "'p' AS provider_sk",
        "'d' AS diagnosis_sk", "true AS procedure_known", "20250101 AS submission_date_key", "'Inpatient' AS claim_type",
        "'Paid' AS status", "'PX' AS procedure_code", "'DX' AS diagnosis_code", "1BD AS quantity", "1BD AS unit_price_pkr",
        "3.00BD AS line_billed_pkr", "1.00BD AS line_approved_pkr")
    dealt = star_ops.line_fact(lines.withColumn("submission_month", F.lit(202501)).hint("rebalance", "submission_month"))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("md5(") < plan.index("RebalancePartitions")
    stored = lake.replace_by_month("marts", "l", lines, "submission_date_key", star_ops.line_fact)
    assert stored.columns == [*star_ops.line_fact(lines).columns, "submission_month"] and stored.count() == 3


def test_lost_and_repeated_keys_are_stored_before_rows_are_matched(spark, tmp_path):
    lake, raw = Lake(spark, str(tmp_path)), dict(raw_of(spark, []))
    raw["providers"] = raw["providers"].union(raw["providers"])
    rules = [r for r in RULES if isinstance(r.check, (UniqueKey, KnownParent))]
    kept = []

    def keep(keys):
        kept.append(keys)
        return lake.replace("work", "bad_keys", keys)

    found = engine.failed_records(raw, rules, keep)
    assert sorted(map(str, found.collect())) == sorted(map(str, engine.failed_records(raw, rules).collect())) != []
    assert len(kept) == 1
    assert kept[0].filter("space = 'providers.provider_id' AND key = 'P1' AND owners = 2").count() == 1
    assert kept[0].filter("NOT (owners > 1 OR (children > 0 AND (owners = 0 OR key IS NULL)))").isEmpty()


def test_a_fact_is_not_shuffled_once_more_for_its_months(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(0, 60, 1, 3).selectExpr("id", "cast(20250101 + 100 * (id % 2) AS int) AS day")
    stored = lake.replace_by_month("marts", "f", rows, "day")
    assert sorted(r.id for r in stored.filter("submission_month = 202502").collect()) == list(range(1, 60, 2))
    assert len(list((tmp_path / "marts/f/submission_month=202501").glob("*.parquet"))) == 3  # one from each task


def test_only_rows_of_repeated_signatures_are_shuffled(spark, tmp_path):
    signatures = [("M1", "P1", "2025-01-01", "5.00")] * 3 + [("M1", "", "", "5.00")] * 2 + [("M2", "P1", "2025-01-01", "x")] + [("M3",) * 4]
    rows = []
    for k, (member, provider, day, billed) in enumerate(signatures):
        row = {**HEADER, "claim_id": ["C2", "C1", "C1", None, "C0", "", None][k], "member_id": member, "provider_id": provider,
               "admission_date": day, "billed_amount_pkr": billed}
        rows.append([row.get(c, "") for c in RAW_COLUMNS["claims_header"]])
    headers = stage("claims_header", spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS["claims_header"])))
    listed = Lake(spark, str(tmp_path)).replace("work", "repeated", repeated_signatures(headers))
    assert listed.count() == 2
    found = first_per_signature(headers, listed)
    assert sorted(map(str, found.collect())) == sorted(map(str, first_per_signature(headers).collect()))
    assert found.count() == 4
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.count("WindowGroupLimit") <= 1 and plan.index("LeftAnti") < plan.index("Window [")


def test_lines_meet_their_headers_before_the_code_books(spark):
    lines = spark.sql("SELECT 'L' AS claim_line_id, 'C' AS claim_id, 1 AS line_no, 'PX' AS procedure_code, 'D' AS diagnosis_code, "
                      "2BD AS quantity, 1BD AS unit_price_pkr, 9BD AS line_billed_pkr, 4BD AS line_approved_pkr")
    header = spark.sql("SELECT 'C' AS claim_id, 'm' AS member_sk, 'p' AS provider_sk, 20250101 AS submission_date_key, 'x' AS claim_type, 'y' AS status")
    book = spark.range(1).selectExpr("'D' AS diagnosis_code", "'d' AS diagnosis_sk")
    odd = spark.range(1).selectExpr("'PY' AS procedure_code", "false AS procedure_known")
    found = star_ops.accepted_lines(lines, header, {"dim_diagnosis": book}, odd)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.index("LeftOuter") < plan.index("Inner")  # the outermost joins are printed first
    assert found.first().diagnosis_sk == "d" and found.first().procedure_known


def test_admissions_are_shuffled_once(spark):
    claims = spark.sql("SELECT * FROM VALUES ('a', 'm', 20250101), ('b', 'm', 20250110), ('c', 'm', 20250301), ('d', null, 20250102), "
                       "('e', 'm', null) t(claim_id, member_sk, admission_date_key)").withColumn("claim_type", F.lit("Inpatient"))
    lines = claims.selectExpr("claim_id", "claim_type", "1 AS line_no", "claim_id AS claim_line_id", "'d' AS diagnosis_sk")
    star = {"fct_claim_header": claims, "fct_claim_line": lines, "dim_diagnosis": spark.sql("SELECT 'd' AS diagnosis_sk, 'x' AS chapter")}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = v_readmissions(star)
        assert [(r.index_claim_id, r.readmit_claim_id, r.days_between) for r in found.collect()] == [("a", "b", 9)]
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_page_over_headers_stores_no_lines(spark, tmp_path):
    asked, lake = [], Lake(spark, str(tmp_path))
    marts = marts_on_use(lake, raw_of(spark, asked))
    consumers.spend_by_city(marts)
    consumers.claims_between(marts, "2025-01-01", "2025-12-31", ["claim_id"])
    assert "claims_lines" not in asked and not lake.exists("marts", "fct_claim_line")
