"""Landing files with line breaks in fields, and rows that cannot be read."""

import random

import pytest
from pyspark.sql import functions as F

from medledger.sources.landing import (
    MalformedRows,
    WrongHeader,
    ingest_all,
    ingest_table,
    read_text_csv,
    refused_rows,
    write_text_csv,
)
from medledger.sources.records import cut_blocks, lines_of, look_at_blocks
from medledger.sources.schemas import RAW_COLUMNS, RAW_TABLES
from tests.test_scale import conf
from tests.test_sources import write_landing

HEADER = "diagnosis_code,description,chapter"
SMALL = {"spark__sql__files__maxPartitionBytes": "2000", "spark__sql__files__openCostInBytes": "1"}


def quoted(field):
    return '"' + field.replace('"', '""') + '"' if any(c in field for c in '",\n\r') else field


def landing_file(folder, rows, end="\n", header=HEADER):
    text = end.join([header, *(",".join(map(quoted, r)) for r in rows)]) + end
    (folder / "diagnoses.csv").write_bytes(text.encode())
    return str(folder)


def stored(lake):
    return sorted(map(tuple, lake.read("raw", "diagnoses").collect()))


def broken_rows(n, seed=1, size=60):
    r = random.Random(seed)
    words = ['a "b" c', "x,y", "line\nbreak", "\n\n", "é中", "", "plain", "two\r\nlines", '"', '""\n"']
    return [(f"D{i:05d}", " ".join(r.choices(words, k=r.randint(1, size // 8))), r.choice(words)) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_big_file_is_read_by_many_tasks(spark, lake, tmp_path, end):
    rows = broken_rows(800)
    folder = landing_file(tmp_path, rows, end)
    with conf(spark, **SMALL):
        lines = lines_of(spark, f"{folder}/diagnoses.csv")
        assert lines.rdd.getNumPartitions() > 12
        blocks = look_at_blocks(lines)
        assert blocks.broken and blocks.files == 1 and sum(map(len, blocks.inside.values())) > 3
        pieces = cut_blocks(lines, blocks, 1 << 20)
        assert pieces.filter("part IN (1, 2, 3)").count() > 6
        counts = ingest_table(lake, folder, "diagnoses")
    assert counts == {"files": 1, "headers": 1, "loaded": 800, "refused": 0}
    assert stored(lake) == sorted(rows)
    if end == "\n":
        whole = read_text_csv(spark, f"{folder}/diagnoses.csv", "diagnoses", multi_line=True)
        assert sorted(map(tuple, whole.collect())) == stored(lake)


def test_a_record_over_many_blocks(spark, lake, tmp_path):
    rows = [("D1", "a", "b"), ("D2", "long\n" * 4000, "c"), ("D3", "x", "y\nz"), ("D4", "\n" * 9000, "e")]
    folder = landing_file(tmp_path, rows)
    with conf(spark, **SMALL):
        assert ingest_table(lake, folder, "diagnoses")["loaded"] == 4
    assert stored(lake) == sorted(rows)


def test_records_without_line_breaks_stay_in_the_jvm(spark, lake, tmp_path):
    rows = [(f"D{i}", 'a "b", c', "") for i in range(500)]
    folder = landing_file(tmp_path, rows)
    with conf(spark, **SMALL):
        lines = lines_of(spark, f"{folder}/diagnoses.csv")
        plan = cut_blocks(lines, look_at_blocks(lines), 1 << 20)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan
        assert ingest_table(lake, folder, "diagnoses")["loaded"] == 500
    assert stored(lake) == sorted(rows)


def test_too_long_and_unclosed_records_are_refused_whole(spark, lake, tmp_path):
    rows = [("D1", "a", "b"), ("D2", "word\n" * 3000, "c"), ("D3", "x", "y\nz")]
    folder = landing_file(tmp_path, rows)
    path = tmp_path / "diagnoses.csv"
    path.write_bytes(path.read_bytes() + b'D4,"never\nclosed,x\n')
    with conf(spark, **SMALL):
        counts = ingest_table(lake, folder, "diagnoses", on_malformed="keep", longest=5000)
    assert counts["loaded"] == 2 and stored(lake) == [rows[0], rows[2]]
    refused = refused_rows(lake, "diagnoses").collect()
    assert {r.reason for r in refused} == {"too long", "no closing quote"} and len(refused) == counts["refused"]
    assert sum(r.record.count("word") for r in refused) == 3000
    assert [r.record for r in refused if r.reason == "no closing quote"] == ['D4,"never\nclosed,x\n'.rstrip("\n")]


def test_malformed_rows_are_counted_and_kept(spark, lake, tmp_path):
    good = broken_rows(50, size=16)
    bad = ["X1,a", "X2,a,b,c", 'X3,"a\nb"', "X4"]
    folder = landing_file(tmp_path, good)
    path = tmp_path / "diagnoses.csv"
    path.write_bytes(path.read_bytes() + "\n".join(["", "  ", *bad, ""]).encode())
    with pytest.raises(MalformedRows, match="4 rows"):
        ingest_table(lake, folder, "diagnoses")
    counts = ingest_table(lake, folder, "diagnoses", on_malformed="keep")
    assert counts == {"files": 1, "headers": 1, "loaded": 50, "refused": 4} and stored(lake) == sorted(good)
    refused = refused_rows(lake, "diagnoses").collect()
    assert sorted(r.record for r in refused) == sorted(bad) and {r.reason for r in refused} == {"number of fields"}
    # a clean load replaces the refused rows too
    landing_file(tmp_path, good)
    ingest_table(lake, folder, "diagnoses")
    assert refused_rows(lake, "diagnoses").count() == 0
    with pytest.raises(ValueError):
        ingest_table(lake, folder, "diagnoses", on_malformed="drop")


def test_headers(lake, tmp_path):
    landing_file(tmp_path, [("1", "a", "b")], header="diagnosis_code,other,chapter")
    with pytest.raises(WrongHeader):
        ingest_table(lake, str(tmp_path), "diagnoses", on_malformed="keep")
    landing_file(tmp_path, [])
    assert ingest_table(lake, str(tmp_path), "diagnoses")["loaded"] == 0
    assert lake.read("raw", "diagnoses").columns == RAW_COLUMNS["diagnoses"] and stored(lake) == []


def test_a_folder_of_files(spark, lake, tmp_path):
    rows = broken_rows(300, seed=4)
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS["diagnoses"]))
    write_text_csv(df.repartition(3), str(tmp_path / "diagnoses.csv"))
    counts = ingest_table(lake, str(tmp_path), "diagnoses")
    assert counts["files"] == counts["headers"] == 3 and stored(lake) == sorted(rows)


def test_audit_of_a_damaged_landing_folder(claims, lake, tmp_path):
    write_landing(claims, tmp_path)
    p = tmp_path / "members.csv"
    p.write_text(p.read_text() + "M-bad,1\n")
    audit = {r.table_name: r for r in ingest_all(lake, str(tmp_path), on_malformed="keep").collect()}
    n = claims.raw["members"].count()
    assert (audit["members"].rows_read, audit["members"].row_count, audit["members"].rows_refused) == (n + 1, n, 1)
    assert set(audit) == set(RAW_TABLES) and sum(r.rows_refused for r in audit.values()) == 1
    assert lake.read("raw", "members").agg(F.count("*")).first()[0] == n
