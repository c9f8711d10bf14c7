import datetime as dt

import pytest
from pyspark.sql import functions as F

from medledger.functions import (
    age_in_years,
    ageing_bucket,
    canonical_city,
    date_key,
    date_of_key,
    mean_of,
    parse_date,
    parse_number,
    ratio,
    register_sql_functions,
    surrogate_key,
)

DATES = [
    ("2025-03-09", dt.date(2025, 3, 9)),
    ("2025-03-09 10:11:12", dt.date(2025, 3, 9)),
    ("2025-03-09T10:11:12Z", dt.date(2025, 3, 9)),
    ("2025-03-09garbage", dt.date(2025, 3, 9)),
    ("09/03/2025", dt.date(2025, 3, 9)),
    ("09-03-2025", dt.date(2025, 3, 9)),
    ("29/02/2024", dt.date(2024, 2, 29)),
    ("31/02/2025", None),
    ("2025-02-30", None),
    ("09/03-2025", None),
    ("09/03/2025 ", None),
    ("9/3/2025", None),
    ("2025-3-9", None),
    ("2025-03-9 ", None),
    ("2025-03-9", None),
    ("03/2025", None),
    ("ab/cd/efgh", None),
    ("2025/03/09", None),
    ("20250309", None),
    (" 025-03-09", None),
    ("+025-03-09", None),
    ("", None),
    (None, None),
]


def test_parse_date_and_its_sql_form(spark, frame):
    register_sql_functions(spark)
    df = frame("s", [(s,) for s, _ in DATES]).select("s", parse_date("s").alias("a"), F.expr("parse_claim_date(s)").alias("b"))
    for (s, want), r in zip(DATES, df.collect()):
        assert (r.a, r.b) == (want, want), s


@pytest.mark.parametrize("raw,want", [
    ("karachi ", "Karachi"), ("LAHORE", "Lahore"), ("al-shifa", "Al-Shifa"), ("new  york", "New  York"),
    ("o'neil d1st", "O'Neil D1st"), ("nation_3", "Nation_3"), ("3rd town", "3rd Town"), ("", ""), ("  ", ""),
    ("émile zola", "Émile Zola"), ("\tx", "\tX"),
])
def test_canonical_city(frame, raw, want):
    assert frame("c", [(raw,)]).select(canonical_city("c")).first()[0] == want


def test_numbers_never_raise(frame):
    got = [r[0] for r in frame("n", [("",), ("1.50",), ("abc",), (None,), ("-3",)]).select(parse_number("n")).collect()]
    assert [None if g is None else float(g) for g in got] == [None, 1.5, None, None, -3.0]


def test_surrogate_key_marks_nulls(spark):
    import hashlib

    df = spark.sql("SELECT 'A' AS a, CAST(NULL AS DATE) AS d, DATE'2024-01-02' AS e")
    r = df.select(surrogate_key("a", "d").alias("x"), surrogate_key("a", "e").alias("y")).first()
    assert r.x == hashlib.md5(b"A|_null_").hexdigest()
    assert r.y == hashlib.md5(b"A|2024-01-02").hexdigest()


def test_date_key_round_trip(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2023-12-30', DATE'2024-03-02')) AS d")
    out = df.select("d", date_key("d").alias("k")).withColumn("back", date_of_key("k"))
    assert out.filter("d != back").count() == 0
    assert out.orderBy("d").first().k == 20231230


def test_age_truncates_multiples_of_365(spark):
    df = spark.sql("SELECT date_sub(DATE'2026-06-30', n) AS b FROM VALUES (0), (364), (365), (43800), (44164), (44165), (-1) t(n)")
    assert [r[0] for r in df.select(age_in_years("b", "2026-06-30")).collect()] == [0, 0, 1, 120, 120, 121, 0]


def test_ratio_is_null_over_zero(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2), (1, 0), (1, -2), (CAST(NULL AS INT), 2) t(a, b)")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [0.5, None, None, None]
    assert [r[0] for r in df.select(ratio("a", "b", positive=False)).collect()] == [0.5, None, -0.5, None]
    assert df.filter("a > 5").agg(mean_of("a")).first()[0] is None


def test_ageing_buckets(spark):
    df = spark.sql("SELECT * FROM VALUES (-4), (30), (31), (60), (61), (90), (91) t(d)")
    assert [r[0] for r in df.select(ageing_bucket("d")).collect()] == [
        "0-30", "0-30", "31-60", "31-60", "61-90", "61-90", "90+"]
