"""Versions from snapshots, and the version of a time, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from medledger.operators.history import as_of_last, overlaps, versions_of

OPEN = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


def plain_versions(rows, dates):
    """(key, value, from, to) of (key, value, taken) rows, one a key and snapshot."""
    shown = {(k, t): v for k, v, t in rows}
    out = []
    for key in {k for k, _, _ in rows}:
        now = None
        for n, t in enumerate(dates):
            v = shown.get((key, t), KeyError)
            if now is not None and v != now[1]:
                out.append((key, now[1], now[2], t))
                now = None
            if now is None and v is not KeyError:
                now = (key, v, t)
        if now is not None:
            out.append((*now, OPEN))
    return sorted(out, key=str)


def test_versions_against_a_walk(spark):
    r = random.Random(1)
    dates = [day(30 * n) for n in range(6)]
    rows = [(f"k{k}", r.choice(["a", "b", None]), t) for k in range(60) for t in dates if r.random() < 0.8]
    df = spark.createDataFrame(rows, "k string, v string, taken date").repartition(5)
    got = versions_of(df, "k", "taken")
    assert got.columns == ["k", "v", "valid_from", "valid_to", "is_current"]
    assert sorted((tuple(x)[:4] for x in got.collect()), key=str) == plain_versions(rows, dates)
    assert got.filter("is_current <> (valid_to = DATE'9999-12-31')").count() == 0 and overlaps(got, "k").count() == 0


def test_gaps_repeats_and_nulls(spark):
    rows = [("a", "x", 0), ("a", "x", 2), ("b", "x", 0), ("b", "x", 0), ("b", "y", 1), ("b", "x", 2), (None, "x", 1), ("c", None, 1)]
    df = spark.createDataFrame([(k, v, day(n)) for k, v, n in rows], "k string, v string, taken date")
    got = sorted((tuple(x)[:4] for x in versions_of(df, "k", "taken").collect()), key=str)
    assert got == sorted([
        ("a", "x", day(0), day(1)), ("a", "x", day(2), OPEN), ("b", "x", day(0), day(1)), ("b", "y", day(1), day(2)),
        ("b", "x", day(2), OPEN), ("c", None, day(1), day(2))], key=str)
    assert versions_of(df.limit(0), "k", "taken").count() == 0
    only = versions_of(df.withColumn("extra", F.rand()), "k", "taken", tracked=["v"])
    assert sorted((tuple(x)[:4] for x in only.collect()), key=str) == got


def test_overlaps_are_found(spark):
    rows = [("a", day(0), day(5)), ("a", day(4), OPEN), ("b", day(0), day(5)), ("b", day(5), OPEN)]
    found = overlaps(spark.createDataFrame(rows, "k string, valid_from date, valid_to date"), "k").collect()
    assert [(r.k, r.valid_from, r.next_from) for r in found] == [("a", day(0), day(4))]


@pytest.mark.parametrize("hot", [False, True])
def test_as_of_against_brute_force(spark, hot):
    """Gaps, a key with many versions, and a key with a third of all facts."""
    r = random.Random(2)
    versions, facts = [], []
    for k in range(30):
        at = 0
        for v in range(400 if k == 0 else 5):
            end = at + r.randint(1, 40)
            if r.random() < 0.8:
                versions.append((f"k{k}", f"v{v}", day(at), day(end)))
            at = end
    versions.append(("k29", "last", day(900), OPEN))
    for i in range(3000):
        key = "k0" if hot and i % 3 == 0 else r.choice([f"k{r.randrange(32)}", None] if i % 50 == 0 else [f"k{r.randrange(32)}"])
        facts.append((i, key, day(r.randint(-5, 1000)) if i % 77 else None))
    facts += [facts[5]] * 3
    f = spark.createDataFrame(facts, "id int, k string, at date").repartition(4)
    v = spark.createDataFrame(versions, "k string, v string, valid_from date, valid_to date")
    got = as_of_last(f, v.withColumn("id", F.lit(1)), "k", "at", ["v"])
    assert got.columns == ["id", "k", "at", "v"]
    want = [
        (i, k, t, next((x for kk, x, a, b in versions if kk == k and t is not None and a <= t < b), None)) for i, k, t in facts
    ]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_a_hot_key_is_dealt_out(spark):
    facts = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id)) AS k", "date'2025-06-01' AS at")
    v = spark.sql("SELECT 'hot' AS k, 'v' AS v, date'2025-01-01' AS valid_from, date'9999-12-31' AS valid_to")
    df = as_of_last(facts, v, "k", "at", ["v"])
    assert df.filter("v = 'v'").count() == 10_000 and df.count() == 30_000
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "_salt" in plan.split("hashpartitioning(_key")[1][:80]
