"""The filter audit against a plain run of every order, and its carry-save counts against plain counts."""

import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np

from medledger.llm import audit


def plain(docs, labels):
    """{(part, order, step): counts} of (doc_id, text, source) and (doc_id, quality, toxic) rows."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and t in first and i > first[t]:
            fails.add("E")
        failed[s or ""].append((fails, i in good, i in toxic))
    out, shapley = {}, defaultdict(int)
    for part, rows in failed.items():
        for order in permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                failing = sum(x in r[0] for r in rows)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(r[0] == {x} for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
                shapley[part, x] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in df.collect()
    }


def test_carry_save_counts():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 7, 100, 4097):
        words = r.integers(0, 1 << 32, n, dtype=np.uint32)
        want = [int(((words >> s) & 1).sum()) for s in range(32)]
        assert audit.positional_counts(words).tolist() == want
    assert audit.positional_counts(np.full(10_000, 0xFFFFFFFF, dtype=np.uint32)).tolist() == [10_000] * 32


def test_words_are_truth_tables():
    assert audit.WORDS[0] == 0xFFFFFFFF and audit.WORDS[31] == 1
    for failed in range(32):
        for subset in range(32):
            assert bool(audit.WORDS[failed] >> subset & 1) == (failed & subset == 0)


def test_failures_of_a_very_long_text():
    text = "Ab cd " * 600_000
    assert audit.failures(text) == 0b0110 and audit.failures(text + "|") == 0b1110


def test_odd_documents(spark, texts):
    r = random.Random(3)
    rows = [(i, t, r.choice(["s1", "s2", "", None])) for i, t in texts]
    for k in range(30):
        extra = r.choice(["", "", "#", " ABCDEFGHIJKLMNOPQRSTUVW" * 9])
        rows.append((100 + k, " ".join(f"w{k}x{j}" for j in range(60)) + extra, "s1"))
    rows += [(200 + k, rows[40 + k % 7][1], r.choice(["s1", "s3"])) for k in range(40)]
    rows += [(201, rows[40][1], "s3"), (40, "x", "s3"), (None, rows[40][1], "s3"), (None, None, None)]
    known = [5, 20, 101, 102, 203, 204, 999, None, *range(100, 240)]
    labels = [(r.choice(known), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(90)]
    names = "doc_id long, text string, source string"
    docs = spark.createDataFrame(rows, names).selectExpr("*", "1 as part", "2 as good", "3 as word", "4 as digest").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "true as good", "1 as n")
    got = found(audit.filter_audit(docs, marks))
    assert got == plain(rows, labels) and len(got) == 4 * 600
    words = audit.survival_words(docs, marks)
    few = audit.subset_survivors(words.repartition(1), together=10, most_parts=2)
    assert found(audit.order_audit(few)) == got
    assert {k: v[4:6] for k, v in found(audit.filter_audit(docs, marks.limit(0))).items()} == dict.fromkeys(got, (0, 0))
    assert audit.filter_audit(docs.limit(0), marks).collect() == []


def test_a_hot_text_and_a_hot_source(spark):
    rows = [(i, "same text", "hot") for i in range(400)] + [(1000 + i, f"text {i}", f"s{i % 3}") for i in range(100)]
    labels = [(i, 1, i % 2) for i in range(0, 1100, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = found(audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert got == plain(rows, labels)
    assert got["hot", "EABCD", 1][:2] == (1, 399)
