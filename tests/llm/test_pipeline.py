"""The pipeline against a plain Python version of its stages, and the registered queries."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from medledger.llm import secrets, toxicity
from medledger.llm.common import read_table
from tests.llm.test_simhash import least_reachable, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = read_table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        rows = made.collect()
        found.append((name, docs, made, rows))
        docs = spark.createDataFrame(rows, made.schema)
    return found


def test_stages_keep_the_columns_of_documents(spark, stages):
    columns = read_table(spark, SF, "documents").columns
    assert [s[0] for s in stages] == ["toxicity", "simhash near-dedup", "secret scans", "packing"]
    assert all(s[2].columns == columns for s in stages[:-1])


def test_toxicity_stage(spark, stages):
    _, docs, _, rows = stages[0]
    model = toxicity.fit(docs, read_table(spark, SF, "labels"))
    score = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    assert {r.doc_id for r in rows} == {i for i, s in score.items() if s < 0.7}


def test_near_dedup_stage(stages):
    _, docs, _, rows = stages[1]
    known = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    label = least_reachable(list(known), lambda i, j: (known[i] ^ known[j]).bit_count() <= 3)
    assert sorted(r.doc_id for r in rows) == sorted(i for i, c in label.items() if i == c)


def test_secret_stage(stages):
    _, docs, _, rows = stages[2]
    before = {r.doc_id: r for r in docs.collect()}
    model = secrets.fit(docs)
    spans = dict(zip(before, secrets.all_spans(model, [r.text for r in before.values()]), strict=True))
    assert len(rows) == len(before) and any(spans.values())
    for r in rows:
        old = before[r.doc_id]
        if spans[r.doc_id]:
            assert "[SECRET]" in r.text and r.n_chars == len(r.text)
        else:
            assert r == old


def test_packing_stage_holds_every_document(stages):
    _, docs, _, rows = stages[3]
    total = defaultdict(int)
    for r in rows:
        total[r.doc_id] += r.length
    assert set(total) == {r.doc_id for r in docs.collect()}
    assert all(total[r.doc_id] == r.doc_tokens for r in rows)


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r.doc_id, r.start, r.length, zlib.crc32(r.ids))
    assert sum(key(r)[2] for r in corpus_pipeline.run(spark, SF).collect()) == sum(r.length for r in stages[3][3])


def test_odd_documents_pass_through(spark, docs, no_docs, texts, tmp_path):
    names = read_table(spark, SF, "documents").columns
    for table, n in ((docs.select(*names, "score", "ids"), None), (no_docs.select(names), 0)):
        rest = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, rest, SF)
            assert made.columns == rest.columns
            rest = spark.createDataFrame(made.collect(), made.schema)
        rows = rest.collect()
        pieces = corpus_pipeline.pack(spark, rest, SF).collect()
        if n == 0:
            assert rows == pieces == []
        else:
            kept = [r.doc_id for r in rows]
            assert kept.count(5) == 1 and 23 not in kept and 20 in kept and None in kept
            assert {p.doc_id for p in pieces} == set(kept)


def test_near_dedup_stage_on_repeats_and_clashing_names(spark):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(3, text, 7, 1), (3, text, 8, 2), (3, "another text altogether", 9, 3), (5, text, 1, 4), (None, text, 1, 5)]
    rows += [(6, None, 1, 6), (4, "", 1, 7), (9, "alone", 1, 8), (9, "alone", 1, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, c0 int")
    made = corpus_pipeline.keep_one_of_each_group(spark, docs.repartition(3), SF)
    assert made.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in made.collect())
    assert got == sorted([("3", text), ("3", "another text altogether"), ("4", ""), ("9", "alone"), ("None", text)])
    hidden = docs.select("doc_id", "text", F.col("_row").alias("_id"), F.col("c0").alias("_text"))
    assert corpus_pipeline.keep_one_of_each_group(spark, hidden, SF).count() == 5


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
