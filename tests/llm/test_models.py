"""Toxicity, the hidden Markov model and secret scans: brute force, held-out accuracy and edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from medledger.llm import hmm, queries, secrets, toxicity
from medledger.llm.common import fold_of, read_table

SF = "/root/testdata/sf0.01"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# Toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        words = ["".join(r.choices(["re", "on", "ti", "th", "an", "ou"], k=r.randint(1, 4))) for _ in range(r.randint(20, 200))]
        bad = i % 5 == 0
        for _ in range(max(1, len(words) // 40) if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(["zjerkface", "Zjerkish", "blughead"]))
        rows.append((i, " ".join(words), "x"))
        if i % 4:
            labels.append((i, int(bad), "y"))
    labels += [(None, 1, "y"), (3, None, "y"), (4, 7, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(
        labels, "doc_id long, toxic int, text string"
    )


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    assert b"jerk" in model.toxic and b"blughead" in model.toxic and b"jerk" not in model.ordinary
    rows = toxicity.score_documents(docs, model).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = [(r.score >= 0.7) == (r.doc_id % 5 == 0) for r in held]
    assert len(rows) == 900 and sum(right) / len(right) >= 0.98
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.score < 0.7}


def test_toxicity_edges(docs, no_docs, labelled, texts):
    model = toxicity.fit(*labelled)
    rows = toxicity.score_documents(docs, model).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    empty = {round(r.score, 12) for r in rows if r.doc_id in (20, 21, 22)}
    assert len(empty) == 1 and empty.pop() < 0.7
    assert toxicity.score_documents(no_docs, model).collect() == []
    nothing = toxicity.fit(no_docs, labelled[1])
    assert all(0 < r.score < 0.7 for r in toxicity.score_documents(docs, nothing).collect())
    unlabelled = toxicity.fit(docs, labelled[1].limit(0))
    assert all(r.score == 0 or r.score < 1e-9 for r in toxicity.score_documents(docs, unlabelled).collect())


def test_toxicity_learns_nothing_from_held_out_rows(labelled):
    docs, labels = labelled
    out = fold_of("doc_id", 3) == 1
    turned = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels).weights.tolist() == toxicity.fit(docs, turned).weights.tolist()


def test_toxicity_scores_against_brute_force(labelled):
    """Every window compressed anew, one at a time, without memory or histograms of arrays."""
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    a, b, c = (toxicity.Lengths(x).of for x in (model.ordinary, model.toxic, b""))
    rows = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    for r in docs.filter("doc_id < 40").collect():
        codes = Counter()
        for word in r.text.encode().translate(LOWER).split():
            (x,), (y,), (z,) = (f([b" " + word + b" "]) for f in (a, b, c))
            codes[(max(-8, min(24, x - y)) + 8) * 16 + max(0, min(15, z - y))] += 1
        assert math.isclose(rows[r.doc_id], model.scores(np.array([[codes[k] for k in range(33 * 16)]]))[0], rel_tol=1e-12)


def test_toxicity_hears_small_languages(spark):
    """Precision and recall on held-out rows of the 0.1 tables, and recall by language."""
    sf = "/root/testdata/sf0.1"
    rows = queries.op1_compression_toxicity(spark, sf).filter("held_out").join(read_table(spark, sf, "labels"), "doc_id")
    found = rows.join(read_table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").filter("toxic is not null").collect()
    caught = [r for r in found if r.predicted]
    assert sum(r.toxic for r in caught) >= 0.9 * len(caught)
    assert len([r for r in caught if r.toxic]) >= 0.75 * sum(r.toxic for r in found)
    for lang in ("de", "fr"):
        assert sum(r.predicted for r in found if r.toxic and r.lang == lang) > 0.5 * sum(r.toxic for r in found if r.lang == lang)


def test_long_texts_give_parts_from_end_to_end(spark):
    text = "".join(chr(97 + i * 26 // 100_000) for i in range(100_000))
    rows = spark.createDataFrame([(text,), ("short",), (None,), ("",)], "t string")
    long, short, none, empty = (r[0] for r in rows.select(toxicity.spread(F.col("t"), 6400)).collect())
    assert (short, none, empty) == ("short", None, "") and len(long) == 6400 + 63
    assert long[0] == "a" and long[-1] == "z" and len(set(long)) == 27


# Hidden Markov model


def brute(model, seq, start):
    k, total = len(start), 0.0
    heads, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros_like(model.emit)
    for path in itertools.product(range(k), repeat=len(seq)):
        p = start[path[0]] * model.emit[seq[0], path[0]]
        for i in range(1, len(seq)):
            p *= model.move[path[i - 1], path[i]] * model.emit[seq[i], path[i]]
        total += p
        heads[path[0]] += p
        for i, s in enumerate(path):
            emits[seq[i], s] += p
            if i:
                moves[path[i - 1], s] += p
    return total, heads / total, moves / total, emits / total


def test_recursions_against_all_paths():
    r = np.random.default_rng(0)
    model = hmm.HiddenMarkov.fresh(3, 5, np.ones(5) / 5)
    model.move, model.start, model.middle = r.dirichlet(np.ones(3), 3), r.dirichlet(np.ones(3)), r.dirichlet(np.ones(3))
    seqs = [r.integers(0, 5, n) for n in (1, 4, 3, 5, 1, 6)]
    want = [math.log10(brute(model, s, model.start)[0]) for s in seqs]
    assert np.allclose(model.log10_likelihoods(seqs), want)
    first = np.array([True, True, False, True, False, True])
    found = [brute(model, s, model.start if f else model.middle) for s, f in zip(seqs, first, strict=True)]
    heads = [sum(f[1] for f, h in zip(found, first, strict=True) if h == side) for side in (True, False)]
    counts = np.concatenate([*heads, sum(f[2] for f in found).ravel(), sum(f[3] for f in found).ravel()])
    assert np.allclose(model.expected(seqs, first), counts)


def test_language_model(spark):
    rows = {r.doc_id: r for r in queries.op4_hidden_markov(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()}
    tokens = {i: [*(t or "").encode().translate(LOWER).split(), b" end"] for i, t in texts.items()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    c = Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(ws), sum(w in c for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    assert sum(rows[i].score for i in held) > sum(rows[i].base_score for i in held)


def test_language_model_edges(docs, no_docs, texts):
    small = dict(states=2, rounds=2, frequent=8, shared=8, chunk_bytes=4000, segment=64)
    rows = hmm.score_documents(docs, hmm.held_out(), **small).collect()
    assert len(rows) == len(texts) and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (20, 21, 22)} == {1}
    assert hmm.score_documents(no_docs, hmm.held_out(), **small).collect() == []
    untaught = hmm.score_documents(docs, F.lit(True), **small).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in untaught)


# Secrets


def plain_base(text):
    found = []
    for kind, pattern, group, least in (
        ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18),
        ("hex", r"[0-9a-f]+", 0, 16),
    ):
        order = ("assign", "access", "hex").index(kind)
        found += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def secret_texts():
    r = random.Random(2)
    parts = ["token = ", "PassWord: '", "api_key=", "apikey :", "ſecret=", "AKIA", "deadbeef", "0123456789", "ABCDEF", "x", " ", "é", '"', "=", "token: secret = abcdefghijklmnop ", "🙂"]
    return ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(500)]


def test_base_spans_against_the_plain_patterns():
    for text in secret_texts():
        assert [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in secrets.base_spans(text)] == plain_base(text)


def test_automata_tell_formats_apart():
    r = random.Random(3)
    keys = ["".join(r.choices("0123456789abcdef", k=40)) for _ in range(300)]
    words = ["".join(r.choices(["tion", "en", "be", "schaft"], k=6)) for _ in range(300)]
    model = secrets.FormatModel({"hex": keys[:200]}, words[:200])
    assert (model.ratio(keys[200:]) > model.threshold).all()
    assert (model.ratio(words[200:]) <= model.threshold).mean() > 0.97
    one = model.kinds["hex"]
    letters = secrets.classes_of(keys[0])
    state, want = 0, 0.0
    for c in letters:  # the batch score is the walk through the automaton
        want += one.log[state, c]
        state = one.move[state, c]
    assert math.isclose(one.score(keys[:1])[0], want + one.log[state, secrets.END])
    assert np.allclose(np.exp(one.log).sum(axis=1), 1)


def test_scan_and_redact(spark, docs, no_docs, texts):
    rows = [(k, t, "x", len(t)) for k, t in enumerate(secret_texts())]
    table = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    model = secrets.fit(table)
    found = {r.doc_id: r.spans for r in secrets.scan_secrets(table, model).collect()}
    for k, text, _, _ in rows:
        assert [f"{s.kind}:{s.start}:{s.end}" for s in found[k] if s.kind != "format"] == plain_base(text)
        assert [s.start for s in found[k]] == sorted(s.start for s in found[k])
    clean = secrets.redact(table, model)
    assert clean.columns == table.columns
    for r in clean.collect():
        left = [c for k, c in enumerate(rows[r.doc_id][1]) if not any(x.start <= k < x.end for x in found[r.doc_id])]
        assert r.text.replace("[SECRET]", "") == "".join(left) and r.n_chars == len(r.text)
        assert (r.text == rows[r.doc_id][1]) == (not found[r.doc_id])
    assert len(secrets.scan_secrets(docs, secrets.fit(docs)).collect()) == len(texts)
    assert secrets.scan_secrets(no_docs, secrets.fit(no_docs)).collect() == []


def test_secret_query(spark):
    texts = {r.doc_id: r.text or "" for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()}
    for r in queries.op9_credential_automata(spark, SF).collect():
        want = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(r.spans.split(","))


def test_a_key_that_a_run_covers_in_part_is_a_candidate_as_a_whole():
    text = "see 0123456789abcdef0123ZZTOPkey9 and password=hunter2hunter2hunter2 and 0123456789abcdef01"
    found = secrets.candidates(text, secrets.base_spans(text))
    assert [w for _, _, w in found] == ["0123456789abcdef0123ZZTOPkey9"]


def test_the_sample_is_the_words_of_least_hash(spark):
    words = [f"{k:020d}zz" for k in range(300)]
    docs = spark.createDataFrame([(w,) for w in words], "text string").repartition(7)
    kept = []
    real = secrets.FormatModel
    try:
        secrets.FormatModel = lambda credentials, ordinary: kept.append((credentials, ordinary)) or real(credentials, ordinary)
        secrets.fit(docs, sample=20)
    finally:
        secrets.FormatModel = real
    want = sorted(words, key=lambda w: xxhash.xxh64_intdigest(w, seed=42))[:20]
    credentials, ordinary = kept[0]
    assert ordinary == want and credentials["hex"] == sorted((f"{k:020d}" for k in range(300)), key=lambda w: xxhash.xxh64_intdigest(w, seed=42))[:20]


def test_every_word_counts_for_the_automata(spark):
    r = random.Random(4)
    plain = ["".join(r.choices(["tion", "en", "be", "schaft", "X"], k=r.randint(5, 24))) for _ in range(1500)]
    hexes = ["".join(r.choices("0123456789abcdef", k=r.randint(16, 90))) for _ in range(1200)]
    docs = spark.createDataFrame([(f"{p} {h}",) for p, h in zip(plain, hexes + hexes[:300], strict=True)], "text string")
    ordinary = sorted({w for p in plain for _, _, w in secrets.candidates(p, secrets.base_spans(p))})
    assert len(ordinary) > 1000
    want = secrets.FormatModel({"hex": hexes}, ordinary)
    found = secrets.fit(docs, states=10**9)
    words = hexes[:50] + ordinary[:50] + ["tion" * 40, "0" * 200]
    assert np.allclose(found.ratio(words), want.ratio(words)) and abs(found.threshold - want.threshold) < 2e-6


def test_rare_prefixes_leave_their_count_with_their_parent(spark):
    learnt = spark.createDataFrame([("hex", "ab0")] * 9 + [("hex", "a1")], "kind string, word string")
    assert secrets._prefixes(learnt, {"hex": 10}, 5)["hex"] == {
        "": [0, 10, 0, 0, 0, 0, 0], "1": [1, 9, 0, 0, 0, 0, 0], "11": [9, 0, 0, 0, 0, 0, 0], "110": [0, 0, 0, 0, 0, 0, 9]}
