"""Ranked search against a plain version that scores every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from medledger.llm import ranked

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LETTERS))


def plain(docs, items, k=10):
    """{item_id: [(doc_id, score)]} of (id, text) rows."""
    cut = [(i, Counter(terms_of(t))) for i, t in docs]
    cut = [(i, c, sum(c.values())) for i, c in cut if c]
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms_of(text))
    big_n, big_l = len(cut), sum(n for _, _, n in cut)
    df = Counter(t for _, c, _ in cut for t in c)
    w = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = {}
    for item, wanted in asked.items():
        scored = []
        for doc, c, n in cut:
            m = 25 + 75 * n * big_n // big_l
            score = sum(q * w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in wanted.items() if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        if scored:
            out[item] = [(doc, -s) for s, _, _, doc in sorted(scored, key=lambda x: x[:3])[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out.setdefault(r.item_id, [])) + 1
        out[r.item_id].append((r.doc_id, r.score))
    return out


def test_terms():
    assert [w.decode() for ws in ranked.term_slices("Él DIJO: ÉL-no 3x_y\x7f\x00a™b") for w in ws] == terms_of(
        "Él DIJO: ÉL-no 3x_y\x7f\x00a™b"
    )
    long = "ab CD " * 700_000
    assert sum(len(ws) for ws in ranked.term_slices(long)) == 1_400_000


def test_odd_documents(spark, docs, no_docs, texts):
    items = [(1, "the river lantern"), (1, "the THE sturdy"), (2, None), (3, ""), (4, "zzz unknown"), (5, "no id here"),
             (None, "niño 中文 more"), (6, "x" * 5000 + " of of on"), (7, "tion " * 50)]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as score", "2 as term", "3 as n")
    want = plain(texts, items)
    assert found(ranked.ranked_documents(docs, table)) == want and set(want) == {1, 5, None, 6, 7}
    small = ranked.ranked_documents(docs, table, block=8, width=4, most_postings=20, most_query_terms=4)
    assert found(small) == want
    assert ranked.ranked_documents(no_docs, table).collect() == []
    assert ranked.ranked_documents(docs, table.limit(0)).collect() == []


def test_ties_and_a_hot_document(spark):
    rows = [(i, "same words in each") for i in range(300, 0, -1)] + [(0, "other words"), (500, "in " * 4000), (501, "each one")]
    rows += [(7, "same words in each")] * 2
    items = [(1, "same words"), (2, "in"), (3, "one each")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    table = spark.createDataFrame(items, "item_id long, text string")
    assert found(ranked.ranked_documents(docs, table, width=16)) == plain(rows, items)


def test_a_walk_skips(spark):
    """With a bar from rare terms, most documents of the long lists are never scored; the result stays exact."""
    r = random.Random(1)
    common = [f"c{k}" for k in range(12)]
    rows = [(i, " ".join(r.choices(common, k=r.randint(4, 60)))) for i in range(6000)]
    rows += [(6000 + i, " ".join(r.choices(common, k=9)) + f" rare{i % 7} rare{i % 5}") for i in range(60)]
    r.shuffle(rows)
    terms = sorted({t for _, x in rows for t in terms_of(x)})
    number = {t: k for k, t in enumerate(terms)}
    counted = [Counter(number[t] for t in terms_of(x)) for _, x in rows]
    df = Counter(t for c in counted for t in c)
    n = np.array([sum(c.values()) for c in counted])
    weights = np.array([ranked.weight(len(rows), df[t]) for t in range(len(terms))])
    flat = [np.array([x for c in counted for x in sorted(c)]), np.array([c[x] for c in counted for x in sorted(c)])]
    sizes = np.array([len(c) for c in counted])
    ids = np.array([i for i, _ in rows])
    block = ranked.Block(ids, n, *flat, sizes, weights, len(rows), int(n.sum()), 128, 100)
    assert len(block.long) == 12
    for text in ("c1 rare3 c2 rare4", "c5 rare1", "c3 c4 c5", "rare2"):
        best, before = ranked.Best(10), block.scored
        wanted = Counter(number[t] for t in text.split())
        block.search(np.array(sorted(wanted)), np.array([wanted[t] for t in sorted(wanted)]), best)
        assert list(zip(best.ids.tolist(), best.scores.tolist(), strict=True)) == plain(rows, [(0, text)])[0]
        if "c" in text and "rare" in text:
            assert block.scored - before < 600 and not block.sums.any()
