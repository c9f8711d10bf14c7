import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from medledger.llm import quantised, queries, topk
from medledger.llm.blocks import BlockLabels

ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1), (904, [1.0] * 15 + [None], 1),
    (905, [float("inf")] + [0.0] * 15, 1), (906, [1.0, 2.0], 1), (907, [1.0, 2.0], 1), (908, [1e300] * 16, 1), (909, [1e-300] * 16, 1),
]


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(1)
    centre = r.normal(size=(40, 16))
    found = [(int(k), (centre[k % 40] + 0.06 * r.normal(size=16)).tolist(), 0) for k in range(400)]
    found += [(400 + k, found[3][1], 0) for k in range(60)]  # copies
    found += [(500 + k, r.normal(size=16).tolist(), 0) for k in range(200)]
    return found


def table(spark, rows):
    names = "vec_id long, embedding array<double>, label int, id string, v int, dim int, fit int, n int"
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], names).repartition(3)


@pytest.mark.parametrize("block", [2048, 16])
def test_near_duplicates_against_brute_force(spark, rows, block):
    found = quantised.near_duplicate_vectors(table(spark, rows + ODD), lists=8, words=16, block=block, cosine=0.95)
    got = {r.vec_id: r for r in found.collect()}
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    ids = np.array([i for i, _, _ in rows])
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], 1 << 40).min(axis=1))
        if (new == label).all():
            break
        label = new
    near_one = {908, 909}  # these two point the same way, and at none of the rest by more than 0.95
    assert (np.abs(x @ (np.ones(16) / 4)) < 0.95).all()
    for i, n, c in zip(ids.tolist(), linked.sum(axis=1).tolist(), label.tolist(), strict=True):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, c, i == c)
    for i, _, _ in ODD:
        pair = {908: 909, 909: 908, 906: 907, 907: 906}.get(i)
        assert got[i].n_links == (pair is not None)
        assert got[i].component_id == (min(i, pair) if pair else i)
    assert near_one <= set(got) and len(got) == len(rows) + len(ODD)


def test_no_vectors(spark, rows):
    none = table(spark, rows).limit(0)
    assert quantised.near_duplicate_vectors(none).collect() == []
    assert topk.top_k(none, F.col("vec_id") % 50 == 0).collect() == []


def test_probes_are_sufficient():
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = quantised.Quantiser(x, 12, 4, 16)
    reach = 0.4
    own = quantised.squared(x, q.centres).argmin(axis=1)
    near = np.sqrt(quantised.squared(x, x)) <= reach
    probes = q.probes(x, reach)
    assert all(probes[i, own[j]] for i, j in zip(*np.nonzero(near), strict=True))
    assert not probes.all()


def test_block_labels_tell_the_components():
    r = np.random.default_rng(3)
    members, guests = np.arange(40), np.arange(100, 160)
    linked = r.random((60, 40)) < 0.02
    labels = BlockLabels(members)
    pairs = [labels.link(guests[a : a + 7], linked[a : a + 7]) for a in range(0, 60, 7)]
    told = np.concatenate(pairs)

    def components(edges):
        label = {int(i): int(i) for i in [*members, *guests]}
        for _ in range(200):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label

    direct = [(int(guests[i]), int(members[j])) for i, j in zip(*np.nonzero(linked), strict=True)]
    assert components([tuple(map(int, p)) for p in told]) == components(direct)
    assert len(told) <= 60 + 40


def test_top_k_against_brute_force(spark, rows):
    every = [*rows, *ODD[:8], (13, rows[20][1], 0), (None, rows[0][1], 0)]
    got = {}
    for r in topk.top_k(table(spark, every), F.col("vec_id") % 50 == 0, query_block=5, candidate_block=64).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in every if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    for i, q in whole:
        if i % 50:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i and len(v) == len(q))
        assert [(s, v) for _, v, s in sorted(got[i])] == [(-s, j) for s, j in scores[:5]]
    assert set(got) == {i for i, _ in whole if i % 50 == 0}


def test_top_k_with_huge_components(spark):
    big = [(0, [1e12, -3.0]), (1, [2e12, 1.0]), (2, [-1e12, 5.0]), (3, [1e12, 1e12])]
    rows = topk.top_k(table(spark, [(*b, 0) for b in big]), F.col("vec_id") == 0, k=2).orderBy("rank").collect()
    assert [(r.vec_id) for r in rows] == [1, 3] and all(r.score == (1 << 63) - 1 or r.score > 0 for r in rows)


def test_bounds_hold():
    r = np.random.default_rng(4)
    x, q = np.floor(256 * r.normal(size=(300, 20))), np.floor(256 * r.normal(size=(5, 20)))
    for n in (1, 2, 4, 8, 16):
        (m, s), (a, b) = topk.segment_statistics(x, n), topk.segment_statistics(q, n)
        for k in range(5):
            lower = ((m - a[k]) ** 2).sum(axis=1) + ((s - b[k]) ** 2).sum(axis=1)
            assert (lower <= ((x - q[k]) ** 2).sum(axis=1) + 1e-6).all()


def test_index_scores_few_and_finds_the_best():
    """Without any structure in the rows, what is scored exactly is the small part; ties and own rows as agreed."""
    r = np.random.default_rng(5)
    x = r.normal(size=(3000, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    x[2990:] = x[40]
    ids = r.permutation(3000) - 1000
    index = topk.SegmentIndex(ids, x)
    asked, found, scores = index.best(x[:100], ids[:100], 5)
    assert index.scored < 0.15 * 100 * len(x)
    for q in range(100):
        truth = sorted((-s, i) for i, s in zip(ids.tolist(), (x @ x[q]).tolist(), strict=True) if i != ids[q])[:5]
        assert truth == [(-s, i) for s, i in zip(scores[asked == q].tolist(), found[asked == q].tolist(), strict=True)]


@pytest.mark.parametrize("n, dim", [(1, 1), (3, 1), (4, 2), (7, 3), (30, 5)])
def test_index_of_few_rows(n, dim):
    x = np.floor(9 * np.random.default_rng(n).normal(size=(n, dim)))
    asked, found, scores = topk.SegmentIndex(np.arange(n), x).best(x, np.arange(n), 5)
    for q in range(n):
        truth = sorted((-s, i) for i, s in enumerate((x @ x[q]).tolist()) if i != q)[:5]
        assert truth == [(-s, i) for s, i in zip(scores[asked == q].tolist(), found[asked == q].tolist(), strict=True)]


def test_meetings_are_not_merged_into_one_task(spark, rows):
    plan = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op3_quantised_duplicates(spark, sf).collect()}
    rows = queries.read_table(spark, sf, "embeddings").collect()
    x = np.array([r.embedding for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    assert [got[r.vec_id][0] for r in rows] == (linked.sum(axis=1) - 1).tolist()


def test_two_vectors_under_one_id(spark):
    """Each row is a vector of its own: its links are not mixed with those of its namesake."""
    a, b, far = [1.0, 0.01, 0.0], [0.0, 0.01, 1.0], [0.0, 1.0, 0.0]
    rows = [(1, a, 0), (1, b, 0), (2, [1.0, 0.0, 0.0], 0), (3, [0.0, 0.0, 1.0], 0), (4, far, 0), (4, far, 0)]
    found = quantised.near_duplicate_vectors(table(spark, rows), lists=4, subspaces=1, words=4).collect()
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in found)
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (4, 1, 4)]
