import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from medledger.llm import simhash
from medledger.llm.common import components


def plain_fingerprint(text):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(ids, linked):
    label = {i: i for i in ids}
    while True:
        new = {i: min([label[i], *(label[j] for j in ids if linked(i, j))]) for i in ids}
        if new == label:
            return label
        label = new


def test_fingerprints_and_components(docs, no_docs, texts):
    rows = simhash.near_duplicates(docs).collect()
    want = {(i, plain_fingerprint(t)) for i, t in texts}
    assert {(r.doc_id, r.fp & (1 << 64) - 1) for r in rows} == want and len(rows) == len(texts)
    known = {i: f for i, f in want if i is not None}
    label = least_reachable(list(known), lambda i, j: (known[i] ^ known[j]).bit_count() <= 3)
    assert all(r.component_id == label[r.doc_id] for r in rows if r.doc_id is not None)
    assert label[23] == 7 and label[21] == label[22] == 20  # a copy; texts without words
    assert simhash.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize(("block", "distance"), [(2048, 3), (40, 3), (40, 2), (25, 5)])
def test_links_against_brute_force(spark, block, distance):
    r = random.Random(7)
    found = set()
    for c in range(12):
        base = r.getrandbits(64)
        for _ in range(120 if c == 0 else 20):
            x = base
            for _ in range(r.randint(0, 3 if c == 0 else 8)):
                x ^= 1 << r.randrange(64)
            found.add(int(np.uint64(x).view(np.int64)))
    ids = sorted(found)
    table = spark.createDataFrame([(i,) for i in ids], "fp long")
    links = simhash.links_within(table, distance=distance, block=block)
    got = {x.id: x.component_id for x in components(table.select(F.col("fp").alias("id")), links).collect()}
    bits = np.array(ids, dtype=np.int64)
    near = np.bitwise_count((bits[:, None] ^ bits[None, :]).view(np.uint64)) <= distance
    label = bits.copy()
    while True:
        new = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == label).all():
            break
        label = new
    assert got == dict(zip(ids, label.tolist(), strict=True))


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(8).shuffle(order)
    links = spark.createDataFrame([*zip(order, order[1:], strict=False), (None, 3), (5, 5)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in [*range(n + 2), None]], "id long")
    rows = components(nodes, links).collect()
    assert {r.id: r.component_id for r in rows} == {i: 0 if i < n else i for i in range(n + 2)}
