"""Packing, matrices and the BPE transducer against the tokenizers library and exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from medledger.llm import bpe, matrices, packing
from medledger.llm.token_ids import TextEncoder, default_tokenizer

TRICKY = ["a", "e", "th", " ", "  ", "\n", "\t", "'s", "'", "é", "ß", "中", "🙂", "1", "½", "-", "----", "_", " ", "\x1c", "\x85", "\xa0", "AAAA", "<|endoftext|>", "\r\n", ". "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(default_tokenizer())


def random_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choices(TRICKY, k=r.randint(0, 60))) for _ in range(n)]


def test_both_encoders_equal_the_library(library, own):
    texts = random_texts(600)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == want
    assert [x.tolist() for x in TextEncoder(default_tokenizer()).encode(texts)] == want


def test_transducer_needs_no_more_than_its_lookahead(library, own):
    r = random.Random(2)
    for parts in (["a", "an", "the", "ing", "ation", "er", "zz"], ["-", "=", "*", "--"]):
        text = "".join(r.choices(parts, k=3000))
        want = library.encode(text, add_special_tokens=False).ids
        for read in (1, 7, 300):
            machine = bpe.Transducer(own.merges, read=read)
            got, most = [], 0
            for at in range(0, len(text), 500):
                got += list(machine.feed(text[at : at + 500].encode(), last=at + 500 >= len(text)))
                most = max(most, len(machine.held))
            assert got == want
            assert most <= own.merges.lookahead + 128  # what is held back is bounded


def test_lookahead_of_a_small_list_is_needed():
    # a+b, b+c earlier: "ab" can still lose its b to a c that follows, and nothing else can happen
    assert bpe.sufficient_lookahead([(1, 1, 2, 10), (1, 0, 1, 11)]) == 2
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(2, 10, 2, 11), (1, 0, 1, 10)])


def test_merges_together_equal_merges_alone(own):
    r = random.Random(3)
    words = ["".join(r.choices("thaeioning", k=9)).encode() for _ in range(200)]
    got = bpe.merged_together(own.merges, words)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [bpe.merged(own.merges, w) for w in words]


def test_byte_machine_equals_the_library(library, own):
    r = random.Random(4)
    for _ in range(100):
        ids = [r.randrange(50257) for _ in range(40)]
        machine = bpe.ByteToText()
        got = "".join(machine.feed(own.merges.text[i]) for i in ids) + machine.close()
        assert got == library.decode(ids, skip_special_tokens=False)


def test_encode_and_decode_documents(docs, no_docs, texts, library):
    rows = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in texts)
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in rows)
    assert bpe.decode_documents(bpe.encode_documents(no_docs)).collect() == []


def documents_of(library, texts):
    """Each id's token lists, with the end id."""
    found = defaultdict(list)
    for i, t in texts:
        found[i].append([*library.encode(t or "", add_special_tokens=False).ids, 1])
    return found


def test_packed_pieces_hold_each_id_once(docs, no_docs, texts, library):
    rows = packing.pack_documents(docs, capacity=256, most_open=4).collect()
    assert packing.pack_documents(no_docs).collect() == []
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length * 4 == len(r.ids)
        windows[r.sequence_id].append(r)
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 256 or at < 256 and at & (at - 1) == 0
    for i, want in documents_of(library, texts).items():
        got = sorted(pieces[i])
        assert sum(len(b) for _, b, _ in got) == sum(4 * len(x) for x in want)
        if len(want) == 1:
            assert np.frombuffer(b"".join(b for _, b, _ in got), "<u4").tolist() == want[0]
            assert {n for _, _, n in got} == {len(want[0])}


@pytest.mark.parametrize(("capacity", "most_open"), [(64, 8), (64, 1000), (16, 3)])
def test_sum_of_squares(capacity, most_open):
    r = random.Random(5)
    packer, docs, out = packing.SumOfSquares(capacity, most_open), {}, []
    for d in range(300):
        ids = np.arange(r.choice([1, 2, 5, 9, capacity - 1, capacity, 3 * capacity + 7]), dtype="<u4")
        docs[d] = len(ids)
        for start in range(0, len(ids), capacity):
            level = packer.level_for(len(ids[start : start + capacity])) if len(ids) - start < capacity else 0
            size = len(ids[start : start + capacity])
            if size < capacity:  # brute force: the least sum of squares afterwards
                def after(h, size=size):
                    n = packer.levels.copy()
                    n[h] -= h > 0
                    if h + size < capacity:
                        n[h + size] += 1
                    return int((n[1:capacity] ** 2).sum())

                allowed = [h for h in range(capacity - size + 1) if h == 0 or packer.levels[h]]
                assert after(level) == min(map(after, allowed))
            out += list(packer.add((d, start, ids[start : start + capacity], len(ids))))
            assert packer.n_open <= most_open + 1
    out += list(packer.close())
    assert sum(len(p[2]) for w in out for p in w) == sum(docs.values())
    sizes = [sum(len(p[2]) for p in w) for w in out]
    assert all(s == capacity or s & (s - 1) == 0 for s in sizes)


def test_matrices_round_trip(docs, no_docs, texts, library, tmp_path, spark):
    matrices.write_matrices(matrices.packed_matrices(docs, capacity=512, block_tokens=9000), f"{tmp_path}/m")
    rows = spark.read.parquet(f"{tmp_path}/m").collect()
    assert matrices.packed_matrices(no_docs).collect() == []
    pieces = defaultdict(list)
    for r in rows:
        ids, places = np.frombuffer(r.input_ids, "<u4"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == 512 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens :] == 50256).all() and places[r.n_tokens :].tolist() == list(range(512 - r.n_tokens))
        for a, b, doc, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts, strict=False):
            assert places[a:b].tolist() == list(range(b - a))
            pieces[doc].append((start, ids[a:b].tolist()))
    for i, want in documents_of(library, texts).items():
        got = sorted(pieces[i])
        if len(want) == 1:
            assert [x for _, p in got for x in p] == want[0]
        assert sum(len(p) for _, p in got) == sum(map(len, want))
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_best_fit_takes_the_tightest_row():
    r = random.Random(6)
    sizes = sorted((r.randint(1, 40) for _ in range(300)), reverse=True)
    rooms, want = [], 0
    for s in sizes:  # brute force
        fit = [k for k, room in enumerate(rooms) if room >= s]
        if fit:
            rooms[min(fit, key=lambda k: rooms[k])] -= s
        else:
            rooms.append(40 - s)
    got = list(matrices.best_fit_decreasing([(k, 0, np.zeros(s, "<u4")) for k, s in enumerate(sizes)], 40))
    assert sorted(40 - sum(len(p[2]) for p in row) for row in got) == sorted(rooms)


def test_query_digests(spark, library):
    from medledger.llm import queries

    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in queries.read_table(spark, sf, "documents").collect()}
    for r in queries.op2_sum_of_squares_packing(spark, sf).collect():
        ids = np.array([*want[r.doc_id], 1], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
