"""Byte-level BPE on a serialised sentencepiece model, against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
from medledger.llm import sentencebpe
from medledger.llm.sentencebpe import RankDecoder, RankEncoder, as_bytes, as_letters, default_ranks, read_ranks
from tests.llm.test_tokens import random_texts


@pytest.fixture(scope="module")
def library():
    tokens = read_ranks(default_ranks())
    ranks = {t: k for k, t in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return RankEncoder(default_ranks())


def test_letters_are_invertible():
    assert as_bytes(as_letters(bytes(range(256)))) == bytes(range(256))
    assert not any(c.isspace() for c in as_letters(bytes(range(256))))


def test_the_model_file_is_what_it_says(own):
    pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    tokens = read_ranks(default_ranks())
    model = pb2.ModelProto.FromString(sentencebpe.serialised_model(tokens))
    assert len(model.pieces) == len(tokens) + 1 and model.trainer_spec.model_type == 2
    assert [as_bytes(p.piece) for p in model.pieces[:-1]] == tokens
    assert [-p.score for p in model.pieces[:-1]] == list(range(len(tokens)))
    assert model.normalizer_spec.name == "identity" and not model.normalizer_spec.add_dummy_prefix
    assert not model.normalizer_spec.remove_extra_whitespaces and not model.normalizer_spec.escape_whitespaces
    assert own.model.unk_id() == len(tokens) and own.model.bos_id() == own.model.eos_id() == -1


def test_texts_equal_the_library(own, library):
    texts = random_texts(800, seed=5) + ["x" * 3000, "<unk> <|endoftext|> ▁▁ \x00\x01", "a  b   c\n\n d", " lead", "trail "]
    assert [x.tolist() for x in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_every_token_of_the_vocabulary_is_itself(own, library):
    data = RankDecoder(default_ranks()).data
    texts = []
    for token in data:
        try:
            texts.append(token.decode())
        except UnicodeDecodeError:
            continue
    assert [x.tolist() for x in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_a_token_that_no_merge_makes(tmp_path):
    """'abcd' has a rank, but no two tokens of the list join to it: only as a whole pre-token is it itself."""
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abcd", b"bc"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate(tokens)))
    ranks = {t: k for k, t in enumerate(tokens)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = RankEncoder(str(path))
    texts = ["abcd", "abcde", "xabcd abcd", "bcd", "abab", "bcbc abc"]
    assert own.unmerged.keys() == {as_letters(b"abcd")}
    assert [x.tolist() for x in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("bad", [b"YQ== 0\n", b"YQ== 1\n"])
def test_gaps_and_missing_bytes_are_refused(tmp_path, bad):
    path = tmp_path / "bad.tiktoken"
    path.write_bytes(bad)
    with pytest.raises(ValueError):
        read_ranks(str(path))


def test_slices_of_a_long_text_change_nothing(library):
    small = RankEncoder(default_ranks(), slice_of=50)
    for text in random_texts(100, seed=6):
        text = text * 5
        assert "".join(small.slices(text)) == text
        assert small.encode_text(text).tolist() == library.encode_ordinary(text)


def test_any_ids_decode_as_the_library_does(library):
    r, decoder = random.Random(7), RankDecoder(default_ranks())
    for _ in range(50):
        ids = [r.randrange(library.n_vocab) for _ in range(60)]
        assert decoder.decode(np.array(ids), read=7) == library.decode_bytes(ids)
    with pytest.raises(IndexError):
        decoder.decode(np.array([10**6]))


def test_odd_documents(docs, no_docs, texts, library):
    rows = sentencebpe.decode_documents(sentencebpe.encode_documents(docs)).collect()
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in texts)
    got = [(str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in rows]
    assert sorted(got) == want and all(r.n_tokens == len(r.ids) // 4 for r in rows)
    empty = sentencebpe.decode_documents(sentencebpe.encode_documents(no_docs))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_registered_query(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = entry.queries()["op13_serialised_bpe"](spark, sf).collect()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        data = np.array(ids, dtype="<u4").tobytes()
        said = hashlib.sha256(library.decode_bytes(ids)).hexdigest()
        want[r.doc_id] = (len(ids), hashlib.sha256(data).hexdigest(), said)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want
