"""Byte-level BPE by the sentencepiece library, on a model serialised from a vocabulary of ranks."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from medledger.llm.bpe import PRETOKEN
from medledger.llm.token_ids import BREAK, PieceCache

#: A byte b is written as the letter FIRST + b: visible, never white space, two bytes long.
FIRST = 0x100
_LETTERS = {b: FIRST + b for b in range(256)}

#: Field numbers and codes of sentencepiece's model file.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN = 1, 2
_MODEL_TYPE, _VOCAB_SIZE, _UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 3, 4, 40, 41, 42, 43
_BPE = 2
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_ranks(path: str) -> list[bytes]:
    """The bytes of each rank. Ranks count from 0 without a gap, and each of the 256 bytes has one."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    if sorted(found) != list(range(len(found))) or len({t for t in found.values() if len(t) == 1}) != 256:
        raise ValueError("ranks must count from 0 without a gap and name every single byte")
    return [found[k] for k in range(len(found))]


def as_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_LETTERS)


def as_bytes(letters: str) -> bytes:
    """The inverse of as_letters."""
    return bytes(ord(c) - FIRST for c in letters)


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1  # a negative number is written as 64 bits
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def serialised_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model file: piece k is the letters of token k, its score -k, so that the earliest rank is
    merged first and, of equal ones, the leftmost. Text is taken as it is: no prefix, no folding, no escapes. The unknown
    piece that a model must have stands behind the tokens; no letter is unknown."""
    unknown = len(tokens)
    pieces = [
        _block(_PIECE, as_letters(t).encode()) + _varint(_SCORE << 3 | 5) + struct.pack("<f", -k) + _number(_TYPE, _NORMAL)
        for k, t in enumerate(tokens)
    ]
    pieces.append(_block(_PIECE, b"<unk>") + _varint(_SCORE << 3 | 5) + struct.pack("<f", 0.0) + _number(_TYPE, _UNKNOWN))
    trainer = _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, unknown + 1) + _number(_UNK_ID, unknown)
    trainer += b"".join(_number(k, -1) for k in (_BOS_ID, _EOS_ID, _PAD_ID))
    normalizer = _block(_NAME, b"identity") + b"".join(_number(k, 0) for k in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES))
    return b"".join(_block(_PIECES, p) for p in pieces) + _block(_TRAINER, trainer) + _block(_NORMALIZER, normalizer)


class RankEncoder(PieceCache):
    """Ids of texts: each pre-token is encoded by the sentencepiece model; each distinct piece of a text once.

    A pre-token that is itself a token is that token, even if no order of merges leads to it; such tokens are found when
    the model is loaded, by encoding the vocabulary with itself.
    """

    def __init__(self, path: str, slice_of: int = 1 << 20):
        from sentencepiece import SentencePieceProcessor

        super().__init__(marks=[])
        tokens = read_ranks(path)
        self.model = SentencePieceProcessor(model_proto=serialised_model(tokens))
        self.pretoken = regex.compile(PRETOKEN)
        self.slice_of = slice_of
        letters = [as_letters(t) for t in tokens]
        self.unmerged = {
            text: np.array([k], dtype="<u4").tobytes()
            for k, (text, ids) in enumerate(zip(letters, self.model.encode(letters, num_threads=1), strict=True))
            if ids != [k]
        }

    def pieces(self, pieces: list[str]) -> list[bytes]:
        return self.texts(pieces)

    def texts(self, texts: list[str]) -> list[bytes]:
        cut = [self.pretoken.findall(t) for t in texts]
        words = list(set().union(*cut))
        letters = [as_letters(w.encode()) for w in words]
        found = self.model.encode(letters, num_threads=1)
        flat = np.fromiter(chain.from_iterable(found), dtype="<u4").tobytes()
        ids, at = {}, 0
        for word, text, made in zip(words, letters, found, strict=True):
            end = at + 4 * len(made)
            ids[word] = self.unmerged.get(text) or flat[at:end]
            at = end
        return [b"".join([ids[w] for w in part]) for part in cut]

    def slices(self, text: str) -> Iterator[str]:
        """The text in parts of about `slice_of` characters, cut only where every pre-tokenizer match must end."""
        at = 0
        while len(text) - at > self.slice_of:
            cut = BREAK.search(text, at + self.slice_of)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def encode_text(self, text: str) -> np.ndarray:
        parts = [self.encode([part])[0] for part in self.slices(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


class RankDecoder:
    """Bytes of ids, by the inverse of the byte-letters of the model's pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=serialised_model(read_ranks(path)))
        ids = range(model.get_piece_size() - 1)  # the last one is the unknown piece
        self.data = [as_bytes(piece) for piece in model.id_to_piece(list(ids))]

    def decode(self, ids: np.ndarray, read: int = 1 << 16) -> bytes:
        data = self.data
        parts = [b"".join([data[i] for i in ids[at : at + read].tolist()]) for at in range(0, len(ids), read)]
        return parts[0] if len(parts) == 1 else b"".join(parts)


_encoders: dict[str, RankEncoder] = {}
_decoders: dict[str, RankDecoder] = {}


def _encoder(path: str) -> RankEncoder:
    """One encoder a Python worker, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = RankEncoder(path)
    return _encoders[path]


def _decoder(path: str) -> RankDecoder:
    if path not in _decoders:
        _decoders[path] = RankDecoder(path)
    return _decoders[path]


def encode_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None
) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of each whole text as little-endian unsigned 32-bit numbers, no special tokens.

    A map over the rows: no shuffle, and a lost task repeats the same rows. Null and empty text: no ids. Repeated rows:
    each is encoded. A null id stays null. No rows: none. Other columns are not read. A very long text is encoded in
    slices of about a million characters, cut between pre-tokens; one unbroken pre-token is encoded whole.
    """
    path = ranks or default_ranks()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                short = make.encode([t if t and len(t) <= make.slice_of else "" for t in texts])
                found = [
                    make.encode_text(t) if t and len(t) > make.slice_of else ids
                    for t, ids in zip(texts, short, strict=True)
                ]
                columns = [
                    part.column(0),
                    pa.array([len(x) for x in found], type=pa.int64()),
                    pa.array([x.tobytes() for x in found], type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        encode, "doc_id long, n_tokens long, ids binary"
    )


def decode_documents(encoded: DataFrame, *, ranks: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the bytes that the ids stand for. Null or no ids: no bytes. No rows: none.

    Any list of ids of the vocabulary decodes, also to bytes that are no UTF-8. An id outside the vocabulary is an error.
    """
    path = ranks or default_ranks()

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _decoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                said = [make.decode(np.frombuffer(x or b"", dtype="<u4")) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(said, type=pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"]
                )

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        decode, "doc_id long, n_tokens long, ids binary, decoded binary"
    )
