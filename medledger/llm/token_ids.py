"""Token ids of whole texts by the tokenizers library, and record batches for what is built from them."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

#: A byte-level vocabulary cuts here whatever stands around: a space between two characters that are not white space.
BREAK = re.compile(r" (?=\S)(?<=\S.)")


def pieces_of(text: str) -> list[str]:
    """The text between its breaks."""
    # With no white space but single spaces and line ends, none beside the other, each space is a break.
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return BREAK.split(text)
    return text.split(" ") if text.replace("\n", "").isprintable() else BREAK.split(text)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceCache:
    """Ids of texts, cut into pieces between breaks; each distinct piece is encoded once, many together.

    Two generations of at most about `cache` pieces are remembered, none of over `longest` characters, so memory has a
    bound. A subclass says what the ids of pieces are, and of texts that hold one of `marks`.
    """

    def __init__(self, marks: list[str], cache: int = 300_000, longest: int = 48):
        self.marks, self.cache, self.longest = marks, cache, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, each with the space before it."""
        raise NotImplementedError

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of any texts without marks."""
        raise NotImplementedError

    def marked(self, text: str) -> bytes:
        raise NotImplementedError

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text; a null text is empty."""
        if len(self.young) > self.cache:
            self.old, self.young = self.young, {}
        young, once = self.young, {}
        cut: list[list[str]] = []
        found: list[list[bytes | None]] = []
        holes: dict[int, list[int]] = {}  # by text, the places of pieces that are not remembered
        whole: dict[int, bytes] = {}
        for k, text in enumerate(texts):
            text = text or ""
            marked = any(mark in text for mark in self.marks)
            if marked:
                whole[k] = self.marked(text)
            parts = [""] if marked else pieces_of(text)
            ids = list(map(young.get, parts))
            ids[0] = b""  # the first piece has no space before it
            if None in ids:
                holes[k] = [i for i, x in enumerate(ids) if x is None]
            cut.append(parts)
            found.append(ids)
        missing = []
        for piece in {cut[k][i] for k, places in holes.items() for i in places}:
            if piece in self.old:
                young[piece] = self.old[piece]
            else:
                missing.append(piece)
        for piece, ids in zip(missing, self.pieces([" " + p for p in missing]), strict=True):
            (young if len(piece) <= self.longest else once)[piece] = ids
        for k, places in holes.items():
            parts, ids = cut[k], found[k]
            for i in places:
                ids[i] = young[parts[i]] if parts[i] in young else once[parts[i]]
        for k, head in enumerate(self.texts([parts[0] for parts in cut])):
            found[k][0] = whole.get(k, head)
        return [np.frombuffer(b"".join(ids), dtype="<u4") for ids in found]


class TextEncoder(PieceCache):
    """Ids of byte-level BPE texts by the library, equal to its encode(text, add_special_tokens=False).

    A text is cut only where the library's own pre-tokenizer must cut it. Texts that hold an added token (such as an
    end mark) are given to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        super().__init__([t.content for t in self.tokenizer.get_added_tokens_decoder().values()])

        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.size = np.zeros(max(vocab.values()) + 1, dtype=np.int64)  # a letter of a byte-level token is a byte
        self.size[list(vocab.values())] = [len(t) for t in vocab]

    def pieces(self, pieces: list[str], together: int = 500) -> list[bytes]:
        """The library gets many pieces as one text, and the ids are parted again where the pieces' bytes end."""
        data = b"".join(self.texts(["".join(pieces[at : at + together]) for at in range(0, len(pieces), together)]))
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in pieces], dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(self.size[np.frombuffer(data, dtype="<u4")]), ends) + 1
        cuts = (cuts * 4).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def texts(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def marked(self, text: str) -> bytes:
        return self.texts([text])[0]


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder a Python worker, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def documents_as_ids(batches: Iterable, path: str, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, token ids and the end id) of each row of Arrow batches with the columns id, text."""
    make = encoder(path)
    end = np.array([end_id], dtype="<u4")
    for batch in batches:
        keys = batch.column(0).to_pylist()
        for at in range(0, len(keys), 256):
            texts = batch.column(1).slice(at, 256).to_pylist()
            for key, ids in zip(keys[at : at + 256], make.encode(texts), strict=True):
                yield key, np.concatenate([ids, end])
