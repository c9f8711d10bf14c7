"""Byte-pair encoding as a streaming transducer with a computed lookahead, and decoding by a byte-to-text machine."""

from __future__ import annotations

import bisect
import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from medledger.llm.token_ids import PieceCache, default_tokenizer

#: The byte-level pre-tokenizer's pattern, with white space written out.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible, else one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def texts_of(spec: dict) -> dict[int, bytes]:
    """The bytes of each id; added tokens stand for their own text."""
    letters = byte_letters()
    found = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in letters for c in t)}
    return found | {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}


class MergeList:
    """A merge list: what two neighbouring tokens become, in which order, and how far ahead one must look."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE without normalizer, dropout or ignored merges")
        letters = byte_letters()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t[k] for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that look at their neighbours are not supported")
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.added}
        self.text = texts_of(spec)
        self.of_byte = np.zeros(256, dtype=np.int64)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        self.merges: list[tuple[int, int, int]] = []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.append((vocab[a], vocab[b], vocab[a + b]))
        self.rank = {(a, b): k for k, (a, b, _) in enumerate(self.merges)}
        keys = np.array([(a << 32) | b for a, b, _ in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order, len(order))
        self.made = np.array([c for _, _, c in self.merges] + [-1], dtype=np.int64)
        self.lookahead = sufficient_lookahead([(len(self.text[a]), a, b, c) for a, b, c in self.merges])

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank at which each pair merges; the number of merges if it never does."""
        key = (a << 32) | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.merges))


def sufficient_lookahead(merges: list[tuple[int, int, int, int]]) -> int:
    """Bytes that suffice: a token that ends so many bytes before the end of what was read never changes.

    merges: (bytes of left, left, right, both) in order of priority. What follows can change a merge over the end of
    the text; that moves the last boundary on which both futures agree to the left by the merge's left token u. From
    there only a later merge whose right part begins with u, not yet merged to the right of u, can move it again. So
    the bound is the heaviest chain of such merges, each later in the list than the one before, counted in left tokens.
    """
    made_at: dict[int, int] = {}
    left_of: dict[int, int] = {}
    for k, (_, a, _, c) in enumerate(merges):
        if c in made_at:
            raise ValueError("each token must be made by one merge")
        made_at[c], left_of[c] = k, a
    if any(made_at.get(x, -1) >= k for k, (_, a, b, _) in enumerate(merges) for x in (a, b)):
        raise ValueError("each token must be made of tokens made before")
    steps: dict[int, list[int]] = defaultdict(list)  # of each left token: the ranks at which its heaviest chain grows
    loads: dict[int, list[int]] = defaultdict(list)
    most = 0
    for k, (size, a, b, _) in enumerate(merges):
        best, begin, until = 0, b, k
        while True:
            at = bisect.bisect_right(steps[begin], until) if begin in steps else 0
            if at:
                best = max(best, loads[begin][at - 1])
            if begin not in left_of:
                break
            until = min(until, made_at[begin])  # the begin must have been free up to then
            begin = left_of[begin]
        load = best + size
        if not loads[a] or load > loads[a][-1]:
            steps[a].append(k)
            loads[a].append(load)
        most = max(most, load)
    return most


class Transducer:
    """Reads bytes of one pre-token in pieces and emits each token once no further byte can change it.

    Memory is the lookahead, one read and one token: what is held back is merged again after each read, which is right
    because no merge crosses the boundary of an emitted token.
    """

    def __init__(self, merges: MergeList, read: int | None = None):
        self.merges = merges
        self.read = read or 4 * merges.lookahead
        self.held = b""

    def feed(self, data: bytes, last: bool = False) -> Iterator[int]:
        for at in range(0, max(1, len(data)), self.read):
            self.held += data[at : at + self.read]
            final = last and at + self.read >= len(data)
            stable = len(self.held) - (0 if final else self.merges.lookahead)
            done = 0
            if stable <= 0:
                continue
            for token in merged(self.merges, self.held):
                size = len(self.merges.text[token])
                if done + size > stable:
                    break
                done += size
                yield token
            self.held = self.held[done:]


def merged(merges: MergeList, data: bytes) -> list[int]:
    """The tokens of a short text: the merge of least rank first, the leftmost of equals."""
    tokens = [int(merges.of_byte[b]) for b in data]
    after = list(range(1, len(tokens) + 1))
    before = list(range(-1, len(tokens) - 1))
    rank, n = merges.rank, len(tokens)
    queue = [(rank[p], i) for i in range(n - 1) if (p := (tokens[i], tokens[i + 1])) in rank]
    heapq.heapify(queue)
    while queue:
        k, i = heapq.heappop(queue)
        j = after[i]
        if tokens[i] < 0 or j >= n or rank.get((tokens[i], tokens[j])) != k:
            continue
        tokens[i], tokens[j] = merges.merges[k][2], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := rank.get((tokens[i], tokens[after[i]]))) is not None:
                heapq.heappush(queue, (r, i))
        if before[i] >= 0 and (r := rank.get((tokens[before[i]], tokens[i]))) is not None:
            heapq.heappush(queue, (r, before[i]))
    return [t for t in tokens if t >= 0]


def merged_together(merges: MergeList, words: list[bytes]) -> list[bytes]:
    """The tokens (little-endian unsigned 32-bit) of many words of equal length at once: each round merges the best pair of every word."""
    never = len(merges.merges)
    ids = merges.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)].reshape(len(words), -1)
    out: list = [None] * len(words)
    rows, end = np.arange(len(words)), np.full((len(words), 1), -1, dtype=np.int64)
    ids = np.hstack([ids, end])
    ranks = merges.rank_of(ids[:, :-1], ids[:, 1:])
    while len(rows):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), at]
        over = best == never
        if over.any():
            done = ids[over]
            data, stride = done.astype("<u4").tobytes(), 4 * done.shape[1]
            sizes = 4 * (done >= 0).sum(axis=1)
            for k, (row, size) in enumerate(zip(rows[over].tolist(), sizes.tolist(), strict=True)):
                out[row] = data[k * stride : k * stride + size]
        go = ~over
        rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
        if not len(rows):
            break
        every, width = np.arange(len(rows)), ids.shape[1]
        ids[every, at] = merges.made[best]
        take = np.arange(width - 1)[None, :]
        ids = np.take_along_axis(ids, take + (take > at[:, None]), axis=1)
        ids = np.hstack([ids, np.full((len(rows), 1), -1)])[:, : max(2, width)]
        take = np.arange(width - 2)[None, :]
        ranks = np.hstack([np.take_along_axis(ranks, take + (take > at[:, None]), axis=1), np.full((len(rows), 1), never)])
        right = ids[every, at + 1]
        ranks[every, at] = np.where(right >= 0, merges.rank_of(ids[every, at], np.maximum(right, 0)), never)
        has = at > 0
        ranks[every[has], at[has] - 1] = merges.rank_of(ids[every[has], at[has] - 1], ids[every[has], at[has]])
    return out


class Encoder(PieceCache):
    """Ids of whole texts: pre-tokens end where the pattern ends them, longer ones go through the transducer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.merges = MergeList(json.load(f))
        self.pretoken = regex.compile(PRETOKEN)
        marks = sorted(self.merges.added, key=len, reverse=True)
        self.any_mark = re.compile("(" + "|".join(map(re.escape, marks)) + ")")
        super().__init__(marks)

    def marked(self, text: str) -> bytes:
        found = []
        for k, part in enumerate(self.any_mark.split(text)):
            ids = [self.merges.added[part]] if k % 2 else self.encode([part])[0]
            found.append(np.asarray(ids, dtype="<u4").tobytes())
        return b"".join(found)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        return self.texts(pieces)

    def texts(self, texts: list[str]) -> list[bytes]:
        cut = [self.pretoken.findall(t) for t in texts]
        ids: dict[str, bytes] = {}
        by_size: dict[int, list[tuple[str, bytes]]] = defaultdict(list)
        for word in set().union(*cut):
            data = word.encode()
            by_size[len(data)].append((word, data))
        for size, words in by_size.items():
            if size == 1 or size > self.longest or len(words) < 8:
                for word, data in words:
                    ids[word] = np.array(list(Transducer(self.merges).feed(data, last=True)), dtype="<u4").tobytes()
            else:
                made = merged_together(self.merges, [data for _, data in words])
                ids.update(zip([word for word, _ in words], made, strict=True))
        return [b"".join([ids[t] for t in words]) for words in cut]


class ByteToText:
    """Bytes in, text out: holds back at most three bytes of a character that is not complete; ill-formed bytes become
    U+FFFD, one for each longest ill-formed part."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                keep = back if need > back else 0
                break
            if lead < 0x80:
                break
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_tables: dict[str, list[bytes | None]] = {}


def _table(path: str) -> list[bytes | None]:
    """The bytes of each id, all that decoding needs."""
    if path not in _tables:
        with open(path, encoding="utf-8") as f:
            text = texts_of(json.load(f))
        _tables[path] = [text.get(i) for i in range(max(text) + 1)]
    return _tables[path]


def encode_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of each whole text, as encode(text, add_special_tokens=False) gives them.

    A map over the rows: no shuffle. Null and empty text: no ids. Repeated rows: each is encoded. A null id stays null.
    An added token's text becomes its id. Other columns are not read.
    """
    path = tokenizer or default_tokenizer()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = make.encode(part.column(1).to_pylist())
                sizes = np.array([len(x) for x in found], dtype=np.int64)
                ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
                flat = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), ids], ["doc_id", "n_tokens", "ids"])

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        encode, "doc_id long, n_tokens long, ids array<int>"
    )


def decode_documents(encoded: DataFrame, *, tokenizer: str | None = None, read: int = 4096) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the text of the ids, special tokens kept; `read` ids at a time.

    Null ids or an empty list: empty text. An id outside the vocabulary is an error, as it is in the library.
    """
    path = tokenizer or default_tokenizer()

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path)
        for batch in batches:
            column = batch.column(2)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            found = []
            for k in range(batch.num_rows):
                machine, said = ByteToText(), []
                ids = flat[ends[k] : ends[k + 1]] if column[k].is_valid else flat[:0]
                for at in range(0, len(ids), read):
                    said.append(machine.feed(b"".join([table[i] for i in ids[at : at + read].tolist()])))
                found.append("".join([*said, machine.close()]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, type=pa.string())], ["doc_id", "n_tokens", "ids", "decoded"]
            )

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        decode, "doc_id long, n_tokens long, ids array<int>, decoded string"
    )
