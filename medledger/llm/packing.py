"""Sum-of-squares online packing of documents into token windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from medledger.llm.token_ids import default_tokenizer, documents_as_ids

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)


class SumOfSquares:
    """Windows of `capacity` tokens that are filled online (Csirik et al., 2006).

    `open_at[h]` holds the windows filled up to h tokens; their number is N(h). A piece of s tokens goes to the level h
    for which the sum of N(h) squared over the partly filled levels is least afterwards, ties to the fuller window.
    Full windows leave at once. Beyond `most_open` windows, the emptier half is cut up to fill one another, and so is
    what is open at the end; the last rest is cut at powers of two, which need no padding.
    """

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.open_at: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.levels = np.zeros(capacity + 1, dtype=np.int64)
        self.n_open = 0
        self.gain = np.zeros(capacity + 1, dtype=np.int64)  # the sum's fall when a window leaves a level
        self.cost = np.ones(capacity + 1, dtype=np.int64)  # its rise when a window comes to a level
        self.cost[capacity] = 0
        self.gain[1:] = -(1 << 40)

    def _count(self, level: int, by: int) -> None:
        self.levels[level] += by
        n = self.levels[level]
        self.gain[level] = 2 * n - 1 if n else -(1 << 40)
        self.cost[level] = 2 * n + 1
        self.n_open += by

    def level_for(self, size: int) -> int:
        top = self.capacity - size
        rise = self.cost[size:] - self.gain[: top + 1]
        return top - int(rise[::-1].argmin())

    def add(self, piece: tuple) -> Iterator[list]:
        """Place (doc_id, start, ids, doc_tokens); yields the windows that are full, as lists of pieces."""
        size = len(piece[2])
        level = self.level_for(size) if size < self.capacity else 0
        window: list = []
        if level:
            window = self.open_at[level].pop()
            self._count(level, -1)
        window.append(piece)
        if level + size == self.capacity:
            yield window
            return
        self._keep(window, level + size)
        if self.n_open > self.most_open:
            taken: list[list] = []
            for h in range(1, self.capacity):
                while self.open_at[h] and len(taken) < max(2, self.most_open // 2):
                    taken.append(self.open_at[h].pop())
                    self._count(h, -1)
            full, rest = self._fill(taken)
            yield from full
            if rest:
                self._keep(rest, sum(len(p[2]) for p in rest))

    def _keep(self, window: list, level: int) -> None:
        self.open_at[level].append(window)
        self._count(level, 1)

    def _fill(self, windows: list[list]) -> tuple[list[list], list]:
        """Full windows made from partly filled ones (fuller ones last), and what is left."""
        full, at = [], 0
        givers = [list(w) for w in windows]
        while at < len(givers):
            window = givers.pop()
            room = self.capacity - sum(len(p[2]) for p in window)
            while room and at < len(givers):
                if not givers[at]:
                    at += 1
                    continue
                doc, start, ids, total = givers[at].pop(0)
                if len(ids) > room:
                    givers[at].insert(0, (doc, start + room, ids[room:], total))
                    ids = ids[:room]
                window.append((doc, start, ids, total))
                room -= len(ids)
            if room:
                return full, window
            full.append(window)
        return full, []

    def close(self) -> Iterator[list]:
        left = [w for level in self.open_at for w in level]
        full, rest = self._fill(left)
        yield from full
        held = sum(len(p[2]) for p in rest)
        while held:
            size = 1 << (held.bit_length() - 1)
            window, room = [], size
            while room:
                doc, start, ids, total = rest.pop(0)
                if len(ids) > room:
                    rest.insert(0, (doc, start + room, ids[room:], total))
                    ids = ids[:room]
                window.append((doc, start, ids, total))
                room -= len(ids)
            yield window
            held -= size


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = 2048,
    end_id: int = 1,
    most_open: int = 1024,
) -> DataFrame:
    """Pieces of documents in windows of at most `capacity` tokens: PIECES, `ids` as little-endian unsigned 32-bit ids.

    Each task packs the documents of its own input partition in their order, so nothing is shuffled, a repeated task
    gives the same rows, and memory is one document and `most_open` windows. A document longer than a window fills
    windows of its own; its rest is placed as the others are. Every id, the end id too, lies in exactly one piece.
    `sequence_id` is unique: the partition's number times 2**32 and a count from 0. Windows are full, or hold a power of
    two of tokens (at most one of each in a task).

    Null or empty text: the end id alone. Repeated rows: each is packed. A null id stays null. No rows: no pieces.
    Other columns are not read.
    """
    path = tokenizer or default_tokenizer()

    def pack(batches):
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        packer, made, rows, held = SumOfSquares(capacity, most_open), 0, [], 0

        def windows():
            for doc, ids in documents_as_ids(batches, path, end_id):
                total = len(ids)
                for start in range(0, total, capacity):
                    yield from packer.add((doc, start, ids[start : start + capacity], total))
            yield from packer.close()

        for window in windows():
            offset = 0
            for doc, start, ids, total in window:
                rows.append((doc, start, len(ids), ids.tobytes(), total, base + made, offset))
                offset += len(ids)
            made += 1
            held += offset
            if held > 500_000:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        pack, PIECES
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW
    )
