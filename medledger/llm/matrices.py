"""Best-fit-decreasing packing into id matrices with segment boundaries and position resets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from medledger.llm.token_ids import default_tokenizer, documents_as_ids

ROWS = (
    "sequence_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<long>, starts array<long>"
)
_ARROW = pa.schema(
    [("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("input_ids", pa.binary()), ("position_ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))]
)


class CapacityTree:
    """Open rows by the room they have left: a segment tree over room sizes finds the least room that is enough."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, row: list) -> None:
        self.rows[room].append(row)
        self._step(room, 1)

    def take(self, size: int) -> tuple[int, list] | None:
        """The open row with the least room of at least `size`, and that room; None if there is none."""
        at = size + self.width
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at <<= 1
                at += not self.count[at]
        room = at - self.width
        self._step(room, -1)
        return room, self.rows[room].pop()

    def _step(self, room: int, by: int) -> None:
        at = room + self.width
        while at:
            self.count[at] += by
            at >>= 1


def best_fit_decreasing(pieces: list[tuple], capacity: int) -> Iterator[list]:
    """Rows of pieces (doc_id, start, ids); the longest piece first, each into the row it fills best."""
    tree = CapacityTree(capacity)
    for piece in sorted(pieces, key=lambda p: -len(p[2])):
        size = len(piece[2])
        room, row = tree.take(size) or (capacity, [])
        row.append(piece)
        if room == size:
            yield row
        else:
            tree.put(room - size, row)
    for rows in tree.rows:
        yield from rows


def packed_matrices(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = 2048,
    end_id: int = 1,
    pad_id: int = 50256,
    block_tokens: int = 4_000_000,
) -> DataFrame:
    """One row a packed sequence: the row of the id matrix, where its segments end, and positions that start anew.

    `input_ids`: `capacity` little-endian unsigned 32-bit ids, padded with `pad_id`; `position_ids`: as many unsigned
    16-bit positions, from 0 in each segment and in the padding; `cu_seqlens`: 0 and the end of each segment;
    `doc_ids` and `starts`: the document of each segment and the number of its ids before it. A task gathers about
    `block_tokens` tokens of its partition and packs them, longest first; that bounds its memory, and a block wastes
    about half a sequence. A document longer than `capacity` is split into whole sequences and a rest, without loss.
    `sequence_id` is unique: the partition's number times 2**32 and a count.

    Null or empty text: the end id alone. Repeated rows: each is packed. A null id stays null. No rows: no sequences.
    Other columns are not read. `capacity` is at most 65,536.
    """
    if not 1 <= capacity <= 65_536:
        raise ValueError("capacity is 1 to 65536")
    path = tokenizer or default_tokenizer()
    counted = np.arange(capacity, dtype="<u2")

    def pack(batches):
        base, made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0

        def blocks():
            pieces, held = [], 0
            for doc, ids in documents_as_ids(batches, path, end_id):
                for start in range(0, len(ids), capacity):
                    pieces.append((doc, start, ids[start : start + capacity]))
                held += len(ids)
                if held >= block_tokens:
                    yield pieces
                    pieces, held = [], 0
            if pieces:
                yield pieces

        for block in blocks():
            rows = []
            for row in best_fit_decreasing(block, capacity):
                ends = np.cumsum([0, *(len(p[2]) for p in row)])
                room = capacity - int(ends[-1])
                ids = np.concatenate([*(p[2] for p in row), np.full(room, pad_id, dtype="<u4")])
                places = np.concatenate([*(counted[: len(p[2])] for p in row), counted[:room]])
                rows.append((base + made, int(ends[-1]), ids.tobytes(), places.tobytes(), ends.astype(np.int32), [p[0] for p in row], [p[1] for p in row]))
                made += 1
                if len(rows) == 256:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        pack, ROWS
    )


def write_matrices(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet under path: a file holds the rows of a task, and a lost task is written again whole."""
    packed.write.mode("overwrite").parquet(path)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW
    )
