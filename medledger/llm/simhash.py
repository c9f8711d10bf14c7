"""SimHash fingerprints and near duplicates by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medledger.llm.blocks import BlockLabels
from medledger.llm.common import ASCII_LOWER, components, written


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits: bit b is 1 if it is 1 in over half of the hashes of the text's word shingles, repeats included."""
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    ones, n = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    for at in range(0, n, 8192):
        part = words[at : at + 8192 + shingle - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1).tolist()
        starts = [0, *ends]
        hashes = [
            xxhash.xxh64_intdigest(line[a : b - 1], seed=42)
            for a, b in zip(starts, ends[shingle - 1 :], strict=False)
        ]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, tag: Column | None = None
) -> DataFrame:
    """(doc_id, tag, fp): fp holds the 64 bits as a signed long. Null or empty texts, and those of white space: 0.

    `tag` is a long of the caller's that goes with the row, null if none is given. Repeated rows: each has its own. No
    rows: none. A text is hashed 8,192 words at a time; its words are held at once.
    """

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], dtype=np.uint64)
                columns = [*part.columns[:2], pa.array(found.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "fp"])

    tag = F.lit(None) if tag is None else tag
    return docs.select(
        docs[id_col].cast("long").alias("id"), tag.cast("long").alias("tag"), docs[text_col].cast("string").alias("text")
    ).mapInArrow(make, "doc_id long, tag long, fp long")


def variants(fp: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of each fingerprint, one row each: (key, value of the wildcard bit).

    A key names the segment and the wildcard bit, and holds the segment's other bits.
    """
    width = 64 // segments
    keys, bits = [], []
    for s in range(segments):
        part = (fp >> np.uint64(s * width)) & np.uint64((1 << width) - 1)
        for j in range(width):
            name = np.uint64((s * width + j) << width)
            keys.append(name | (part & ~np.uint64(1 << j)))
            bits.append((part >> np.uint64(j)) & np.uint64(1))
    return np.stack(keys, axis=1).view(np.int64), np.stack(bits, axis=1).astype(np.int8)


def links_within(distinct: DataFrame, *, distance: int = 3, block: int = 2048) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that tell the components of all pairs at most `distance` bits apart.

    The 64 bits are cut into so few segments that of two linked fingerprints one segment differs in at most one bit
    (two segments for 3 bits). Each segment is indexed with every one of its bits as a wildcard, so such a pair shares
    a signature; an equality on signatures brings them together and the distance is verified. Pairs that agree in the
    whole segment meet in all its signatures and are compared in the first alone; the others take only pairs that differ
    in the wildcard bit. Signatures with more than `block` members are dealt out anew as pairs of blocks: a group holds
    two blocks at most, whatever the signature's size. Of what is linked, a spanning set leaves each group, never all
    pairs. No rows: no links.
    """
    segments = max(2, distance // 2 + 1)
    while 64 % segments:
        segments += 1
    width = 64 // segments

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                fp = batch.column(0).slice(at, 1024).to_numpy()
                keys, bits = variants(fp.view(np.uint64), segments)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(bits.ravel()), pa.array(np.repeat(fp, keys.shape[1]))],
                    ["key", "bit", "fp"],
                )

    def small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the signatures that are small; the members of the others as they are."""
        large: int | None = None
        for rows, complete in _runs(batches, ("key",), block):
            if not complete or rows["key"][0] == large:  # the run holds part of one large signature
                large = int(rows["key"][0])
                yield _batch(rows["fp"], rows["fp"], rows["key"], rows["bit"])
                continue
            pairs = _linked_in(rows, width, distance)
            yield _batch(pairs[:, 0], pairs[:, 1])

    def crossed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _runs(batches, ("key", "at"), 1 << 62):
            pairs = _linked_in(rows, width, distance)
            yield _batch(pairs[:, 0], pairs[:, 1])

    signed = distinct.select("fp").mapInArrow(spread, "key long, bit byte, fp long")
    first = written(
        signed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(small, _LINKS), "simhash-links"
    )
    rows = first.filter("key is not null").select("key", "bit", F.col("a").alias("fp"))
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # Each pair of blocks is a group: the lower block's members, and the higher one's as guests.
    dealt = (
        rows.join(blocks, "key")
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("at", F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other"))
        .select("key", "at", (F.col("own") > F.col("other")).alias("guest"), "bit", "fp")
    )
    second = dealt.repartition("key", "at").sortWithinPartitions("key", "at", "guest", "fp").mapInArrow(crossed, _LINKS)
    return first.filter("key is null").select("a", "b").union(second.select("a", "b"))


_LINKS = "a long, b long, key long, bit byte"


def _batch(a, b, key=None, bit=None) -> pa.RecordBatch:
    none = [pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int8())]
    more = none if key is None else [pa.array(key), pa.array(bit)]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *more], ["a", "b", "key", "bit"])


def _runs(
    batches: Iterable[pa.RecordBatch], by: tuple[str, ...], most: int
) -> Iterator[tuple[dict[str, np.ndarray], bool]]:
    """Runs of whole groups from sorted batches. A group of over `most` rows comes alone, in parts marked incomplete,
    of which the last may be marked complete."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {n: batch.column(k).to_numpy(zero_copy_only=False) for k, n in enumerate(batch.schema.names)}
        if held is not None:
            now = {n: np.concatenate([held[n], now[n]]) for n in now}
        change = np.any([now[k][1:] != now[k][:-1] for k in by], axis=0)
        starts = np.append(0, np.flatnonzero(change) + 1)
        sizes = np.diff(np.append(starts, len(change) + 1))
        begin = 0
        for k in np.flatnonzero(sizes[:-1] > most):
            if starts[k] > begin:
                yield {n: x[begin : starts[k]] for n, x in now.items()}, True
            begin = starts[k + 1]
            yield {n: x[starts[k] : begin] for n, x in now.items()}, False
        if starts[-1] > begin:
            # A part of a large group may stand first: its end comes alone.
            if held is not None and starts[1] > begin:
                yield {n: x[begin : starts[1]] for n, x in now.items()}, True
                begin = starts[1]
            if starts[-1] > begin:
                yield {n: x[begin : starts[-1]] for n, x in now.items()}, True
        held = {n: x[starts[-1] :] for n, x in now.items()}
        if sizes[-1] > most:
            yield held, False
            held = {n: x[:0] for n, x in held.items()}
    if held is not None and len(held[by[0]]):
        yield held, True


def _linked_in(rows: dict[str, np.ndarray], width: int, distance: int) -> np.ndarray:
    """Pairs of fingerprints that tell the components within each group of the rows."""
    key, fp, bit = rows["key"], rows["fp"].view(np.uint64), rows["bit"]
    at = rows.get("at", np.zeros(len(key), dtype=np.int64))
    guest = rows.get("guest", np.zeros(len(key), dtype=bool)).astype(bool)
    starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (at[1:] != at[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    whole = ((key >> width) % width == 0)[starts]  # the first signature of a segment also takes pairs that agree in it
    two = starts[sizes == 2]
    two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
    found = [np.stack([rows["fp"][two], rows["fp"][two + 1]], axis=1)]
    both = np.minimum.reduceat(bit, starts) < np.maximum.reduceat(bit, starts)
    for k in np.flatnonzero((sizes > 2) & (whole | both)):
        part = slice(starts[k], starts[k] + sizes[k])
        members = np.flatnonzero(~guest[part]) + starts[k]
        guests = np.flatnonzero(guest[part]) + starts[k] if guest[part].any() else members
        labels = BlockLabels(rows["fp"][members])
        for a in range(0, len(guests), 512):
            some = guests[a : a + 512]
            linked = np.bitwise_count(fp[some, None] ^ fp[None, members]) <= distance
            if not whole[k]:
                linked &= bit[some, None] != bit[None, members]
            found.append(labels.link(rows["fp"][some], linked))
    return np.unique(np.concatenate(found), axis=0)


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    block: int = 2048,
    tag: Column | None = None,
) -> DataFrame:
    """(doc_id, tag, fp, root, component_id) of each document: component_id is the smallest doc_id reachable by links, its
    own too; root is the least fingerprint reachable, which no two components share even where doc_ids repeat.

    Documents link if their fingerprints differ in at most `distance` bits. Equal fingerprints are one class from the
    start, so copies are never paired; classes are compared by `links_within` and joined by `components`.

    Null or empty text: fingerprint 0, linked like any other. Repeated doc_ids: one row each, by its own text. A null
    doc_id gets a null component unless its class has another id. No rows: none. Other columns are not read; `tag`, a
    long of the caller's, goes with its row.
    """
    marked = written(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, tag=tag), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    links = links_within(classes, distance=distance, block=block)
    joined = components(classes.select(F.col("fp").alias("id")), links)
    named = classes.join(joined, classes["fp"] == joined["id"]).select("fp", "least", F.col("component_id").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(least, "root").drop("least"), "fp").select("doc_id", "tag", "fp", "root", "component_id")
