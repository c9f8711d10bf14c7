"""How five filters interact: what each subset and each order of them removes, from one word a document."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medledger.llm.common import word_slices, written

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: For each set of failed filters the truth table of survival: bit s is set if the subset s of filters lets it through.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], dtype=np.uint32)

_WHITE = bytes.maketrans(b"\t\n\v\f\r", b"     ")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b"#$%&*|"

#: A text is hot if it has more than this part of all documents.
HOT = 1024

COUNTED = ("all", "good", "toxic")
_COUNTS = [f"{kind}_{s}" for kind in COUNTED for s in range(SUBSETS)]


def failures(text: str) -> int:
    """Bits 0 to 3: the text fails A (few words), B (few distinct ones), C (capitals) or D (marks)."""
    data = text.encode()
    n, distinct = 0, set()
    for words in word_slices(data.translate(_WHITE)):
        n += len(words)
        distinct.update(words)
    capitals = len(data) - len(data.translate(None, _UPPER))
    marked = len(data.translate(None, _MARKS)) < len(data)
    return (n < 50) | (100 * len(distinct) < 65 * n) << 1 | (100 * capitals > 5 * len(text)) << 2 | marked << 3


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the unsigned 32-bit words have each bit set, by carry-save adders.

    An adder takes three words of one weight and leaves one of that weight, the bitwise sum, and one of twice the weight,
    the carries, for all 32 positions at once. What is left of a weight, two words at most, is read bit by bit.
    """
    counts, weight = np.zeros(32, dtype=np.int64), 1
    while len(words):
        carries = []
        while len(words) > 2:
            k = len(words) // 3
            a, b, c = words[:k], words[k : 2 * k], words[2 * k : 3 * k]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * k :]])
        for word in words.tolist():
            counts += weight * np.array([word >> s & 1 for s in range(32)], dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def survival_words(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """(doc_id, part, good, toxic, word) of each document; bit s of `word` is set if it survives the subset s of filters.

    Only (id, part, SHA-256 of the text, failures) of a document is shuffled, never a text. Texts that repeat are found
    by a minimum per digest, added up before the shuffle. A text with over one in `HOT` of all rows is looked up by
    broadcast, and there are fewer than `HOT` such texts at any size; the others are joined by digest. Ids with many rows
    are joined as adaptive execution splits them.

    A null text counts as empty, a null part as the empty string. Equal texts under one doc_id: none is the later one. A
    null doc_id has no order: it neither fails E nor makes others fail it, and has no labels. Repeated labels of a doc_id
    hold together. Other columns are not read.
    """

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(2).to_pylist()]
                columns = [
                    *part.columns[:2],
                    pa.array([hashlib.sha256(t.encode()).digest() for t in texts], type=pa.binary()),
                    pa.array([failures(t) for t in texts], type=pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "digest", "failed"])

    read = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
        docs[text_col].cast("string").alias("text"),
    )
    seen = written(read.mapInArrow(look, "doc_id long, part string, digest binary, failed int"), "filter-failures")
    repeated = written(
        seen.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1"), "repeated-texts"
    )
    often = F.col("n") > max(1, seen.count() // HOT)
    hot, others = F.broadcast(repeated.filter(often).drop("n")), repeated.filter(~often).drop("n")
    with_least = seen.join(hot, "digest").unionByName(
        seen.join(hot, "digest", "left_anti").join(others, "digest", "left")
    )
    marked = (
        labels.select(labels[id_col].cast("long").alias("doc_id"), labels["quality"], labels["toxic"])
        .groupBy("doc_id")
        .agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))))
        .filter("good or toxic")
    )
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    failed = F.col("failed").bitwiseOR(F.shiftleft(later, 4))
    word = F.element_at(F.array(*(F.lit(int(w)).cast("long") for w in WORDS)), failed + 1)
    return (
        with_least.join(marked, "doc_id", "left")
        .select(
            "doc_id",
            "part",
            *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")),
            word.alias("word"),
        )
    )


def subset_survivors(words: DataFrame, *, together: int = 1 << 18, most_parts: int = 1024) -> DataFrame:
    """(part, all_0 … all_31, good_0 …, toxic_0 …): documents of the part, and of those with the label, that survive each
    subset of the filters. Each task counts `together` documents at a time and holds the counts of `most_parts` parts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= together:
                _count_into(found, held)
                held, n = [], 0
            if len(found) > most_parts:
                yield _counts(found)
                found = {}
        _count_into(found, held)
        if found:
            yield _counts(found)

    partial = words.select("part", "good", "toxic", "word").mapInArrow(
        count, "part string, " + ", ".join(f"{c} long" for c in _COUNTS)
    )
    return partial.groupBy("part").agg(*(F.sum(c).alias(c) for c in _COUNTS))


def _count_into(found: dict[str, np.ndarray], batches: list[pa.RecordBatch]) -> None:
    table = pa.Table.from_batches(batches) if batches else None
    if not table:
        return
    parts = table.column("part").combine_chunks().dictionary_encode()
    good, toxic = (table.column(c).to_numpy().astype(np.int64) for c in ("good", "toxic"))
    word = table.column("word").to_numpy().astype(np.uint32)
    group = parts.indices.to_numpy().astype(np.int64) * 4 + good + 2 * toxic
    order = np.argsort(group, kind="stable")
    word, group = word[order], group[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    names = parts.dictionary.to_pylist()
    for a, b in zip(starts, np.append(starts[1:], len(group)), strict=True):
        counts, label = positional_counts(word[a:b]), int(group[a]) % 4
        sums = found.setdefault(names[group[a] // 4], np.zeros((len(COUNTED), SUBSETS), dtype=np.int64))
        sums[[0] + [1] * (label & 1) + [2] * (label >> 1)] += counts


def _counts(found: dict[str, np.ndarray]) -> pa.RecordBatch:
    table = np.stack([x.ravel() for x in found.values()])
    columns = [pa.array(list(found), type=pa.string()), *(pa.array(c) for c in table.T)]
    return pa.RecordBatch.from_arrays(columns, ["part", *_COUNTS])


def order_audit(survivors: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): what each of
    the 120 orders of the filters does in each part, step by step, read off the survivors of subsets. No parts: none."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    letter = np.array([[FILTERS.index(x) for x in o] for o in orders])
    after = np.cumsum(1 << letter, axis=1)
    before = after - (1 << letter)
    letter, after, before = letter.ravel(), after.ravel(), before.ravel()
    names = np.repeat(orders, len(FILTERS)).tolist()
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders))

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1) if batch.num_rows else None
            for k, part in enumerate(batch.column(0).to_pylist()):
                kept, good, toxic = table[k].reshape(len(COUNTED), SUBSETS)
                removed = kept[before] - kept[after]
                failing = kept[0] - kept[1 << letter]
                alone = kept[SUBSETS - 1 - (1 << letter)] - kept[SUBSETS - 1]
                over_all = np.bincount(letter, weights=removed).astype(np.int64)  # exact below 2**53
                columns = [
                    [part] * len(names),
                    names,
                    steps,
                    kept[after],
                    removed,
                    failing - removed,
                    alone,
                    good[before] - good[after],
                    toxic[before] - toxic[after],
                    over_all[letter],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _AUDIT)

    counted = ", ".join(f"{c} long" for c in _AUDIT[3:])
    return survivors.select("part", *_COUNTS).mapInArrow(expand, f"part string, filter_order string, step int, {counted}")


_AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`order_audit` of the documents' survival words; see `survival_words` for nulls, repeats and ties."""
    return order_audit(subset_survivors(survival_words(docs, labels)))
