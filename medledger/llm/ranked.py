"""Ranked lexical search: sums of short lists met by a document-at-a-time walk that skips over the long ones."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medledger.llm.common import word_slices, written

#: Letters, digits and all that is not ASCII stay, A-Z in lower case; any other byte parts two terms.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_NO_ID = np.iinfo(np.int64).max


def term_slices(text: str) -> Iterator[list[bytes]]:
    return word_slices(text.encode().translate(_TERMS))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term, times): the terms of each item with their numbers of occurrences."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for words in term_slices(text or ""):
                    ids = pa.array([item] * len(words), type=pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, pa.array(words, type=pa.binary())], ["item_id", "term"])

    terms = items.select(items[id_col].cast("long").alias("id"), items[text_col].cast("string").alias("text")).mapInArrow(
        split, "item_id long, term binary"
    )
    return terms.groupBy("item_id", "term").agg(F.count("*").alias("times"))


def matched_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, times) of the documents with a term: all n terms counted, those of the vocabulary by number."""
    size = max(1, len(vocabulary))

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, found = np.zeros(part.num_rows, dtype=np.int64), [np.zeros(0, dtype=np.int64)]
                for k, text in enumerate(part.column(1).to_pylist()):
                    for words in term_slices(text or ""):
                        sizes[k] += len(words)
                        hits = [t for t in map(number, words) if t is not None]
                        found.append(np.array(hits, dtype=np.int64) + k * size)
                pairs, times = np.unique(np.concatenate(found), return_counts=True)
                kept = np.flatnonzero(sizes)
                ends = np.searchsorted(pairs, np.append(kept, part.num_rows) * size).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (pairs % size, times)
                ]
                ids = part.column(0).take(pa.array(kept))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes[kept]), *lists], ["doc_id", "n", "terms", "times"])

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        look, "doc_id long, n long, terms array<int>, times array<int>"
    )


class Best:
    """The k best (score, id) found so far: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    @property
    def bar(self) -> int:
        """A score below the bar is of no use."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


class Block:
    """Posting lists of a block of documents, in order of their ids, with the score of each posting.

    A list of over `short` documents is long: for each range of `width` documents it has the greatest score there and
    where the range begins, so that a walk can skip. `ids` holds _NO_ID for a document without an id.
    """

    def __init__(self, ids, n, terms, times, sizes, weights: np.ndarray, n_docs: int, n_terms: int, width: int, short: int):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.width, n = ids[order], width, n[order]
        if int(n.max(initial=0)) * 75 * n_docs < 1 << 63:
            m = 25 + 75 * n * n_docs // n_terms
        else:
            m = np.array([25 + 75 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
        doc = np.repeat(place, sizes)
        by_term = np.lexsort((doc, terms))
        self.doc, term, times = doc[by_term], terms[by_term], times[by_term].astype(np.int64)
        self.score = weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m[self.doc]))
        self.term, begins = np.unique(term, return_index=True)
        self.begin, self.end = begins, np.append(begins[1:], len(term))
        self.ranges = -(-len(ids) // width)
        self.long = np.flatnonzero(self.end - self.begin > short)
        self.greatest = np.zeros((len(self.long), self.ranges), dtype=np.int64)
        self.range_at = np.zeros((len(self.long), self.ranges + 1), dtype=np.int64)
        borders = np.arange(self.ranges + 1) * width
        for row, k in enumerate(self.long):
            a, b = self.begin[k], self.end[k]
            at = a + np.searchsorted(self.doc[a:b], borders)
            self.range_at[row] = at
            filled = np.flatnonzero(at[1:] > at[:-1])
            self.greatest[row, filled] = np.maximum.reduceat(self.score[a:b], at[filled] - a)
        self.row_of = {int(k): row for row, k in enumerate(self.long)}
        self.sums = np.zeros(self.ranges * width, dtype=np.int64)
        self.scored = 0

    def search(self, terms: np.ndarray, times: np.ndarray, best: Best) -> None:
        """Add to `best` the documents of the block that belong there, for an item's terms and how often it has them."""
        at = np.searchsorted(self.term, terms)
        there = at < len(self.term)
        there[there] = self.term[at[there]] == terms[there]
        at, times = at[there], times[there]
        rows = np.array([self.row_of.get(k, -1) for k in at.tolist()], dtype=np.int64)
        # Short lists: term at a time, into one accumulator that the walk reads as one list with a bound per range.
        sums, touched = self.sums, []
        for k, c in zip(at[rows < 0].tolist(), times[rows < 0].tolist(), strict=True):
            part = slice(self.begin[k], self.end[k])
            sums[self.doc[part]] += c * self.score[part]
            touched.append(self.doc[part])
        rows, times = rows[rows >= 0], times[rows >= 0]
        most = times[:, None] * self.greatest[rows]
        most = np.concatenate([sums.reshape(-1, self.width).max(axis=1)[None, :], most])
        bounds = most.sum(axis=0)
        # What k documents have from short lists alone is a bar that the k-th best reaches at least.
        reached = np.sort(sums[sums > 0])[-best.k :] if touched else sums[:0]
        bar = max(best.bar, int(reached[0]) if len(reached) == best.k else 1)
        for r in np.flatnonzero(bounds >= bar):
            bar = max(bar, best.bar)
            if bounds[r] >= bar:  # the bar rises on the way
                self._walk(int(r), rows, times, most[:, r], bar, best)
        for docs in touched:
            sums[docs] = 0

    def _walk(self, r: int, rows: np.ndarray, times: np.ndarray, most: np.ndarray, bar: int, best: Best) -> None:
        """The documents of a range, found in the lists without which none can reach the bar, looked up in the others
        while they still can. List 0 is the accumulator of the short lists."""
        low = r * self.width
        lists = np.argsort(most, kind="stable")
        lists = lists[most[lists] > 0]
        rest = np.cumsum(most[lists])  # what the lists up to here can give at most
        optional = int(np.searchsorted(rest, bar))
        score = np.zeros(self.width, dtype=np.int64)
        for k in lists[optional:].tolist():
            if k:
                part = self._part(rows[k - 1], r)
                score[self.doc[part] - low] += times[k - 1] * self.score[part]
            else:
                score += self.sums[low : low + self.width]
        found = np.flatnonzero(score)
        score = score[found]
        for i in range(optional - 1, -1, -1):
            can = score + rest[i] >= bar
            found, score = found[can], score[can]
            if not len(found):
                return
            k = int(lists[i])
            if not k:
                score = score + self.sums[low + found]
                continue
            part = self._part(rows[k - 1], r)
            docs = self.doc[part]
            at = np.minimum(np.searchsorted(docs, found + low), len(docs) - 1)
            score = score + np.where(docs[at] == found + low, times[k - 1] * self.score[part][at], 0)
        self.scored += len(found)
        good = score >= bar
        if good.any():
            best.add(score[good], self.ids[low + found[good]])

    def _part(self, row: int, r: int) -> slice:
        return slice(self.range_at[row, r], self.range_at[row, r + 1])


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 10,
    block: int = 65_536,
    most_postings: int = 2_000_000,
    width: int = 1024,
    most_query_terms: int = 500_000,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents with the highest scores above 0.

    Two passes. The first counts in each whole text the terms that items ask for and writes them as a narrow table; from
    it come the statistics of the corpus, added up before they are shuffled. In the second each task inverts the rows of
    its partition, `block` documents (or `most_postings` postings) at a time, and searches them for every item: lists
    shorter than a thirty-second of the block are summed at once, the long ones are walked document at a time in ranges
    of `width`, and ranges, lists and documents that cannot reach the k-th best score of the task are skipped. Only the k
    best of a task are shuffled, so neither a frequent term nor an item gathers rows. Results are exact.

    Items are a stated set: (item, term) pairs go to the tasks `most_query_terms` at a time, with a pass over the
    documents for each lot. Repeated rows of an item add up to one item. An item without a term, and one that no
    document matches, has no rows. Null texts have no terms. Each row of docs is a document, repeated ones too; of equal
    scores the smaller doc_id stands first, a null one last. No documents or no items: no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    pairs = written(query_terms(items, item_col, item_text_col), "query-terms")
    lots = max(1, -(-pairs.count() // most_query_terms))
    found = None
    for lot in range(lots):
        asked = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(lots)) == lot) if lots > 1 else pairs
        made = _search(docs, asked.collect(), id_col, text_col, k, block, most_postings, width)
        if made is not None:
            found = made if found is None else found.union(made)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def _search(docs, asked, id_col, text_col, k, block, most_postings, width) -> DataFrame | None:
    """The k best documents of each task for the items of `asked`."""
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in asked}))}
    of_item: dict[int | None, list[tuple[int, int]]] = {}
    for r in asked:
        of_item.setdefault(r.item_id, []).append((vocabulary[bytes(r.term)], r.times))
    queries = [(item, *(np.array(x, dtype=np.int64) for x in zip(*sorted(ts), strict=True))) for item, ts in of_item.items()]
    if not queries:
        return None
    counted = written(matched_terms(docs, vocabulary, id_col, text_col), "matched-terms")
    total = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not total.docs:
        return None
    n_docs, n_terms = total.docs, total.terms
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[r.term] = weight(n_docs, r["count"])
    short = block // 32

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for held in _blocks(batches, block, most_postings):
            inverted = Block(*held, weights, n_docs, n_terms, width, min(short, len(held[0]) // 32))
            for one, (_, terms, times) in zip(best, queries, strict=True):
                inverted.search(terms, times, one)
        for one, (item, _, _) in zip(best, queries, strict=True):
            if len(one.ids):
                ids = pa.array(one.ids, mask=one.ids == _NO_ID)
                names = pa.array([item] * len(ids), type=pa.int64())
                yield pa.RecordBatch.from_arrays([names, ids, pa.array(one.scores)], ["item_id", "doc_id", "score"])

    return counted.mapInArrow(search, "item_id long, doc_id long, score long")


def _blocks(batches: Iterable[pa.RecordBatch], block: int, most_postings: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, n, terms, times, sizes) of the documents, so many at a time."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            ids, n = (part.column(i).fill_null(_NO_ID).to_numpy(zero_copy_only=False) for i in (0, 1))
            lists = [part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3)]
            held.append((ids, n, *lists, part.column(2).value_lengths().to_numpy(zero_copy_only=False)))
            docs, postings = docs + len(ids), postings + len(lists[0])
            if docs >= block or postings >= most_postings:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, docs, postings = [], 0, 0
    if docs:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
