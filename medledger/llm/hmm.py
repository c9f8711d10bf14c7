"""A hidden Markov language model: Baum-Welch over partitions, exact likelihoods by the scaled forward recursion."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medledger.llm.common import fold_of, words_of, written

_ENCODED = "chunk long, doc_id long, held boolean, ids binary, local int, word binary, n long"
_COUNTED = "chunk long, local int, n long, class int, doc_id long, held boolean, ids binary"
_CLASSED = "doc_id long, held boolean, n_tokens long, n_known long, base_score double, in_class double, classes binary"


def encoded(docs: DataFrame, held: Column, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """Documents as numbers of words, and each chunk's words with their counts in training documents.

    A chunk is about `chunk_bytes` of texts of one partition: each of its distinct words leaves it once, so a word that
    stands everywhere weighs no more than others in what follows.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24
        pack = zstandard.ZstdCompressor(level=1).compress
        schema = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("held", pa.bool_()), ("ids", pa.binary()), ("local", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])

        def chunks():
            rows, size = [], 0
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    for row in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                        rows.append(row)
                        size += len(row[2] or "") + 64
                        if size >= chunk_bytes:
                            yield rows
                            rows, size = [], 0
            if rows:
                yield rows

        for number, rows in enumerate(chunks()):
            chunk = base + number
            name: dict[bytes, int] = defaultdict(count().__next__)
            ids = []
            for _, _, text in rows:
                words = words_of(text)
                ids.append(np.fromiter(map(name.__getitem__, words), np.int32, len(words)))
            train = [x for x, (_, out, _) in zip(ids, rows, strict=True) if not out]
            counts = np.bincount(np.concatenate([*train, np.zeros(0, np.int32)]), minlength=len(name))
            for at in range(0, len(rows), 1000):
                part, n = rows[at : at + 1000], len(rows[at : at + 1000])
                blobs = [pack(x.tobytes()) for x in ids[at : at + 1000]]
                docs_of = [[chunk] * n, [r[0] for r in part], [r[1] for r in part], blobs, [None] * n, [None] * n, [None] * n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(docs_of, schema, strict=True)], schema=schema
                )
            words = list(name)
            for at in range(0, len(words), 20_000):
                part = words[at : at + 20_000]
                n = len(part)
                columns = [pa.array(np.full(n, chunk)), *(pa.nulls(n, schema.field(k).type) for k in (1, 2, 3))]
                columns += [pa.array(np.arange(at, at + n, dtype=np.int32)), pa.array(part, type=pa.binary()), pa.array(counts[at : at + n])]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(
        docs[id_col].cast("long").alias("id"), held.alias("held"), docs[text_col].cast("string").alias("text")
    )
    return rows.mapInArrow(encode, _ENCODED)


@dataclass
class Vocabulary:
    """Classes of words: the most frequent have one each, others share one by their last letters, the end has its own."""

    tokens: int  # in training texts, ends counted
    words: int  # distinct ones, the end counted
    ends: int
    frequent: int
    classes: int
    total: np.ndarray  # training tokens of each class
    distinct: np.ndarray

    def in_class(self, n: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its class, an unknown word of each shared class counted once."""
        shared = of >= self.frequent  # the end never comes here: it is the only word of its class
        return np.where(shared, np.log10((n + 1) / (self.total[of] + self.distinct[of] + 1)), 0.0)


def classed(table: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each document's class sequence, with what its words' counts say: a chunk's words come first, then its documents."""
    end, ends = vocabulary.classes - 1, vocabulary.ends

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        floor = np.log10(vocabulary.tokens + vocabulary.words + 1)
        here, counts, of = None, [], []
        known = base = share = None
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            local = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((chunks[1:] != chunks[:-1]) | (local[1:] != local[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(chunks)], strict=True):
                if a == b:
                    continue
                if chunks[a] != here:
                    here, counts, of, known = int(chunks[a]), [], [], None
                if local[a]:
                    counts.append(batch.column(2).slice(a, b - a).to_numpy())
                    of.append(batch.column(3).slice(a, b - a).to_numpy())
                    continue
                if known is None:
                    n = np.concatenate([*counts, np.zeros(0, np.int64)])
                    kind = np.concatenate([*of, np.zeros(0, np.int32)])
                    known, base = n > 0, np.log10(n + 1) - floor
                    share, code = vocabulary.in_class(n, kind), kind.astype("<u2")
                found = []
                for k in range(a, b):
                    ids = np.frombuffer(unpack(batch.column(6)[k].as_py()), dtype=np.int32)
                    found.append((
                        batch.column(4)[k].as_py(), batch.column(5)[k].as_py(), len(ids) + 1, int(known[ids].sum()) + (ends > 0),
                        float(base[ids].sum() + np.log10(ends + 1) - floor), float(share[ids].sum()),
                        pack(np.append(code[ids], np.uint16(end)).astype("<u2").tobytes()),
                    ))
                yield _batch(found, _CLASSED_ARROW)

    return table.mapInArrow(look_up, _CLASSED)


_CLASSED_ARROW = pa.schema([("doc_id", pa.int64()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("in_class", pa.float64()), ("classes", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


@dataclass
class HiddenMarkov:
    """start: of a text; middle: of a later segment; move[i, j]; emit[class, state]."""

    start: np.ndarray
    middle: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def fresh(cls, states: int, classes: int, share: np.ndarray, seed: int = 11) -> HiddenMarkov:
        """States that tend to stay, and emit what the corpus does, each with its own random bias."""
        rng = np.random.default_rng(seed)
        emit = (share[:, None] + 1e-6) * np.exp(rng.normal(0, 1, (classes, states)))
        move = np.full((states, states), 0.05 / max(1, states - 1))
        np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
        even = np.full(states, 1 / states)
        return cls(even, even, move, emit / emit.sum(axis=0))

    @classmethod
    def of_counts(cls, counts: np.ndarray, states: int, classes: int) -> HiddenMarkov:
        """From expected counts laid out as start, middle, moves and emissions, each smoothed a little."""
        a, b, c = states, 2 * states, 2 * states + states * states
        start, middle = counts[:a] + 0.1, counts[a:b] + 0.1
        move = counts[b:c].reshape(states, states) + 0.1
        emit = counts[c:].reshape(classes, states) + 0.01
        return cls(start / start.sum(), middle / middle.sum(), move / move.sum(axis=1)[:, None], emit / emit.sum(axis=0))

    def log10_likelihoods(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 probability of each sequence: the forward variables are scaled at each step, none is kept."""
        out, ones = np.zeros(len(sequences)), np.ones(len(self.start))
        for rows, seen, active in _stacked(sequences, 1_000_000):
            total = np.zeros(len(rows))
            now, then, told = (np.empty((len(rows), len(ones))) for _ in range(3))
            for t in range(len(seen)):
                n = active[t]
                np.take(self.emit, seen[t, :n], axis=0, out=told[:n], mode="clip")
                if t:
                    np.matmul(then[:n], self.move, out=now[:n])
                    now[:n] *= told[:n]
                else:
                    np.multiply(self.start, told, out=now)
                scale = now[:n] @ ones
                total[:n] += np.log10(scale)
                now[:n] /= scale[:, None]
                now, then = then, now
            out[rows] = total
        return out

    def expected(self, sequences: list[np.ndarray], first: np.ndarray) -> np.ndarray:
        """Baum-Welch counts of sequences; first[i]: sequence i begins a text."""
        k = len(self.start)
        heads, moves, emits = np.zeros((2, k)), np.zeros((k, k)), np.zeros_like(self.emit)
        ones, move_back = np.ones(k), np.ascontiguousarray(self.move.T)
        for rows, seen, active in _stacked(sequences, 500_000):
            forward, told = np.zeros((*seen.shape, k)), np.empty((*seen.shape, k))
            np.take(self.emit, seen, axis=0, out=told, mode="clip")
            for t in range(len(seen)):
                n = active[t]
                now = forward[t, :n]
                if t:
                    np.matmul(forward[t - 1, :n], self.move, out=now)
                    now *= told[t, :n]
                else:
                    np.multiply(np.where(first[rows][:, None], self.start, self.middle), told[0], out=now)
                scale = (now @ ones)[:, None]
                now /= scale
                told[t, :n] /= scale
            back, gathered = np.ones((len(rows), k)), np.zeros((k, k))
            for t in range(len(seen) - 1, -1, -1):
                n = active[t]
                told[t, :n] *= back[:n]
                forward[t, :n] *= back[:n]
                if t:
                    gathered += forward[t - 1, :n].T @ told[t, :n]
                    np.matmul(told[t, :n], move_back, out=back[:n])
            moves += gathered * self.move
            heads[0] += forward[0][first[rows]].sum(axis=0)
            heads[1] += forward[0][~first[rows]].sum(axis=0)
            live = np.arange(seen.shape[1])[None, :] < np.asarray(active)[:, None]
            codes, weights = seen[live], forward[live]
            for s in range(k):
                emits[:, s] += np.bincount(codes, weights=weights[:, s], minlength=len(emits))
        return np.concatenate([heads.ravel(), moves.ravel(), emits.ravel()])


def _stacked(sequences: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Groups of sequences of like length as (rows, seen[t, i], number of sequences longer than t), longest first."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        longest = int(sizes[order[at]])
        rows = order[at : at + max(1, min(1024, most // max(1, longest)))]
        at += len(rows)
        if not longest:
            continue
        seen = np.zeros((longest, len(rows)), dtype=np.int64)
        for i, r in enumerate(rows):
            seen[: sizes[r], i] = sequences[r]
        yield rows, seen, np.searchsorted(-sizes[rows], -np.arange(longest), side="left").tolist()


def _sequences(column: pa.Array) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [np.frombuffer(unpack(x), dtype="<u2") for x in column.to_pylist()]


def trained(table: DataFrame, vocabulary: Vocabulary, states: int, rounds: int, segment: int) -> HiddenMarkov:
    """Baum-Welch over all training documents: each task adds up its expected counts, Spark adds those of the tasks.

    Texts are cut into segments of at most `segment` tokens for training, which bounds what a task holds.
    """
    train = table.filter(~F.col("held")).select("classes")
    share = vocabulary.total / max(1, vocabulary.total.sum())
    model = HiddenMarkov.fresh(states, vocabulary.classes, share)
    size = 2 * states + states * states + vocabulary.classes * states
    for _ in range(rounds):

        def gather(batches: Iterable[pa.RecordBatch], now: HiddenMarkov = model) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(size)
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    parts, first = [], []
                    for seq in _sequences(batch.column(0).slice(at, 2048)):
                        for a in range(0, len(seq), segment):
                            parts.append(seq[a : a + segment])
                            first.append(a == 0)
                    counts += now.expected(parts, np.array(first, dtype=bool))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["at", "n"])

        found = train.mapInArrow(gather, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(size)
        counts[[r["at"] for r in found]] = [r["n"] for r in found]
        model = HiddenMarkov.of_counts(counts, states, vocabulary.classes)
    return model


def score_documents(
    docs: DataFrame,
    held: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = 6,
    rounds: int = 6,
    frequent: int = 1024,
    shared: int = 1024,
    suffix: int = 3,
    segment: int = 4096,
    chunk_bytes: int = 32_000_000,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each document, learned from the others.

    Words (A-Z in lower case) and one end make a text. Every count is over all training texts. The model: hidden states
    emit classes of words, and a class its words by their add-one shares; `frequent` words are classes of their own,
    the rest fall into `shared` classes by their last `suffix` bytes. `score` is the log10 probability of the whole text
    under it, exact up to rounding. `base_score` is the add-one model of single words.

    Words are counted once a chunk before they are shuffled; only class totals, the `frequent` words and the model,
    sized by the parameters, reach the driver. Null or empty text: the end alone. Repeated rows: each counts and is
    scored. A null id is dealt as the empty text is. No training text: base_score 0 and even parameters. No rows: none.
    """
    table = written(encoded(docs, held, id_col, text_col, chunk_bytes), "hmm-encoded")
    by_word = Window.partitionBy("word")
    counted = written(
        table.filter("word is not null").select(
            "chunk",
            "local",
            "word",
            F.sum("n").over(by_word).alias("n"),
            (F.min("chunk").over(by_word) == F.col("chunk")).alias("lead"),
        ),
        "hmm-counted",
    )
    ends = table.filter("word is null and not held").count()
    lead = counted.filter("lead and n > 0")
    top = lead.orderBy(F.desc("n"), "word").limit(frequent).select("word").collect()
    spark = docs.sparkSession
    named = spark.createDataFrame([(bytes(r.word), k) for k, r in enumerate(top)], "word binary, own int")
    tail = F.pmod(F.xxhash64(F.substring("word", -suffix, suffix)), F.lit(shared)).cast("int") + frequent
    with_class = counted.join(F.broadcast(named), "word", "left").withColumn("class", F.coalesce("own", tail))
    totals = with_class.filter("lead and n > 0").groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    classes = frequent + shared + 1
    total, distinct = np.zeros(classes), np.zeros(classes)
    for r in totals.collect():
        total[r["class"]], distinct[r["class"]] = r["n"], r["v"]
    total[-1], distinct[-1] = ends, min(ends, 1)
    vocabulary = Vocabulary(int(total.sum()), int(distinct.sum()), ends, frequent, classes, total, distinct)
    words = with_class.select(
        "chunk", "local", "n", "class", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held"), F.lit(None).cast("binary").alias("ids")
    )
    rows = table.filter("word is null").select(
        "chunk", "local", "n", F.lit(None).cast("int").alias("class"), "doc_id", "held", "ids"
    )
    dealt = words.union(rows).repartition("chunk").sortWithinPartitions("chunk", F.asc_nulls_last("local"))
    texts = written(classed(dealt, vocabulary), "hmm-classes")
    model = trained(texts, vocabulary, states, rounds, segment)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = model.log10_likelihoods(_sequences(part.column(6))) + part.column(5).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(5)), pa.array(found)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    scored = texts.mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(vocabulary.tokens).cast("long"))


def held_out(id_col: str = "doc_id", folds: int = 7, out: int = 2) -> Column:
    return fold_of(id_col, folds) == out
