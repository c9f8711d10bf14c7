"""Toxicity by compression distance: windows compressed with a dictionary of toxic and one of ordinary text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medledger.llm.common import fold_of, words_of

#: Both dictionaries hold these, and they stand around each window: so every window compresses, even one of a word, and
#: the lengths differ by what the window itself finds in the one dictionary and not in the other.
BEFORE = b"0123456789 here a window begins and both dictionaries hold it -> "
AFTER = b" <- 9876543210 here it ends, and both hold this"
#: Length differences, ordinary less toxic, are held to LOW..HIGH; what the toxic dictionary saves of the length without one,
#: to 0..SAVED - 1. A window's place among both is its code.
LOW, HIGH, SAVED = -8, 24, 16
CODES, FEATURES = (HIGH - LOW + 1) * SAVED, 23
_FORMAT = {"format": zstandard.FORMAT_ZSTD1_MAGICLESS, "write_content_size": 0, "write_dict_id": 0, "write_checksum": 0}
_SEARCH = {"strategy": zstandard.STRATEGY_GREEDY, "min_match": 4, "window_log": 18, "hash_log": 15, "chain_log": 15, "search_log": 4}


def windows_of(text: str | None, size: int) -> list[bytes]:
    """Windows of `size` words of the whole text, A-Z in lower case, a space at both ends."""
    words = words_of(text)
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


class Lengths:
    """Compressed lengths of windows with a dictionary."""

    def __init__(self, content: bytes):
        params = zstandard.ZstdCompressionParameters(**_FORMAT, **_SEARCH)
        words = zstandard.ZstdCompressionDict(content + BEFORE + AFTER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=params)
        self.compress = zstandard.ZstdCompressor(dict_data=words, compression_params=params).compress

    def of(self, windows: list[bytes]) -> list[int]:
        return [len(self.compress(BEFORE + w + AFTER)) for w in windows]


def trained(samples: list[bytes], size: int, k: int) -> bytes:
    """zstandard's own trainer on the samples; their ends if there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def ordinary_dictionary(texts: list[bytes], size: int = 8192, part: int = 200) -> bytes:
    """Trained on the whole ordinary texts, cut into parts."""
    return trained([t[i : i + part] for t in texts for i in range(0, len(t), part)], size, 64)


def _grams(text: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the n-byte pieces (n <= 8) that lie in one word, with the space before or after it."""
    x = np.frombuffer(text, dtype=np.uint8)
    if len(x) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(len(x) - n + 1, dtype=np.uint64)
    for i in range(n):
        grams = (grams << np.uint64(8)) | x[i : i + len(grams)]
    spaces = np.concatenate([[0], (x == 32).cumsum()])
    at = np.flatnonzero(spaces[n - 1 : n - 1 + len(grams)] == spaces[1 : 1 + len(grams)])
    return at, grams[at]


def _counted(texts: list[bytes], n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Distinct pieces, the texts that hold each, its occurrences (`most` at most a text), and the pieces in all."""
    found = [np.unique(_grams(t, n)[1], return_counts=True) for t in texts]
    every = np.concatenate([*(g for g, _ in found), np.zeros(0, np.uint64)])
    times = np.concatenate([*(np.minimum(c, most) for _, c in found), np.zeros(0, np.int64)])
    pieces, which = np.unique(every, return_inverse=True)
    held, occurs = np.bincount(which, minlength=len(pieces)), np.bincount(which, times, minlength=len(pieces))
    return pieces, held, occurs, int(sum(c.sum() for _, c in found))


def telling_pieces(toxic: list[bytes], ordinary: list[bytes], n: int, *, least: int = 4, ratio: float = 10, margin: float = 10, most: int = 4) -> np.ndarray:
    """Pieces of n bytes that stand in `least` toxic texts or more, occur `ratio` times as often as in ordinary ones, and
    whose log likelihood ratio against chance exceeds the logarithm of the number of pieces by `margin`.

    These are bars on evidence, not on a share of the texts, so a language with few texts is heard too.
    """
    pieces, held, here, total = _counted(toxic, n, most)
    others, _, there, other_total = _counted(ordinary, n, most)
    rival = np.zeros(len(pieces))
    if len(others) and len(pieces):
        at = np.minimum(np.searchsorted(others, pieces), len(others) - 1)
        rival = np.where(others[at] == pieces, there[at], 0)
    share, both = total / max(1, total + other_total), here + rival
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = here * np.log(here / (both * share))
        evidence += np.where(rival > 0, rival * np.log(rival / (both * (1 - share))), 0)
        told = (held >= least) & (evidence > np.log(max(1, len(pieces))) + margin)
    return pieces[told & (here * other_total > ratio * rival * total)]


def toxic_dictionary(toxic: list[bytes], ordinary: list[bytes], *, sizes: tuple = (5, 6, 7, 8), size: int = 8192) -> bytes:
    """Trained on the whole toxic texts less what does not tell them from ordinary ones: of each text the runs of its
    telling pieces. Trained on all of it, the dictionary would hold what both classes share."""
    told = [(n, telling_pieces(toxic, ordinary, n)) for n in sizes]
    samples = []
    for text in toxic:
        edges = np.zeros(len(text) + 1, dtype=np.int64)
        for n, pieces in told:
            at, grams = _grams(text, n)
            at = at[np.isin(grams, pieces)]
            np.add.at(edges, at, 1)
            np.add.at(edges, at + n, -1)
        covered = np.concatenate([[0], (edges.cumsum() > 0).astype(np.int8)])
        edge = np.diff(covered)
        runs = zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)
        samples.append(b"".join(text[a:b] for a, b in runs))
    return trained([x for x in samples if x], size, 16)


def features(histograms: np.ndarray) -> np.ndarray:
    """Of each text's histogram of codes: of the differences the largest, means of the largest two, three and fiftieth
    part, windows at or over 2, 3, 4 and 5 as number and share, and the number of windows; of the savings of windows that
    the toxic dictionary makes shorter, windows at or over 3 to 7 as number and share."""
    both = histograms.reshape(len(histograms), HIGH - LOW + 1, SAVED)
    differ, saved = both.sum(axis=2), both[:, 1 - LOW :].sum(axis=1)
    n = differ.sum(axis=1)
    down = differ[:, ::-1].cumsum(axis=1)
    values = np.arange(HIGH, LOW - 1, -1)

    def mean_of_top(k: np.ndarray) -> np.ndarray:
        taken = np.diff(np.minimum(down, k[:, None]), axis=1, prepend=0)
        return taken @ values / np.maximum(taken.sum(axis=1), 1)

    tops = [mean_of_top(np.full(len(n), k)) for k in (1, 2, 3)] + [mean_of_top(np.maximum(n // 50, 1))]
    over = [down[:, HIGH - k] for k in (2, 3, 4, 5)] + [saved[:, k:].sum(axis=1) for k in (3, 4, 5, 6, 7)]
    shares = [np.log1p(1000 * c / np.maximum(n, 1)) for c in over]
    return np.stack([*tops, *(np.log1p(c) for c in over), *shares, np.log(np.maximum(n, 1))], axis=1)


@dataclass
class CompressionModel:
    """The two dictionaries and the calibration of what the lengths say."""

    toxic: bytes
    ordinary: bytes
    size: int
    mean: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    spread: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))

    def scores(self, histograms: np.ndarray) -> np.ndarray:
        x = (features(histograms) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -500, 500)))

    def calibrate(self, histograms: np.ndarray, toxic: np.ndarray, odds_shift: float) -> None:
        """Logistic weights by Newton's method with a small penalty; odds_shift corrects for how classes were drawn."""
        x = features(histograms)
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        x = np.hstack([(x - self.mean) / self.spread, np.ones((len(x), 1))])
        w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], 1.0)
        penalty[-1] = 1e-3
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
            step = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            w = w + np.linalg.solve(step, x.T @ (toxic - p) - penalty * w)
        w[-1] += odds_shift
        self.weights = w


class Scorer:
    """Codes of windows: each is compressed with the ordinary dictionary, the toxic one and none. Windows are remembered in
    two bounded generations."""

    def __init__(self, model: CompressionModel, cache: int = 300_000, longest: int = 48):
        self.model, self.cache, self.longest = model, cache, longest
        self.lengths = [Lengths(content).of for content in (model.ordinary, model.toxic, b"")]
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def histograms(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), CODES), dtype=np.int64)
        if len(self.young) > self.cache:
            self.old, self.young = self.young, {}
        young = self.young
        for k, text in enumerate(texts):
            windows = windows_of(text, self.model.size)
            new = []
            for w in set(windows).difference(young):
                if w in self.old:
                    young[w] = self.old[w]
                else:
                    new.append(w)
            once = {}
            for w, a, b, c in zip(new, *(of(new) for of in self.lengths), strict=True):
                code = (min(HIGH, max(LOW, a - b)) - LOW) * SAVED + min(SAVED - 1, max(0, c - b))
                (young if len(w) <= self.longest else once)[w] = code
            if once:
                found = [young[w] if w in young else once[w] for w in windows]
            else:
                found = list(map(young.__getitem__, windows))
            if found:
                out[k] = np.bincount(found, minlength=CODES)
        return out


def spread(text: Column, longest: int, parts: int = 64) -> Column:
    """The text, or of one with more than `longest` characters that many in parts from its beginning to its end."""
    part = longest // parts
    starts = F.sequence(F.lit(0), F.lit(parts - 1))
    step = (F.length(text) - part) / (parts - 1)
    cut = F.transform(starts, lambda i: F.substring(text, (1 + F.floor(i * step)).cast("int"), F.lit(part)))
    return F.when(F.length(text) > longest, F.concat_ws(" ", cut)).otherwise(text)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 3,
    held_out: int = 1,
    sample: int = 1500,
    size: int = 1,
    longest: int = 1 << 16,
) -> CompressionModel:
    """The model from labelled rows whose crc32(id as text) modulo `folds` is not `held_out`.

    A bounded sample is fitted: of each label the `sample` ids of least hash, each text whole, but of one with over
    `longest` characters 64 parts spread evenly over it. Calibration is crossed: each half is told apart with the dictionaries trained on the
    other one, and the weights are fitted to both; the model's dictionaries are then trained on the whole sample. Labels that are null or not 0 or 1 are not used. With fewer than two texts of a label in
    either half, the score is the share of toxic labels (0 if there are none).
    """
    usable = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("y"))
    usable = usable.filter((F.col("y").isin(0, 1)) & (fold_of("id", folds) != held_out) & F.col("id").isNotNull())
    usable = usable.groupBy("id").agg(F.max("y").alias("y"))
    totals = {r.y: r.n for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = {}  # of at most 2 * sample ids: their places among the hashes of their label
    for y in (0, 1):
        first = usable.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample)
        order |= {r.id: (y, n) for n, r in enumerate(first.select("id").collect())}
    chosen = docs.sparkSession.createDataFrame([(i, *at) for i, at in order.items()], "id long, y int, n int")
    texts = docs.select(docs[id_col].cast("long").alias("id"), spread(docs[text_col].cast("string"), longest).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").orderBy("y", "n").collect()
    seen: dict[tuple[int, bytes], tuple] = {}
    for r in rows:
        seen.setdefault((r.y, b" " + b" ".join(words_of(r.text)) + b" "), r)
    half: list[dict[int, list]] = [{0: [], 1: []}, {0: [], 1: []}]
    for (y, text), r in seen.items():
        half[r.n % 2][y].append((text, r.text))
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if min(len(h[y]) for h in half for y in (0, 1)) < 2:
        odds = np.log(share / (1 - share)) if 0 < share < 1 else (-700.0 if not share else 700.0)
        return CompressionModel(b"", b"", size, weights=np.append(np.zeros(FEATURES), odds))
    parts = [{y: [t for t, _ in h[y]] for y in (0, 1)} for h in half]
    found, told = [], []
    for train, other in ((parts[0], half[1]), (parts[1], half[0])):
        scorer = Scorer(CompressionModel(toxic_dictionary(train[1], train[0]), ordinary_dictionary(train[0]), size))
        for y in (0, 1):
            found.append(scorer.histograms([t for _, t in other[y]]))
            told.append(np.full(len(other[y]), float(y)))
    toxic, ordinary = (parts[0][y] + parts[1][y] for y in (1, 0))
    model = CompressionModel(toxic_dictionary(toxic, ordinary), ordinary_dictionary(ordinary), size)
    shift = np.log(share / (1 - share) / (len(toxic) / len(ordinary)))
    model.calibrate(np.concatenate(found), np.concatenate(told), float(shift))
    return model


_scorers: dict[tuple, Scorer] = {}


def _scorer(model: CompressionModel) -> Scorer:
    key = (model.toxic, model.ordinary, model.size)
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model)
    return _scorers[key]


def score_documents(
    docs: DataFrame, model: CompressionModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, score): how likely label 1 is for each whole text, from 0 to 1; only the text counts.

    A map over the rows with a small model: no shuffle. Null and empty texts have no windows and get the score of that.
    Repeated rows: each is scored. A null id stays null. Other columns are not read.
    """

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _scorer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = model.scores(make.histograms(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["doc_id", "score"])

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        score, "doc_id long, score double"
    )


def reject_toxic(docs: DataFrame, model: CompressionModel, *, text_col: str = "text", most: float = 0.7) -> DataFrame:
    """The rows of docs, with all columns, whose score is under `most`."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _scorer(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                yield part.filter(pa.array(model.scores(make.histograms(part.column(at).to_pylist())) < most))

    return docs.mapInArrow(keep, docs.schema)
