"""Secret scans: fixed patterns, and probabilistic automata inferred from the credentials they find."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medledger.llm.common import written

#: The base patterns and the least length of what they must find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "format")
ASSIGN_LEAST = 12

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns in code points, sorted by start and then kind.

    A run of the access or hex letters is maximal, so their least lengths can stand in the pattern; a short assignment
    instead uses up what it matched, and is dropped afterwards.
    """
    found = []
    if "=" in text or ":" in text:
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def credential(text: str, span: tuple[int, int, int]) -> str:
    """The credential within a base span."""
    start, kind, end = span
    return ASSIGN.match(text, start, end)[2] if kind == 0 else text[start:end]


#: The classes of letters that the automata read.
_CLASS = np.full(128, 5, dtype=np.int8)
_CLASS[[ord(c) for c in "0123456789"]] = 0
_CLASS[[ord(c) for c in "abcdef"]] = 1
_CLASS[[ord(c) for c in "ghijklmnopqrstuvwxyz"]] = 2
_CLASS[[ord(c) for c in "ABCDEF"]] = 3
_CLASS[[ord(c) for c in "GHIJKLMNOPQRSTUVWXYZ"]] = 4
CLASSES, END = 6, 6
#: Automata learn words to this letter.
DEEPEST = 64
_TO_CLASS = {i: chr(int(c)) for i, c in enumerate(_CLASS)}


def classes_of(word: str) -> list[int]:
    return [ord(c) for c in word.translate(_TO_CLASS)]


class Automaton:
    """A probabilistic automaton over letter classes, inferred by state merging (Carrasco and Oncina, 1994).

    The labelled words make a prefix tree with counts. Its states are visited breadth first, and each is merged with the
    first accepted state whose frequencies of going on with each class, and of ending, are statistically compatible by
    Hoeffding's bound at `alpha`, in them and in all states that follow; what is merged is folded so that the automaton
    stays deterministic. A move never seen has the probability of half a count. Words are learnt to their letter `deepest`.
    """

    def __init__(self, words: Iterable[list[int]], alpha: float = 0.05, deepest: int = DEEPEST):
        prefixes: dict[str, list[int]] = {}
        for word in words:
            text = "".join(map(str, word[:deepest]))
            for k, c in enumerate(word[:deepest]):
                prefixes.setdefault(text[:k], [0] * (CLASSES + 1))[c] += 1
            end = prefixes.setdefault(text, [0] * (CLASSES + 1))
            if len(word) <= deepest:  # a word that is cut does not end there
                end[END] += 1
        self._infer(prefixes, alpha)

    @classmethod
    def counted(cls, prefixes: dict[str, list[int]], alpha: float = 0.05) -> Automaton:
        """The automaton of words that are counted already: by prefix, as digits of its classes, how many words go on with
        each class, and how many end. A prefix of which there is no count is a state without evidence: that of the start."""
        made = cls.__new__(cls)
        made._infer(prefixes, alpha)
        return made

    def _infer(self, prefixes: dict[str, list[int]], alpha: float) -> None:
        order = sorted({"", *prefixes}, key=lambda x: (len(x), x))
        place = {x: k for k, x in enumerate(order)}
        self.next: list[dict[int, int]] = [{} for _ in order]
        self.count: list[list[int]] = [list(prefixes.get(x, [0] * (CLASSES + 1))) for x in order]
        for x in order[1:]:
            self.next[place[x[:-1]]][int(x[-1])] = place[x]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()
        self._number()

    def _compatible(self, p: int, q: int) -> bool:
        stack = [(p, q)]
        while stack:
            p, q = stack.pop()
            n, m = sum(self.count[p]), sum(self.count[q])
            if n and m:
                near = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
                if any(abs(a / n - b / m) > near for a, b in zip(self.count[p], self.count[q], strict=True)):
                    return False
                stack += [(self.next[p][c], r) for c, r in self.next[q].items() if c in self.next[p]]
        return True

    def _fold(self, p: int, q: int) -> None:
        """The subtree of q is added to p."""
        stack = [(p, q)]
        while stack:
            p, q = stack.pop()
            self.count[p] = [a + b for a, b in zip(self.count[p], self.count[q], strict=True)]
            for c, r in self.next[q].items():
                if c in self.next[p]:
                    stack.append((self.next[p][c], r))
                else:
                    self.next[p][c] = r

    def _merge(self) -> None:
        accepted, waiting = [0], [(0, c) for c in sorted(self.next[0])]
        while waiting:
            parent, c = waiting.pop(0)
            q = self.next[parent].get(c)
            if q is None or q in accepted:
                continue
            for p in accepted:
                if self._compatible(p, q):
                    self.next[parent][c] = p
                    self._fold(p, q)
                    break
            else:
                accepted.append(q)
            known = set(accepted)
            waiting = [(p, k) for p in accepted for k in sorted(self.next[p]) if self.next[p][k] not in known]

    def _number(self) -> None:
        """Tables of moves and log probabilities over the states that can be reached."""
        order, seen = [0], {0}
        for p in order:
            for q in self.next[p].values():
                if q not in seen:
                    seen.add(q)
                    order.append(q)
        name = {p: k for k, p in enumerate(order)}
        self.move = np.zeros((len(order), CLASSES), dtype=np.int32)
        self.log = np.zeros((len(order), CLASSES + 1))
        for p, k in name.items():
            total = sum(self.count[p]) + (CLASSES + 1) / 2
            for c in range(CLASSES + 1):
                self.log[k, c] = math.log((self.count[p][c] + 0.5) / total)
            for c, q in self.next[p].items():
                self.move[k, c] = name[q]
        del self.next, self.count

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word, its end included; all words step together."""
        if not words:
            return np.zeros(0)
        sizes = np.array([len(w) for w in words])
        joined = np.frombuffer("".join(words).encode("ascii"), dtype=np.uint8)
        letters = _CLASS[joined]
        begins = np.append(0, np.cumsum(sizes))[:-1]
        order = np.argsort(-sizes, kind="stable")
        sizes, begins = sizes[order], begins[order]
        state, total = np.zeros(len(words), dtype=np.int32), np.zeros(len(words))
        for t in range(int(sizes[0])):
            n = int(np.searchsorted(-sizes, -t, side="left"))  # words longer than t
            c = letters[begins[:n] + t]
            total[:n] += self.log[state[:n], c]
            state[:n] = self.move[state[:n], c]
        out = np.empty(len(words))
        out[order] = total + self.log[state, END]
        return out


class FormatModel:
    """Automata of labelled credentials by kind, one of ordinary words, and the threshold that parts them.

    A candidate's score is the best log-likelihood ratio against ordinary words, per letter. The threshold is `least`,
    or the score that one ordinary word in a thousand exceeds if that is more.
    """

    def __init__(self, credentials: dict[str, list[str]], ordinary: list[str], least: float = 0.5, enough: int = 20):
        self.kinds = {k: Automaton(map(classes_of, words)) for k, words in credentials.items() if len(words) >= enough}
        ordinary = ordinary + [w.upper() for w in ordinary]  # a word in capitals is a word still
        self.ordinary = Automaton(map(classes_of, ordinary))
        self.threshold = least
        if ordinary and self.kinds:
            self.threshold = max(least, float(np.quantile(self.ratio(ordinary), 0.999)))

    @classmethod
    def counted(cls, prefixes: dict[str, dict[str, list[int]]], words: dict[str, int], enough: int = 20) -> FormatModel:
        """The model of the counted prefixes and the number of words by kind; its threshold is still to be set."""
        made = cls.__new__(cls)
        made.kinds = {k: Automaton.counted(prefixes[k]) for k in KINDS[:3] if words.get(k, 0) >= enough}
        made.ordinary = Automaton.counted(prefixes.get("format", {}))
        made.threshold = 0.5
        return made

    def ratio(self, words: list[str]) -> np.ndarray:
        if not self.kinds or not words:
            return np.full(len(words), -np.inf)
        best = np.max([a.score(words) for a in self.kinds.values()], axis=0)
        return (best - self.ordinary.score(words)) / np.array([len(w) for w in words])


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, word) of the words that look long enough to be a credential.

    A word that lies in a base span is known already, and one that an assignment's value meets is its name and value. A
    word of which a run of access or hex letters is only a part is a candidate as a whole.
    """
    found = [(m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text)]
    if spans and found:
        found = [
            x for x in found if not any(a < x[1] and x[0] < b and (kind == 0 or (a <= x[0] and x[1] <= b)) for a, kind, b in spans)
        ]
    return found


class _Sample:
    """The distinct words of least hash."""

    def __init__(self, size: int):
        self.size, self.words = size, {}
        self.most = 1 << 64

    def add(self, word: str) -> None:
        if (h := xxhash.xxh64_intdigest(word, seed=42)) < self.most:
            self.words[h] = word
            if len(self.words) > 4 * self.size:
                self.words = dict(sorted(self.words.items())[: self.size])
                self.most = max(self.words)


def fit(docs: DataFrame, *, text_col: str = "text", sample: int | None = None, longest: int = 128, states: int = 1000) -> FormatModel:
    """The model: what the base patterns find are labelled credentials, other long words the ordinary ones.

    All distinct words of all rows are learnt, cut at `longest` letters (of which the automata learn the first 64). Spark
    counts how many words of a kind go on with each class after each prefix of classes; an automaton is inferred from the
    counts of the prefixes that at least one word in `states` begins with, so it holds `states` of each length at most however
    many words there are, and a rarer prefix goes on from the start. The threshold is counted over all ordinary words.

    With `sample`, a caller's own choice, the distinct words of least hash are fitted instead, so many a kind. No rows, no
    long words: a model that finds nothing.
    """
    if sample is not None:
        return FormatModel(*_least(_distinct_words(docs, text_col, longest, sample), sample))
    words = written(_distinct_words(docs, text_col, longest, None), "secret-words")
    # a word in capitals is a word still
    ordinary = F.col("kind") == "format"
    learnt = words.select("kind", F.explode(F.when(ordinary, F.array("word", F.upper("word"))).otherwise(F.array("word"))).alias("word"))
    totals = {r.kind: r.n for r in learnt.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    model = FormatModel.counted(_prefixes(learnt, totals, states), totals)
    if model.kinds and totals.get("format"):
        model.threshold = max(model.threshold, _exceeded_by_one_in_a_thousand(learnt.filter(ordinary), model, totals["format"]))
    return model


def _distinct_words(docs: DataFrame, text_col: str, longest: int, sample: int | None) -> DataFrame:
    """(kind, word), distinct: credentials by the base pattern that finds them, and the candidates as kind format. With
    `sample`, each task hands on that many of least hash a kind, else those of each batch once."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {k: _Sample(sample) for k in KINDS} if sample is not None else None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = set()
                for text in batch.column(0).slice(at, 256).to_pylist():
                    spans = base_spans(text or "")
                    found.update((KINDS[span[1]], credential(text, span)[:longest]) for span in spans)
                    found.update(("format", word[:longest]) for _, _, word in candidates(text or "", spans))
                if kept is None:
                    yield _words(sorted(found))
                else:
                    for kind, word in found:
                        kept[kind].add(word)
        if kept is not None:
            yield _words([(k, w) for k, x in kept.items() for _, w in sorted(x.words.items())[:sample]])

    rows = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(gather, "kind string, word string")
    return rows.distinct()


def _words(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], ["kind", "word"]
    )


def _least(rows: DataFrame, sample: int) -> tuple[dict[str, list[str]], list[str]]:
    """Credentials by kind and ordinary words: of each the `sample` of least hash, thinned by parts of their hash first, so
    that what one task sees of a kind does not grow with the tasks."""
    unsigned = F.xxhash64("word").bitwiseXOR(F.lit(-(1 << 63)))
    chosen = rows.withColumns({"h": unsigned, "part": F.pmod(F.xxhash64("word"), F.lit(64))})
    for of in (("kind", "part"), ("kind",)):
        least = F.row_number().over(Window.partitionBy(*of).orderBy("h", "word"))
        chosen = chosen.withColumn("n", least).filter(F.col("n") <= sample)
    by_kind: dict[str, list[str]] = {k: [] for k in KINDS}
    for row in chosen.orderBy("kind", "n").collect():
        by_kind[row.kind].append(row.word)
    return {k: by_kind[k] for k in KINDS[:3]}, by_kind["format"]


#: Letters and the digits of their classes, as `translate` takes them; all others are of class 5.
_LETTERS = "".join(chr(i) for i in range(128) if _CLASS[i] < 5)
_DIGITS = "".join(str(_CLASS[ord(c)]) for c in _LETTERS)


def _prefixes(learnt: DataFrame, totals: dict[str, int], states: int) -> dict[str, dict[str, list[int]]]:
    """By kind and prefix of classes: how many words go on with each class, and how many end. Equal words of classes are one
    row before they are cut into prefixes; a prefix of less than one word in `states` is left out, but is in its parent's counts."""
    digits = F.translate(F.regexp_replace("word", "[^A-Za-z0-9]", "/"), _LETTERS + "/", _DIGITS + "5")
    whole = learnt.groupBy("kind", digits.alias("classes")).agg(F.count("*").alias("n"))
    cut = F.least(F.length("classes"), F.lit(DEEPEST))
    steps = whole.select(
        "kind", "n", "classes", F.explode(F.sequence(F.lit(0), cut)).alias("at")
    ).filter((F.col("at") < F.length("classes")) & (F.col("at") < DEEPEST) | (F.col("at") == F.length("classes")))
    goes_on = F.when(F.col("at") == F.length("classes"), F.lit(END)).otherwise(
        F.substring("classes", F.col("at") + 1, F.lit(1)).cast("int"))
    counts = steps.select("kind", "n", F.substring("classes", F.lit(1), F.col("at")).alias("prefix"), goes_on.alias("c")).groupBy(
        "kind", "prefix").agg(*(F.sum(F.when(F.col("c") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(CLASSES + 1)))
    held = sum((F.col(f"c{c}") for c in range(CLASSES + 1)), F.lit(0))
    least = F.lit(0)
    for kind, n in totals.items():
        least = F.when(F.col("kind") == kind, -(-n // states)).otherwise(least)
    found: dict[str, dict[str, list[int]]] = {k: {} for k in KINDS}
    for r in counts.filter(held >= least).collect():
        found[r.kind][r.prefix] = [r[f"c{c}"] for c in range(CLASSES + 1)]
    return found


def _exceeded_by_one_in_a_thousand(ordinary: DataFrame, model: FormatModel, total: int) -> float:
    """The 0.999 quantile of the scores of all ordinary words, interpolated between its neighbours, each to a millionth:
    scores are counted in bins of a thousandth, then those of a neighbour's bin in bins of a millionth."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                yield pa.RecordBatch.from_arrays([pa.array(model.ratio(batch.column(0).slice(at, 4096).to_pylist()))], ["score"])

    scored = written(ordinary.select("word").mapInArrow(score, "score double"), "secret-scores")
    place = 0.999 * (total - 1)

    def bins(rows: DataFrame, a_unit: int) -> list:
        key = F.floor(F.col("score") * a_unit).alias("bin")
        return rows.groupBy(key).agg(F.count("*").alias("n"), F.min("score").alias("least")).orderBy("bin").collect()

    def holding(found: list, k: int) -> tuple:
        """The bin of the score of rank k, and how many come before it."""
        before = 0
        for r in found:
            if k < before + r.n:
                return r, before
            before += r.n
        raise ValueError(f"no score of rank {k}")

    coarse, neighbours = bins(scored, 1000), []
    for k in (math.floor(place), math.ceil(place)):
        r, before = holding(coarse, k)
        fine = bins(scored.filter(F.floor(F.col("score") * 1000) == r.bin), 1_000_000)
        neighbours.append(holding(fine, k - before)[0].least)
    return neighbours[0] + (neighbours[1] - neighbours[0]) * (place - math.floor(place))


def all_spans(model: FormatModel, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
    """Base spans of each text, and the candidates whose score exceeds the threshold as kind 3, sorted."""
    spans = [base_spans(t or "") for t in texts]
    found = [(k, *c) for k, t in enumerate(texts) for c in candidates(t or "", spans[k])]
    for (k, start, end, _), score in zip(found, model.ratio([f[3] for f in found]), strict=True):
        if score > model.threshold:
            spans[k].append((start, 3, end))
    return [sorted(x) for x in spans]


def scan_secrets(docs: DataFrame, model: FormatModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): spans of each whole text by start and then kind, in code points, the end exclusive.

    A map over the rows with a small model: no shuffle. Null or empty text: no spans. Repeated rows: each is scanned.
    A null id stays null. Other columns are not read.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                spans = [
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in x]
                    for x in all_spans(model, part.column(1).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, type=_SPANS)], ["doc_id", "spans"])

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        scan, "doc_id long, spans array<struct<kind:string,start:int,end:int>>"
    )


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def redact(docs: DataFrame, model: FormatModel, *, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with each run of overlapping spans replaced by `mark`; all rows and columns stay, and `n_chars`, if there
    is such a column, is the length of a text that was changed. A null text stays null."""
    names = docs.columns

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = dict(zip(names, part.columns, strict=True))
                texts = columns[text_col].to_pylist()
                sizes = columns["n_chars"].to_pylist() if "n_chars" in columns else None
                for k, spans in enumerate(all_spans(model, texts)):
                    if spans:
                        texts[k] = _masked(texts[k], spans, mark)
                        if sizes:
                            sizes[k] = len(texts[k])
                columns[text_col] = pa.array(texts, type=pa.string())
                if sizes is not None:
                    columns["n_chars"] = pa.array(sizes, type=part.schema.field(names.index("n_chars")).type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(clean, docs.schema)


def _masked(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])
