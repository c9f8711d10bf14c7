"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, exact rerank."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medledger.llm.blocks import BlockLabels
from medledger.llm.common import components, written
from medledger.llm.vectors import finite, matrix


def k_means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centres of a bounded sample; an empty cluster takes the point farthest from its centre."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        d = squared(x, centres)
        own = d.argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        sizes = np.bincount(own, minlength=len(centres))
        empty = np.flatnonzero(sizes == 0)
        centres = sums / np.maximum(sizes, 1)[:, None]
        if len(empty):
            far = np.argsort(-d[np.arange(len(x)), own])[: len(empty)]
            centres[empty] = x[far]
    return centres


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    d = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.maximum(d, 0)


class Quantiser:
    """Coarse centres, and a codebook of residuals for each subspace."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int, words: int, rounds: int = 12, seed: int = 7):
        self.centres = k_means(sample, lists, rounds, seed)
        own = squared(sample, self.centres).argmin(axis=1)
        residual = sample - self.centres[own]
        self.cuts = np.linspace(0, sample.shape[1], min(subspaces, sample.shape[1]) + 1).astype(int)
        self.books = [
            k_means(residual[:, a:b], words, rounds, seed + 1 + i) for i, (a, b) in enumerate(self.spans())
        ]

    def spans(self) -> list[tuple[int, int]]:
        return list(zip(self.cuts[:-1], self.cuts[1:], strict=True))

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, residual codes, and distance to what the code stands for, of each row."""
        own = squared(x, self.centres).argmin(axis=1)
        residual = x - self.centres[own]
        codes = np.empty((len(x), len(self.books)), dtype=np.uint8)
        error = np.zeros(len(x))
        for i, ((a, b), book) in enumerate(zip(self.spans(), self.books, strict=True)):
            d = squared(residual[:, a:b], book)
            codes[:, i] = d.argmin(axis=1)
            error += d[np.arange(len(x)), codes[:, i]]
        return own, codes, np.sqrt(error)

    def probes(self, x: np.ndarray, reach: float) -> np.ndarray:
        """probes[i, c]: list c may hold a row within `reach` of row i.

        A row of list c is nearer to c's centre than to that of i's own list; if it is within reach of i, then i is
        within reach of the plane between the two centres. So the probes are sufficient: none is left out.
        """
        d = squared(x, self.centres)
        own = d.argmin(axis=1)
        apart = np.sqrt(squared(self.centres, self.centres))[own]
        beyond = (d - d[np.arange(len(x)), own][:, None]) / np.maximum(2 * apart, 1e-12)
        return (beyond <= reach + 1e-9) | (apart == 0)

    def tables(self, x: np.ndarray, centre: int) -> list[np.ndarray]:
        """Asymmetric distances: squared, of each row to each word of each subspace, in the list of a centre."""
        residual = x - self.centres[centre]
        return [squared(residual[:, a:b], book) for (a, b), book in zip(self.spans(), self.books, strict=True)]


def near_duplicate_vectors(
    table: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    lists: int = 64,
    subspaces: int = 8,
    words: int = 256,
    sample: int = 8192,
    block: int = 2048,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row: links are other rows with cosine >= `cosine` in doubles.

    The quantiser is fitted on a bounded sample, the `sample` distinct vectors of least hash; every row is indexed. Unit
    vectors with that cosine are within sqrt(2 - 2 * cosine). A row is compared with its own list and, as a guest, with
    each earlier list that may hold a row so near (later lists send their rows to it instead, so each pair of lists
    meets once). In a list, table look-ups give each guest's distance to each member's code; a member whose code is
    farther than the reach and its own coding error cannot be linked, and the cosine of the others is computed exactly.
    So no link is lost to the codes. A list of over `block` members is dealt out in blocks.

    Equal vectors are one class: they are compared once, and counted as often as they occur. Each block yields counts
    and a spanning set of links, never all pairs.

    Vectors that are null, zero, or hold null, NaN or infinite components link with nothing: n_links 0, their own
    component, kept. Vectors of different dimensions don't link. Repeated ids: one row each, by its own vector. A null id: no links, a null component. No rows: none. Other columns are not read.
    """
    spark = table.sparkSession
    v = F.col("v")
    rows = table.select(
        table[id_col].cast("long").alias("id"), table[vector_col].cast("array<double>").alias("v")
    ).withColumn("fit", F.coalesce(finite(v) & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col("id").isNotNull())
    linkable = rows.filter("fit")
    grouped = linkable.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    # A class has a number of its own, fixed by the written table: two vectors may stand under one id.
    classes = written(
        grouped.withColumns({"dim": F.size("v"), "id": F.monotonically_increasing_id()}), "vector-classes"
    )
    found = None
    for (dim,) in classes.select("dim").distinct().orderBy("dim").collect():  # one pass each; tables have one dimension
        part = _links_of(spark, classes.filter(F.col("dim") == dim), cosine, lists, subspaces, words, sample, block)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], _FOUND)
    found = written(found, "vector-links")
    nodes = classes.select("id")
    joined = components(nodes, found.filter("b is not null").select("a", "b"))
    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "id")
    named = classes.join(joined.withColumnRenamed("component_id", "root"), "id")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = (
        named.join(least, "root")
        .join(counts, "id", "left")
        .select("v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    )
    linked = linkable.select("id", "v").join(known, "v").select("id", "n_links", "component_id")
    alone = rows.filter("not fit").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.union(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    return every.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept)


_FOUND = "a long, b long, n long"


def _links_of(
    spark: SparkSession,
    classes: DataFrame,
    cosine: float,
    lists: int,
    subspaces: int,
    words: int,
    sample: int,
    block: int,
) -> DataFrame:
    """Rows (a, null, n): n more links of a; rows (a, b, null): a and b are in one component."""
    chosen = classes.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).toArrow()
    fitted = Quantiser(_unit(matrix(chosen["v"])), lists, subspaces, words)
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6
    model = spark.sparkContext.broadcast(fitted)  # its size depends on the parameters alone

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each list that a vector is compared in; guest in those that are not its own."""
        q = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                raw = matrix(part.column(2))
                x = _unit(raw)
                own = squared(x, q.centres).argmin(axis=1)
                wanted = q.probes(x, reach)
                wanted &= np.arange(len(q.centres))[None, :] < own[:, None]
                wanted[np.arange(len(x)), own] = True
                r, c = np.nonzero(wanted)
                columns = [pa.array(c.astype(np.int32)), pa.array(c != own[r])]
                columns += [part.column(k).take(pa.array(r)) for k in range(3)]
                yield pa.RecordBatch.from_arrays(columns, ["list", "guest", "id", "copies", "v"])

    placed = written(
        classes.select("id", "copies", "v").mapInArrow(
            assign, "list int, guest boolean, id long, copies long, v array<double>"
        ),
        "vector-lists",
    )
    sizes = placed.filter("not guest").groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # A guest meets every block of the list; a member is also a guest of the blocks after its own.
    dealt = placed.join(F.broadcast(sizes), "list").withColumn("own", F.when(F.col("guest"), -1).otherwise(own))
    dealt = dealt.withColumn("at", F.explode(F.expr("sequence(greatest(own, 0), blocks - 1)")))
    dealt = dealt.select("list", "at", (F.col("own") != F.col("at")).alias("guest"), "id", "copies", "v")
    sorted_rows = dealt.repartition("list", "at").sortWithinPartitions("list", "at", "guest", "id")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of a block come first and are held; its guests stream past them."""
        q, here = model.value, None
        for batch in batches:
            for part in _by_block(batch):
                if here is None or here.name != (part.column(0)[0].as_py(), part.column(1)[0].as_py()):
                    if here is not None:
                        yield here.close()
                    here = _Block(q, part, cosine, reach)
                yield from here.add(part)
        if here is not None:
            yield here.close()

    return sorted_rows.mapInArrow(compare, _FOUND)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large or small components neither overflow nor vanish.
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), np.finfo(float).tiny) if len(x) else x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    names = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
    change = np.any([n[1:] != n[:-1] for n in names], axis=0)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


class _Block:
    """The members of one block of a list, which guests are compared with."""

    def __init__(self, quantiser: Quantiser, first: pa.RecordBatch, cosine: float, reach: float):
        self.quantiser, self.cosine, self.reach = quantiser, cosine, reach
        self.name = (first.column(0)[0].as_py(), first.column(1)[0].as_py())
        self.parts: list[tuple] = []
        self.ready = False

    def add(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = (part.column(3).to_numpy(), part.column(4).to_numpy(), _unit(matrix(part.column(5))))
        if not part.column(2)[0].as_py():
            self.parts.append(rows)
            return
        self._begin()
        if len(self.ids):
            yield self._meet(*rows, among=False)

    def _begin(self) -> None:
        if self.ready:
            return
        self.ready = True
        some = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        self.ids, self.copies, self.x = some or (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0)))
        if len(self.ids):
            _, self.codes, self.error = self.quantiser.code(self.x)
            self.labels = BlockLabels(self.ids)
        self.more = np.zeros(len(self.ids), dtype=np.int64)

    def _meet(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray, among: bool) -> pa.RecordBatch:
        found, counts = [], np.zeros(len(ids), dtype=np.int64)
        for a in range(0, len(ids), 256):
            part = slice(a, a + 256)
            far = 0
            for table, code in zip(self.quantiser.tables(x[part], self.name[0]), self.codes.T, strict=True):
                far = far + table[:, code]
            r, c = np.nonzero(far <= (self.reach + self.error[None, :] + 1e-9) ** 2)
            if among:
                r, c = r[c != r + a], c[c != r + a]
            exact = np.zeros(len(r), dtype=bool)
            for s in range(0, len(r), 8192):  # near copies may be many, and each pair is two whole vectors
                some = slice(s, s + 8192)
                exact[some] = np.einsum("ij,ij->i", x[part][r[some]], self.x[c[some]]) >= self.cosine
            r, c = r[exact], c[exact]
            np.add.at(counts, r + a, self.copies[c])
            if not among:
                np.add.at(self.more, c, copies[part][r])
            linked = np.zeros((len(ids[part]), len(self.ids)), dtype=bool)
            linked[r, c] = True
            found.append(self.labels.link(ids[part], linked))
        pairs = np.concatenate(found)
        has = counts > 0
        return _rows(ids[has], counts[has], pairs)

    def close(self) -> pa.RecordBatch:
        self._begin()
        if not len(self.ids):
            return _rows(self.ids, self.more, np.empty((0, 2), dtype=np.int64))
        own = self._meet(self.ids, self.copies, self.x, among=True)
        has = self.more > 0
        more = _rows(self.ids[has], self.more[has], np.empty((0, 2), dtype=np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([a, b]) for a, b in zip(own.columns, more.columns, strict=True)], own.schema.names
        )


def _rows(ids: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
    none = lambda n: pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([ids, pairs[:, 0]])),
            pa.concat_arrays([none(len(ids)), pa.array(pairs[:, 1])]),
            pa.concat_arrays([pa.array(counts), none(len(pairs))]),
        ],
        ["a", "b", "n"],
    )
