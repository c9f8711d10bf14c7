"""Exact top-k inner products, pruned by statistics of segments from coarse to fine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medledger.llm.vectors import matrix, vectors

#: Whole numbers below this are exact in a double.
EXACT = float(1 << 53)


def segment_statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of each row's segments, both times the root of the segment's length."""
    cuts = np.linspace(0, x.shape[1], segments + 1).astype(int)[:-1]
    sizes = np.diff(np.append(cuts, x.shape[1]))
    mean = np.add.reduceat(x, cuts, axis=1) / sizes
    square = np.add.reduceat(x * x, cuts, axis=1) / sizes
    return mean * np.sqrt(sizes), np.sqrt(np.maximum(square - mean * mean, 0) * sizes)


def principal_axes(x: np.ndarray) -> np.ndarray:
    """An orthonormal basis, as columns, whose first axes hold most of the rows' squared length."""
    return np.linalg.eigh(x.T @ x)[1][:, ::-1]


def resolutions(dim: int) -> list[int]:
    """Numbers of segments from coarse to fine: 1, 2, 4, ... up to half of the components, then three quarters of them."""
    halves = [1 << k for k in range(dim.bit_length()) if 1 << k <= max(1, dim // 2)]
    return halves + [3 * dim // 4] * (3 * dim // 4 > halves[-1])


class SegmentIndex:
    """Candidates with the statistics of segments at each of the `resolutions`.

    Of two vectors, the squared distance is at least the sum over segments of length * ((difference of means)^2 +
    (difference of deviations)^2). The squares of a vector's own statistics add up to its squared norm, so the upper bound
    of the inner product that follows is the inner product of the statistics: one matrix product a level, tighter the finer
    it is. A turned basis changes no distance; the principal axes of up to `sample` candidates make neighbouring
    components alike in size. Scores come from the vectors as given.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, sample: int = 2048):
        self.ids, self.x = ids, x
        self.basis = principal_axes(x[:sample])
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.scored = 0
        turned, self.levels = x @ self.basis, []
        for n in resolutions(x.shape[1]):
            self.levels.append((n, np.hstack(segment_statistics(turned, n))))

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, candidate id, score) of each query's k best candidates, ties to the smaller id.

        At each level a query's bar is raised to the k-th best exact score among the candidates that the bounds favour, and
        those bounded below it are left; what no level rules out is scored. `scored` counts these.
        """
        step, out = max(1, (1 << 22) // max(1, len(self.ids))), []
        for at in range(0, len(queries), step):
            out.append(self._best(queries[at : at + step], own[at : at + step], k))
            out[-1][0][:] += at
        return tuple(np.concatenate(column) for column in zip(*out, strict=True))

    def _best(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        turned = queries @ self.basis
        rounding = 1e-9 * np.sqrt((queries * queries).sum(axis=1))[:, None] * self.norm + 1e-6
        alive = own[:, None] != self.ids
        bar = np.full(len(queries), -np.inf)
        for n, statistics in self.levels:
            bound = np.hstack(segment_statistics(turned, n)) @ statistics.T
            bound += rounding
            bound[~alive] = -np.inf
            first = np.argpartition(-bound, min(4 * k, bound.shape[1]) - 1, axis=1)[:, : 4 * k]
            if first.shape[1] >= k:
                seen = np.empty(first.shape)
                for q, found in enumerate(first):
                    seen[q] = self.x[found] @ queries[q]
                seen[~np.take_along_axis(alive, first, axis=1)] = -np.inf
                bar = np.maximum(bar, -np.partition(-seen, k - 1, axis=1)[:, k - 1])
            alive &= bound >= bar[:, None]
        asked, found = np.nonzero(alive)
        scores, step = np.empty(len(asked)), max(1, (1 << 22) // self.x.shape[1])
        for at in range(0, len(asked), step):
            part = slice(at, at + step)
            scores[part] = np.einsum("ij,ij->i", queries[asked[part]], self.x[found[part]])
        self.scored += len(scores)
        return first_of_each(asked, self.ids[found], scores, k)


def first_of_each(asked: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Each query's k rows of highest score, ties to the smaller id."""
    order = np.lexsort((ids, -scores, asked))
    asked, ids, scores = asked[order], ids[order], scores[order]
    place = np.arange(len(asked)) - np.searchsorted(asked, asked)
    return asked[place < k], ids[place < k], scores[place < k]


def _exact(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Each query's k best scores in whole numbers of any size, held to the range of a long."""
    whole, limit = np.vectorize(int, otypes=[object])(x), (1 << 63) - 1
    out = []
    for q in range(len(queries)):
        others = ids[ids != own[q]]
        scores = whole[ids != own[q]] @ np.vectorize(int, otypes=[object])(queries[q])
        held = np.array([max(-limit, min(limit, s)) for s in scores], dtype=np.int64)
        out.append(first_of_each(np.full(len(others), q), others, held, k))
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def _blocks(n: str, size: int) -> Column:
    return F.ceil(F.col(n) / size).cast("int")


def top_k(
    table: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: float = 256.0,
    query_block: int = 2048,
    candidate_block: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of the table that `is_query` names, the k rows other than itself
    with the highest inner product of floor(scale * component), ties to the smaller vec_id.

    Queries and candidates meet in blocks of bounded size: each block of candidates meets each block of queries of its
    dimension once, and gives each query at most k rows, which a window with a group limit then merges. The rows of a
    meeting are few and its work is much, so they are dealt to spark.sql.shuffle.partitions tasks that are not merged.

    Vectors that are null or hold null, NaN or infinite components take no part; vectors meet only those with as many
    components; scores of empty vectors are 0. Rows that repeat a vec_id take part one by one, but none is its own
    query's candidate. A null vec_id takes no part. Scores beyond a long are held to its range. No rows: no rows.
    """
    whole = F.transform("v", lambda x: F.floor(F.lit(scale) * x))
    rows = (
        vectors(table.withColumn("_asked", is_query), id_col, vector_col, F.col("_asked").alias("asked"))
        .filter("id is not null")
        .withColumn("v", F.transform(whole, lambda x: x.cast("double")))
    )
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asked").alias("m"))
    blocks = counts.select("dim", _blocks("m", query_block).alias("qs"), _blocks("n", candidate_block).alias("cs"))
    of_query = F.pmod(F.xxhash64("id", "v"), F.col("qs")).cast("int")
    of_candidate = F.pmod(F.xxhash64("v", "id"), F.col("cs")).cast("int")
    asked = rows.filter("asked").join(blocks, "dim").withColumn("q", of_query)
    each_block = F.explode(F.expr("sequence(0, cs - 1)")).alias("c")
    left = asked.select("dim", "q", each_block, F.lit(True).alias("asks"), "id", "v")
    offered = rows.join(blocks.filter("qs > 0"), "dim").withColumn("c", of_candidate)
    each_block = F.explode(F.expr("sequence(0, qs - 1)")).alias("q")
    right = offered.select("dim", each_block, "c", F.lit(False).alias("asks"), "id", "v")

    def meet(block: pa.Table) -> pa.Table:
        a, b = block.filter(block["asks"]), block.filter(pc.invert(block["asks"]))
        columns = [np.zeros(0, np.int64)] * 3
        if a.num_rows and b.num_rows:
            x, y = matrix(a["v"]), matrix(b["v"])
            own, ids = a["id"].to_numpy(), b["id"].to_numpy()
            if x.shape[1] == 0:
                x, y = np.zeros((len(own), 1)), np.zeros((len(ids), 1))
            if np.abs(x).max() * np.abs(y).max() * x.shape[1] >= EXACT:
                asked, found, scores = _exact(x, own, ids, y, k)
            else:
                asked, found, scores = SegmentIndex(ids, y).best(x, own, k)
            columns = [own[asked], found, scores.astype(np.int64)]
        return pa.table([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = left.union(right).repartition(tasks, "dim", "q", "c").groupBy("dim", "q", "c")
    found = met.applyInArrow(meet, "query_id long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
