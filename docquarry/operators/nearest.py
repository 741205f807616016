"""Nearest rows by exact cosine: rows meet the queries as matrices, in Arrow batches.

A matrix product only sorts out what is surely too far. What is left is scored
as ``vectors.cosine`` does it, in the same order of additions, so that equal
vectors have equal scores and ties go to the smaller key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from docquarry import scratch
from docquarry.functions import vectors as V

ROWS, QUERIES = 1024, 1024  # sides of a matrix of scores, 8 MB
SLACK = 1e-9  # far over the error of a matrix product of unit vectors
TASK = 2_000_000_000  # products of components that are worth a task


def summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of products, added from the first component to the last; the components come first."""
    total = np.zeros(a.shape[1])
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def unit(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """The vectors at length 1; NaN, which nothing sorts out, where the product could be far off."""
    sound = (norms > 1e-140) & (norms < 1e140)
    return np.where(sound[:, None], vectors / np.where(sound, norms, 1)[:, None], np.nan)


def codes(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1] if keys.dtype == object else keys


def without_far_copies(keys: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that can be among the k nearest of any query: of equal vectors those of the k + 1 smallest keys."""
    flat = np.ascontiguousarray(vectors)
    same = np.unique(flat.view(np.dtype((np.void, flat.dtype.itemsize * flat.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    if len(same) == 0 or same.max() + 1 == len(same):
        return np.arange(len(same))
    own = codes(keys)
    order = np.lexsort((own, same))
    group, key = same[order], own[order]
    opens = np.r_[True, group[1:] != group[:-1]]
    fresh = np.cumsum(opens | np.r_[True, key[1:] != key[:-1]])
    rank = fresh - np.maximum.accumulate(np.where(opens, fresh, 0))
    return np.sort(order[rank <= k])


class Best:
    """The k nearest rows so far of each query; a score that is NaN stands before all others."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, k: int):
        self.keys, self.k = keys, k
        self.columns = np.ascontiguousarray(vectors.T)
        self.norms = np.sqrt(summed(self.columns, self.columns))
        self.units = unit(vectors, self.norms)
        self.near = np.full((len(keys), k), "" if keys.dtype == object else 0, dtype=keys.dtype)
        self.score = np.full((len(keys), k), -np.inf)

    def meet(self, keys: np.ndarray, vectors: np.ndarray, asked: np.ndarray | None = None) -> None:
        """Rows are held against all queries, or those at the places asked."""
        left = without_far_copies(keys, vectors, self.k)
        asked = np.arange(len(self.keys)) if asked is None else asked
        for at in range(0, len(left), ROWS):
            part = left[at : at + ROWS]
            own, v = keys[part], vectors[part]
            columns = np.ascontiguousarray(v.T)
            norms = np.sqrt(summed(columns, columns))
            units = unit(v, norms)
            for b in range(0, len(asked), QUERIES):
                self._block(asked[b : b + QUERIES], own, columns, norms, units)

    def _block(self, some: np.ndarray, keys: np.ndarray, columns: np.ndarray, norms: np.ndarray, units: np.ndarray) -> None:
        scores = self.units[some] @ units.T
        least = self.score[some, -1] - SLACK
        short = np.isneginf(least)
        if short.any():  # the place after which nothing of these rows can be among the k, as a row may be the query's own
            ordered = np.sort(keys)
            mine = self.keys[some][short]
            place = self.k + int((np.searchsorted(ordered, mine, "right") - np.searchsorted(ordered, mine, "left")).max())
            if place < len(keys):
                sure = np.nan_to_num(scores[short], copy=True, nan=-np.inf)  # NaN may stand for no score at all
                least[short] = np.partition(sure, len(keys) - place, axis=1)[:, len(keys) - place] - 2 * SLACK
        q, r = np.nonzero(~(scores < least[:, None]))
        q = some[q]
        other = self.keys[q] != keys[r]
        q, r = q[other], r[other]
        for at in range(0, len(q), ROWS * QUERIES // 8):
            self._merge(q[at : at + ROWS * QUERIES // 8], r[at : at + ROWS * QUERIES // 8], keys, columns, norms)

    def _merge(self, q: np.ndarray, r: np.ndarray, keys: np.ndarray, columns: np.ndarray, norms: np.ndarray) -> None:
        total = np.zeros(len(q))
        for x, y in zip(self.columns, columns, strict=True):
            total += x[q] * y[r]
        size = self.norms[q] * norms[r]
        real = ~(size <= 0)
        q, score, near = q[real], (total[real] / size[real]), keys[r[real]]
        score = np.where(np.isnan(score), np.inf, score)
        better = score >= self.score[q, -1]
        q, score, near = q[better], score[better], near[better]
        if not len(q):
            return
        met = np.unique(q)
        every = np.concatenate([np.repeat(met, self.k), q])
        score = np.concatenate([self.score[met].ravel(), score])
        near = np.concatenate([self.near[met].ravel(), near])
        order = np.lexsort((codes(near), -score, every))
        sorted_q = every[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_q, sorted_q, "left")
        kept = order[rank < self.k]
        self.score[met] = score[kept].reshape(-1, self.k)
        self.near[met] = near[kept].reshape(-1, self.k)

    def found(self, rows: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        step = max(1, rows // self.k)
        for at in range(0, len(self.keys), step):
            score = self.score[at : at + step]
            q, place = np.nonzero(score > -np.inf)
            s = score[q, place]
            yield self.keys[at : at + step][q], self.near[at : at + step][q, place], np.where(np.isinf(s), np.nan, s)


def matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, vectors) for each length of the lists; null and empty ones are left out."""
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(size) - size
    for d in np.unique(size[size > 0]):
        at = np.flatnonzero(size == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def plain(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def numbered(rows: DataFrame, column: str) -> DataFrame:
    """The rows whose vector has a number at every place, as doubles."""
    v = F.col(column)
    return rows.withColumn(column, V.doubles(v)).where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull()))


def tasks(spark, products: float) -> int:
    """How many tasks a search is dealt to: as many as its work is worth, and no more than keep all cores busy, since each ends with k rows a query."""
    return int(min(max(1, -(-products // TASK)), max(12, 2 * spark.sparkContext.defaultParallelism)))


def scanned(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, key, similarity): for each task of ``rows`` (key, _v, and maybe cell) the k nearest of each query (query_id, _q, and maybe cells).

    The queries, a block of bounded size, are read here and go to every task. With
    cells, a row meets the queries that have its cell among theirs; rows of a cell
    should follow each other.
    """
    spark = rows.sparkSession
    key, by_cell = rows.columns[0], "cell" in rows.columns
    read = queries.toArrow().combine_chunks()
    block = {}
    if read.num_rows:
        keys = plain(read["query_id"])
        near = list(read["cells"].to_pylist()) if by_cell else None
        for at, vectors in matrices(read["_q"].combine_chunks()):
            block[vectors.shape[1]] = (keys[at], vectors, np.array([near[i] for i in at], dtype="int32") if by_cell else None)
    scratch.ship(spark)
    held = spark.sparkContext.broadcast(block)
    out = StructType([StructField("query_id", queries.schema["query_id"].dataType), StructField(key, rows.schema[key].dataType), StructField("similarity", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        with np.errstate(all="ignore"):
            for batch in batches:
                keys = plain(batch.column(0))
                cells = plain(batch.column(2)) if by_cell else None
                for at, vectors in matrices(batch.column(1)):
                    d = vectors.shape[1]
                    if d not in held.value:
                        continue
                    if d not in best:
                        ids, asked, near = held.value[d]
                        best[d] = Best(ids, asked, k)
                        if by_cell:
                            order = np.argsort(near, axis=None, kind="stable")
                            lists[d] = near.ravel()[order], order // near.shape[1]
                    if not by_cell:
                        best[d].meet(keys[at], vectors)
                        continue
                    own = cells[at]
                    for c in np.unique(own):
                        a, b = np.searchsorted(lists[d][0], [c, c + 1])
                        here = np.flatnonzero(own == c)
                        best[d].meet(keys[at[here]], vectors[here], lists[d][1][a:b])
            for b in best.values():
                for q, near, score in b.found():
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(near), pa.array(score)], names=["query_id", key, "similarity"])

    return rows.mapInArrow(run, out)
