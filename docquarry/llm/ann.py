"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are scaled to length 1, so the largest cosine is the least distance d.
A Gaussian (2-stable) projection to a few dimensions turns a distance d into
one whose square is d^2 times a chi-square variable. Candidates are read in the
order of projected distance and verified on the full vectors; a query stops
when the next projected distance is so large that, by the chi-square law, a
nearer neighbour than its k-th best would have been met with the wanted chance.

Vectors are dealt to the leaves of a kd-tree that is fitted to a bounded sample
of projections; every vector is indexed. A leaf with more rows than a task
should hold is cut into shards by a hash. In a task the shard's own kd-tree is
built and read leaf by leaf, nearest box first. A query first visits one shard
of its own leaf, which bounds its k-th distance; it then goes only to shards
whose box passes the same test. The queries that visit a shard are dealt in
blocks of bounded size, each a group of its own with the shard's rows; nothing
that grows with the data is broadcast or collected.

Equal vectors have equal scores, and ties go to the smaller id; so of rows with
one vector only those of the k + 1 smallest ids can be among the k nearest of
any query. The others are not indexed, which is exact, and keeps a vector that
is very common from filling shards that all its own queries would have to visit.

Cases: a null, empty or zero vector and one with a null or non-finite component
takes no part, nor does one whose dimension is not the table's most common (a
cosine needs equal dimensions); a null vec_id takes no part; repeated rows of an
id are candidates each, and an id is never its own candidate; rows of one query
id are one query, that of its least vector; ties go to the smaller id; with
fewer candidates than asked for all are returned; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docquarry import scratch

DIMS = 8
SHARD = 20_000  # rows of a shard, about
MOST_LEAVES = 65_536
SAMPLE = 200_000  # projections that the leaves are fitted to, of 8 numbers each
BLOCK = 4_096  # queries that visit a shard together
MOST_CELLS = 16_000_000  # distances of queries to boxes that are made at once
TREE_LEAF = 128
CHANCE = 0.97  # that a true neighbour is met before a query stops
SEED = 11
FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, dims: int) -> float:
    """x with P(chi-square of an even number of dims <= x) = p."""
    half = dims // 2

    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, half):
            term *= x / 2 / i
            total += term
        return 1.0 - math.exp(-x / 2) * total

    lo, hi = 0.0, 1.0
    while below(hi) < p:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def projection(dim: int, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, dims))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


class Boxes:
    """A kd-tree over points: leaves as index arrays and their bounding boxes."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            own = stack.pop()
            spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(1)
            axis = int(spread.argmax())
            if len(own) <= leaf or spread[axis] == 0:
                self.leaves += [own[i : i + 8 * leaf] for i in range(0, max(1, len(own)), 8 * leaf)]
                continue
            half = len(own) // 2
            order = np.argpartition(points[own, axis], half)
            stack += [own[order[:half]], own[order[half:]]]
        self.low = np.array([points[x].min(axis=0) for x in self.leaves])
        self.high = np.array([points[x].max(axis=0) for x in self.leaves])


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        gap = np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0.0)
        out += gap * gap
    return out


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """In double precision, each from its own two vectors alone, so equal vectors have equal scores."""
    scale = np.sqrt(np.einsum("ij,ij->i", vectors, vectors)) * math.sqrt(float(np.einsum("i,i->", query, query)))
    return np.einsum("ij,j->i", vectors, query) / scale


class Shard:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.units = unit(self.vectors)
        self.tree = Boxes(self.units @ matrix, TREE_LEAF)

    def search(self, ids: np.ndarray, vectors: np.ndarray, bounds: np.ndarray, k: int, quantile: float, matrix: np.ndarray) -> list[tuple[int, int, float]]:
        """The k best for each query, given a bound on its k-th squared distance. Rounds read each query's next nearest leaf; queries of a leaf go together."""
        units = unit(vectors)
        far = box_distances(units @ matrix, self.tree.low, self.tree.high)
        order = np.argsort(far, axis=1, kind="stable")
        best = [np.empty(0) for _ in ids]  # similarities, at most k
        rows: list[list[np.ndarray]] = [[] for _ in ids]
        bound = bounds.copy()
        active = np.arange(len(ids))
        for step in range(far.shape[1]):
            leaf = order[active, step]
            going = far[active, leaf] <= bound[active] * quantile
            active, leaf = active[going], leaf[going]
            if not len(active):
                break
            for at in np.unique(leaf):
                own, qs = self.tree.leaves[at], active[leaf == at]
                sims = units[qs] @ self.units[own].T
                for q, s in zip(qs, sims, strict=True):
                    s = np.where(self.ids[own] == ids[q], -9.0, s)
                    near = s >= 1.0 - bound[q] / 2 - 1e-9
                    if near.any():
                        rows[q].append(own[near])
                        joined = np.concatenate([best[q], s[near]])
                        best[q] = np.sort(joined)[-k:]
                        if len(best[q]) == k:
                            bound[q] = min(bound[q], max(0.0, 2 - 2 * float(best[q][0])) + 1e-12)
        out = []
        for q, parts in enumerate(rows):
            if parts:
                own = np.sort(np.concatenate(parts))
                own = own[self.units[own] @ units[q] >= (best[q][0] if len(best[q]) == k else -2.0) - 1e-9]
                score = cosines(vectors[q], self.vectors[own])
                for i in np.lexsort((self.ids[own], -score))[:k]:
                    out.append((int(ids[q]), int(self.ids[own[i]]), float(score[i])))
        return out


def valid(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    v = F.col(column).cast("array<double>")
    ok = F.col(id_column).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")).where(ok)


def search(vectors: DataFrame, every: int = 50, k: int = 5, id_column: str = "vec_id", column: str = "embedding", chance: float = CHANCE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row whose id is divisible by ``every``, by cosine."""
    spark = vectors.sparkSession
    scratch.ship(spark)
    rows = valid(vectors, id_column, column)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = sizes[0]["d"], sizes[0]["count"]
    rows = rows.where(F.size("v") == dim)
    matrix, quantile = projection(dim), chi_square_quantile(chance, DIMS)

    def projected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = unit(np.stack(b["v"].to_numpy())) @ matrix if len(b) else np.zeros((0, DIMS))
            yield pd.DataFrame({"p": list(p)})

    # the shallow tree: planes fitted to a sample of bounded size, projected by the executors
    place = F.xxhash64("vec_id", "v")
    wanted = min(1.0, SAMPLE / total)
    picked = rows.where(F.pmod(place, F.lit(1 << 30)) <= F.lit(wanted * (1 << 30))).mapInPandas(projected, "p array<double>").limit(2 * SAMPLE).toArrow()
    sample = picked["p"].combine_chunks().flatten().to_numpy().reshape(-1, DIMS) if picked.num_rows else np.zeros((1, DIMS))
    leaves = min(MOST_LEAVES, max(1, total // SHARD))
    tree = spark.sparkContext.broadcast(split_planes(sample, max(0, math.ceil(math.log2(leaves)))))  # at most 2 * MOST_LEAVES planes

    def leaf_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = unit(np.stack(b["v"].to_numpy())) @ matrix if len(b) else np.zeros((0, DIMS))
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": b["v"], "p": list(p), "leaf": descend(p, tree.value)})

    # what can be found: of each vector the k + 1 smallest ids, of an id k rows; both limits apply before the shuffle too
    own = rows.withColumn("_n", F.row_number().over(W.partitionBy("v", "vec_id").orderBy("vec_id"))).where(F.col("_n") <= k)
    own = own.withColumn("_n", F.dense_rank().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("_n") <= k + 1).drop("_n")
    kept = scratch.materialize(own.mapInPandas(leaf_of, "vec_id long, v array<double>, p array<double>, leaf int"), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    counts = {r["leaf"]: r["count"] for r in kept.groupBy("leaf").count().collect()}  # at most MOST_LEAVES rows
    first, shards, at = {}, {}, 0
    for leaf in sorted(counts):
        first[leaf], shards[leaf] = at, -(-counts[leaf] // SHARD)
        at += shards[leaf]
    table = F.broadcast(spark.createDataFrame([(leaf, first[leaf], shards[leaf]) for leaf in sorted(counts)], "leaf int, first int, shards int"))  # at most MOST_LEAVES rows of three numbers
    shard = (F.col("first") + F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("shards")).cast("int")).alias("shard")
    indexed = kept.join(table, "leaf").select("vec_id", "v", shard)
    # the boxes of leaves, by their extremes in each dimension
    span = kept.groupBy("leaf").agg(*(f(F.col("p")[i]).alias(f"{n}{i}") for i in range(DIMS) for f, n in ((F.min, "a"), (F.max, "b")))).collect()
    span.sort(key=lambda r: r["leaf"])
    low, high = (np.array([[r[f"{n}{i}"] for i in range(DIMS)] for r in span]) for n in "ab")
    boxes = spark.sparkContext.broadcast((low, high, np.array([first[r["leaf"]] for r in span]), np.array([shards[r["leaf"]] for r in span])))

    def read(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(own):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        made = Shard(own["vec_id"].to_numpy(), np.stack(own["v"].to_numpy()), matrix)
        found = made.search(asked["query_id"].to_numpy(), np.stack(asked["query"].to_numpy()), asked["bound"].to_numpy().copy(), k, quantile, matrix)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    def visit(asked: DataFrame) -> DataFrame:
        """Each shard with its queries, in as many blocks as they need; ``asked`` (shard, query_id, query, bound)."""
        blocks = asked.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
        dealt = asked.join(blocks, "shard").select("shard", F.pmod(F.xxhash64("query_id", F.lit(7)), F.col("blocks")).cast("int").alias("block"), "query_id", "query", "bound")
        candidates = indexed.join(blocks, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "v")
        return dealt.groupBy("shard", "block").cogroup(candidates.groupBy("shard", "block")).applyInPandas(read, FOUND)

    placed = queries.mapInPandas(leaf_of, "vec_id long, v array<double>, p array<double>, leaf int").join(table, "leaf", "left")
    # a query whose own leaf is empty of candidates starts anywhere
    asked = scratch.materialize(placed.select(F.coalesce(shard, F.lit(0)).alias("shard"), F.col("vec_id").alias("query_id"), F.col("v").alias("query"), "p"), "queries")
    near = scratch.materialize(visit(asked.select("shard", "query_id", "query", F.lit(4.0).alias("bound"))), "near")

    def further(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high, first, shards = boxes.value
        for whole in batches:
            for at in range(0, len(whole), step := max(1, MOST_CELLS // len(low))):
                b = whole.iloc[at : at + step]
                far = box_distances(np.stack(b["p"].to_numpy()), low, high)
                q, leaf = np.nonzero(far <= b["bound"].to_numpy()[:, None] * quantile)
                i = np.repeat(q, shards[leaf])
                nth = np.arange(len(i)) - np.repeat(np.cumsum(shards[leaf]) - shards[leaf], shards[leaf])
                to = np.repeat(first[leaf], shards[leaf]) + nth
                new = to != b["shard"].to_numpy()[i]
                i, to = i[new], to[new]
                yield pd.DataFrame({"shard": to.astype(np.int32), "query_id": b["query_id"].to_numpy()[i], "query": b["query"].to_numpy()[i], "bound": b["bound"].to_numpy()[i]})

    kth = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s"))
    bound = F.when(F.col("n") >= k, 2 - 2 * F.col("s") + 1e-9).otherwise(4.0)
    bounded = asked.join(kth, "query_id", "left").select("shard", "query_id", "query", "p", bound.alias("bound"))
    more = visit(scratch.materialize(bounded.mapInPandas(further, "shard int, query_id long, query array<double>, bound double"), "visits"))
    ranked = near.union(more).withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def split_planes(points: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level, the axis and the cut of each node (all nodes of a level are split)."""
    groups, out = [points], []
    for _ in range(depth):
        axes, cuts, then = [], [], []
        for g in groups:
            axis = int(np.ptp(g, axis=0).argmax()) if len(g) else 0
            cut = float(np.median(g[:, axis])) if len(g) else 0.0
            axes.append(axis)
            cuts.append(cut)
            then += [g[g[:, axis] < cut], g[g[:, axis] >= cut]] if len(g) else [g, g]
        groups = then
        out.append((np.array(axes), np.array(cuts)))
    return out


def descend(points: np.ndarray, planes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    node = np.zeros(len(points), dtype=np.int32)
    for axes, cuts in planes:
        right = points[np.arange(len(points)), axes[node]] >= cuts[node]
        node = (2 * node + right).astype(np.int32)
    return node
