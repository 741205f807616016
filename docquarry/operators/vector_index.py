"""An inverted-file index over vectors: cells around k-means centres, of which a query reads the nearest few."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docquarry import scratch
from docquarry.functions import vectors as V
from docquarry.operators import nearest

CELL = 1_000  # vectors of a cell, about
MOST_CELLS = 4_096
SAMPLE = 100  # vectors a centre that the centres are fitted to
QUERY_BLOCK = 8_000_000  # numbers of queries and of their cells that one scan holds, 64 MB


@dataclass(frozen=True)
class Index:
    """rows: (cell, key, vector), every valid vector once; centres: one row of numbers for each cell."""

    rows: DataFrame
    centres: np.ndarray
    key: str
    column: str


def fitted(points: np.ndarray, cells: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Centres of length 1 by k-means on the cosine; a cell that loses all its points keeps its centre."""
    centres = points[np.random.default_rng(seed).choice(len(points), cells, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(points[at : at + 4096] @ centres.T).argmax(axis=1) for at in range(0, len(points), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def build(vectors: DataFrame, cells: int | None = None, key: str = "vec_id", column: str = "embedding") -> Index:
    """The index of all vectors that are not null, empty or zero. Centres are fitted to a sample of bounded size; every row is assigned."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key), V.l2_normalised(F.col(column)).cast("array<double>").alias("_v")).where(F.col("_v").isNotNull() & (V.norm(F.col("_v")) > 0))
    total = rows.count()
    cells = min(MOST_CELLS, max(1, total // CELL) if cells is None else cells, max(1, total))
    share = min(1.0, 2.0 * SAMPLE * cells / max(1, total))
    picked = rows.where(F.pmod(F.xxhash64(key, F.lit(9)), F.lit(1 << 20)) < F.lit(share * (1 << 20))).orderBy(F.xxhash64(key), key).limit(SAMPLE * cells).select("_v").toArrow()
    points = picked["_v"].combine_chunks().flatten().to_numpy().reshape(picked.num_rows, -1) if picked.num_rows else np.zeros((0, 1))
    centres = fitted(points, min(cells, len(points))) if len(points) else points
    scratch.ship(spark)
    held = spark.sparkContext.broadcast(centres)  # at most MOST_CELLS rows

    @F.pandas_udf("int")
    def cell(vs):
        import pandas as pd

        return pd.Series((np.stack(vs.to_numpy()) @ held.value.T).argmax(axis=1).astype("int32")) if len(vs) else pd.Series([], dtype="int32")

    placed = rows.withColumn("cell", cell("_v")) if len(points) else rows.withColumn("cell", F.lit(0))
    return Index(scratch.materialize(placed.select("cell", key, "_v"), "cells"), centres, key, column)


def search(index: Index, queries: DataFrame, probes: int | None = None, k: int = 10, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, key, similarity): the k nearest of each query in the ``probes`` nearest cells (by default a fifth, ten at least).

    Rows are dealt by cell and key, so that a large cell is several tasks; blocks
    of queries, of about ``block`` numbers, go to all tasks, and a row meets those
    that probe its cell as a matrix.
    """
    key, n, spark = index.key, len(index.centres), queries.sparkSession
    probes = min(max(1, n), max(10, math.ceil(n / 5)) if probes is None else probes)
    held = spark.sparkContext.broadcast(index.centres)

    @F.pandas_udf("array<int>")
    def cells(vs):
        import pandas as pd

        if not len(vs):
            return pd.Series([], dtype=object)
        near = np.stack(vs.to_numpy()) @ held.value.T
        return pd.Series(list(np.argsort(-near, axis=1, kind="stable")[:, :probes].astype("int32")))

    q = queries.select(F.col(key).alias("query_id"), V.l2_normalised(F.col(index.column)).cast("array<double>").alias("_q")).where(F.col("_q").isNotNull() & (V.norm(F.col("_q")) > 0))
    asked = q.withColumn("cells", cells("_q") if n else F.array(F.lit(0))).where(F.col("query_id").isNotNull())
    sizes = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("_q")), F.lit(0)).alias("numbers")).first()
    blocks = max(1, -(-(sizes.numbers + sizes.n * probes) // block))
    parts = nearest.tasks(spark, sizes.numbers / blocks * index.rows.count() * probes / max(1, n))
    rows = index.rows.where(F.col(key).isNotNull()).select(key, "_v", "cell").repartitionByRange(parts, "cell", key).sortWithinPartitions("cell")
    dealt = F.pmod(F.xxhash64("query_id", F.lit(5)), F.lit(blocks))
    scored = reduce(DataFrame.unionByName, [nearest.scanned(rows, asked if blocks == 1 else asked.where(dealt == i), k) for i in range(blocks)])
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("similarity"), key))
    return scored.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", key, "similarity")
