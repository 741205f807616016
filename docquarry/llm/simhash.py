"""Near duplicates by SimHash and the generalised pigeonhole principle.

Fingerprints are grouped first, so a text that occurs a million times is one
node. Bits that are correlated over a bounded sample of fingerprints go to one
partition; with partitions of m blocks the thresholds t_i of the blocks need
only sum to (tau - m + 1), where -1 leaves a block out, and a dynamic programme
gives each block the threshold that the estimated candidates and probes make
cheapest. A fingerprint is probed under every value within t_i of its block;
candidates are verified on all 64 bits. The plan changes the cost alone: every
plan finds every pair.

A block value that more than ``crowd`` fingerprints share is not paired up.
Two fingerprints differ in at most 2 bits exactly if they share a centre, a
value that differs from both in at most one bit, and all fingerprints around a
centre are linked. So those go to their 65 centres and are linked to the
least one there: no group is larger than 65 and no link is lost. For wider
thresholds a crowd is dealt on by further blocks (see ``crowded``).

Sizes of groups, names of components and the like are written before they are
joined back to rows, so both sides of such a join are dealt for it alone: then a
fingerprint or component that a third of all rows share is split over tasks by
the engine's adaptive skew join.

Cases: a null or empty text and one without words have fingerprint zero and are
linked like any other; a text of fewer words than a shingle is one shingle;
repeated rows are rows of their own with one component; null doc_ids are passed
on and never become a component's name unless it has no other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.llm import common, components

BITS = 64
SEED = 42
SAMPLE = 4096  # fingerprints that the cost of plans is estimated on
CROWD = 48

_BYTES = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def fingerprint(text: str, width: int = 3) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit integer."""
    words = text.encode().lower().split()  # bytes: A-Z alone are lowered, ASCII white space alone separates
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        line, ends, at = b" ".join(words), [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends[: len(words) - width])]
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[width - 1 :], strict=True)]
    h = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(h[:, i], minlength=256) @ _BYTES for i in range(8)])
    bits = 2 * ones > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) for every row; one scan, no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([fingerprint(t, width) for t in texts], pa.int64())], ["doc_id", "fp"])

    return common.map_batches(common.text_columns(docs), run, "doc_id long, fp long")


def plan(sample: np.ndarray, total: int, tau: int) -> list[tuple[list[int], int]]:
    """Blocks of bits with their thresholds, those of -1 left out, at the least estimated cost for ``total`` fingerprints."""
    bits = ((sample.astype(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float) if len(sample) else np.zeros((1, BITS))
    spread = bits - bits.mean(0)
    norm = np.sqrt((spread**2).sum(0)) + 1e-9
    alike = np.abs((spread.T @ spread) / norm[:, None] / norm[None, :])
    best: tuple[float, list] = (float("inf"), [])
    for m in range(1, max(2, tau + 2)):
        blocks = grouped(alike, m)
        costs = [block_costs(bits[:, b], total, tau) for b in blocks]
        # over blocks: the least cost for each sum of thresholds
        least: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for cost in costs:
            then: dict[int, tuple[float, tuple[int, ...]]] = {}
            for had, (c, chosen) in least.items():
                for t in range(-1, tau + 1):
                    x = c + (0.0 if t < 0 else cost[t])
                    if x < then.get(had + t, (float("inf"), ()))[0]:
                        then[had + t] = (x, (*chosen, t))
            least = then
        c, chosen = least[tau - m + 1]
        if c < best[0]:
            best = (c, [(b, t) for b, t in zip(blocks, chosen, strict=True) if t >= 0])
    return best[1]


def grouped(alike: np.ndarray, m: int) -> list[list[int]]:
    """m blocks of nearly equal size; each grows by the free bit most correlated with its own."""
    free, out = set(range(BITS)), []
    for i in range(m):
        size = (BITS + i) // m
        block = [min(free, key=lambda b: alike[b, list(free)].sum())] if len(free) < BITS else [int(alike.sum(0).argmax())]
        free.discard(block[0])
        while len(block) < size:
            nxt = max(free, key=lambda b: (alike[b, block].mean(), -b))
            block.append(nxt)
            free.discard(nxt)
        out.append(sorted(block))
    return out


def ball(width: int, t: int) -> int:
    """Values within t bits of one of ``width`` bits."""
    n = total = 1
    for k in range(1, t + 1):
        n = n * (width - k + 1) // k
        total += n
    return total


def block_costs(bits: np.ndarray, total: int, tau: int) -> list[float]:
    """For each threshold, probes written plus candidates expected, from the sample's own rate of agreement."""
    n, width = bits.shape
    a, b = bits, np.roll(bits, 1, axis=0)
    far = np.concatenate([(a != np.roll(bits, k, axis=0)).sum(1) for k in range(1, min(n, 65))]) if n > 1 else np.array([width])
    out = []
    for t in range(tau + 1):
        chance = max((far <= t).mean() if len(far) else 0.0, ball(width, t) / 2.0**width)
        out.append(float(total) * ball(width, t) * (1 if t == 0 else 2) + 0.5 * float(total) ** 2 * chance)
    return out


def masks(width: int, t: int) -> list[int]:
    """The flips within t bits, as masks over a block's positions."""
    from itertools import combinations

    return [sum(1 << i for i in c) for k in range(t + 1) for c in combinations(range(width), k)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def probes(nodes: DataFrame, blocks: list[tuple[list[int], int]]) -> DataFrame:
    """(fp, part, key): for a threshold of 0 the block's bits, else every value within it.

    Both ends of a pair are written under the values within half the threshold,
    rounded up; those meet whenever the blocks differ by no more than the threshold.
    """
    rows = []
    for i, (bits, t) in enumerate(blocks):
        mask = signed(sum(1 << b for b in bits))
        key = F.col("fp").bitwiseAND(F.lit(mask))
        flips = [signed(sum(1 << bits[j] for j in range(len(bits)) if m >> j & 1)) for m in masks(len(bits), (t + 1) // 2)]
        rows += [F.struct(F.lit(i).alias("part"), key.bitwiseXOR(F.lit(f)).alias("key")) for f in flips]
    return nodes.select("fp", F.explode(F.array(*rows)).alias("p")).select("fp", "p.part", "p.key")


def near_pairs(nodes: DataFrame, tau: int, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect whatever differs in at most ``tau`` bits.

    nodes: (fp), distinct. Small groups give their verified pairs; crowded ones
    give stars around shared centres, so edges stay linear in the fingerprints.
    """
    total = nodes.count()
    sample = np.array([r.fp for r in nodes.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()], dtype=np.int64)
    keyed = scratch.materialize(probes(nodes, plan(sample, total, tau)), "probes")
    sizes = scratch.materialize(keyed.groupBy("part", "key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    few = sizes.where(F.col("n") <= crowd)
    groups = keyed.join(few, ["part", "key"]).groupBy("part", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = [], []
        for group in batch.column("fps").to_pylist():
            x = np.array(group, dtype=np.int64)
            i, j = np.triu_indices(len(x), 1)
            near = np.bitwise_count((x[i] ^ x[j]).view(np.uint64)) <= tau
            a.append(x[i[near]])
            b.append(x[j[near]])
        cat = lambda v: pa.array(np.concatenate(v) if v else np.array([], np.int64), pa.int64())
        return pa.RecordBatch.from_arrays([cat(a), cat(b)], ["a", "b"])

    pairs = common.map_batches(groups.select("fps"), verify, "a long, b long")
    busy = keyed.join(sizes.where(F.col("n") > crowd), ["part", "key"]).select("fp").distinct()
    return scratch.materialize(pairs.union(crowded(busy, tau)).distinct(), "pairs")


def crowded(nodes: DataFrame, tau: int) -> DataFrame:
    """Edges that connect exactly what differs in at most ``tau`` bits (at most 2), linear in the nodes."""
    if tau > 2:
        raise ValueError("centres are exact for thresholds of at most 2 bits")
    flips = [0, *(signed(1 << i) for i in range(BITS))] if tau else [0]
    around = nodes.select("fp", F.explode(F.array(*(F.lit(f) for f in flips))).alias("flip"))
    around = around.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"), (F.col("flip") == 0).alias("own"))
    if tau < 2:  # a pair must then be one flip apart: link only where the centre is itself a node
        groups = around.groupBy("centre").agg(F.sort_array(F.collect_list("fp")).alias("fps"), F.max("own").alias("own"))
        return groups.where("own").select(F.col("centre").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    groups = around.groupBy("centre").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    return groups.select(F.col("fps")[0].alias("a"), F.explode("fps").alias("b")).where("a <> b")


def near_duplicates(docs: DataFrame, width: int = 3, tau: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable) for every row."""
    prints = scratch.materialize(fingerprints(docs, width), "fingerprints")
    nodes = scratch.materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    roots = components.stars(near_pairs(nodes.select("fp"), tau))
    linked = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    linked = scratch.materialize(linked, "roots")
    names = scratch.materialize(linked.groupBy("root").agg(F.min("rep").alias("component_id")), "names")
    named = linked.join(names, "root").select("fp", "component_id")
    out = prints.join(named, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3, tau: int = 2) -> DataFrame:
    """One row of each group of near copies: that of its smallest doc_id, and of equal ones that of the smallest hash of its text.

    Texts are near if their fingerprints differ in at most ``tau`` bits, or if
    their five-word shingles agree to 0.8 or more (see ``near_copies``). It is
    texts that are compared: rows of one doc_id with unlike texts all stay.
    Rows without a doc_id have no name to go by and stay.
    """
    from docquarry.llm import near_copies

    named = docs.where(F.col("doc_id").isNotNull()).withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    texts = named.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__hash").alias("hash"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column("text").to_pylist()
        words = [near_copies.words_of(t) for t in raw]
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("hash"), pa.array(map(near_copies.digest, words), pa.string()), pa.array([fingerprint(t, width) for t in raw], pa.int64()), pa.array(map(near_copies.signature, words), pa.list_(pa.int32())),
        ], ["doc_id", "hash", "same", "fp", "minima"])

    made = common.map_batches(texts, run, "doc_id long, hash long, same string, fp long, minima array<int>")
    # a node for each sequence of words, with the row that bears it; the numbers are fixed once the table is written
    nodes = made.groupBy("same").agg(F.min(F.struct("doc_id", "hash")).alias("row"), F.first("fp").alias("fp"), F.first("minima").alias("minima"))
    nodes = scratch.materialize(nodes.select(F.monotonically_increasing_id().alias("id"), "row.doc_id", "row.hash", "fp", "minima"), "nodes")
    prints = scratch.materialize(nodes.groupBy("fp").agg(F.min("id").alias("first")), "prints")
    alike = near_pairs(prints.select("fp"), tau).join(prints.toDF("a", "x"), "a").join(prints.toDF("b", "y"), "b").select("x", "y")
    equal = nodes.join(prints, "fp").where("id <> first").select("id", "first")
    roots = components.stars(near_copies.links(nodes, texts).union(alike).union(equal).toDF("a", "b"))
    named_roots = nodes.select("id", "doc_id", "hash").join(roots, F.col("id") == F.col("node"), "left")
    stay = named_roots.groupBy(F.coalesce("root", "id").alias("root")).agg(F.min(F.struct("doc_id", "hash")).alias("row"))
    stay = stay.select(F.col("row.doc_id").alias("__doc"), F.col("row.hash").alias("__stays"))
    ours = named.join(stay, (F.col("doc_id").cast("long") == F.col("__doc")) & (F.col("__hash") == F.col("__stays")), "left_semi")
    ours = ours.dropDuplicates(["doc_id", "__hash"]).drop("__hash")  # rows repeated as a whole
    return ours.unionByName(docs.where(F.col("doc_id").isNull()))
