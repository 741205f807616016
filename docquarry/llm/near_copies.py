"""Near copies by MinHash: texts whose five-word shingles agree to 0.8 or more.

A text has ``BANDS`` bands of ``ROWS`` minima of hashes of its shingles. Two
texts agree on a minimum with a chance equal to their similarity, wherever the
words lie in which they differ; so at a similarity of 0.8 they agree on a whole
band with a chance of 0.9999 (1 - (1 - 0.8^5)^24), and at 0.3 with one of 0.06.

Texts of the same words are one node. Nodes that agree on a band are a group. A
group of up to ``BLOCK`` is settled in one step, on its own: its candidates are
the pairs whose minima agree in ``LIKELY`` of all places or more, which a pair
of similarity 0.8 misses with a chance of 0.003. Each candidate is verified by
the Jaccard similarity of the whole texts' shingles.

A larger group is first tried against one node, its hub: the node that shares
its bands with most others, which is the original that the others were made
from, if it is there. Those linked to it bear its name in this group. A group of
one name is done. In one with up to ``FEW`` nodes that are not linked, those meet
all the others, who are dealt over small groups. In any other all but the hub
stay, linked or not, and are split by further minima, on each of which near
copies agree again with a chance of 0.8 in each of the groups that they share.
So it goes on until every group is small or of one name. Candidates stay linear in the nodes however large a
group is; in a crowd of texts that are all about 0.8 alike, a link that neither
the hubs nor a shared small group shows can be missed.

In small groups each node is first tried with its likeliest partner, and only
what these links have not joined is tried with all the likely ones.

Cases: texts without words are copies of each other; a text of fewer words than
a shingle is one shingle; case of A-Z and the kind of white space do not count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.llm import common, components

BANDS, ROWS = 24, 5
BLOCK, FEW = 96, 24
LIKELY = 0.7
WIDTH = 5
LEAST = 0.8
_RNG = np.random.default_rng(23)
_TIMES, _PLUS = (_RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def hashes(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """A 64-bit hash of each shingle, in order: a polynomial in its words' hashes, mixed."""
    w = np.array([xxhash.xxh64_intdigest(x, 42) for x in words], dtype=np.uint64)
    n = max(1, len(w) - width + 1)
    h = np.full(n, len(w[:width]), dtype=np.uint64)
    for k in range(min(width, len(w))):
        h = h * _BASE + w[k : k + n]
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(times)
    return h ^ (h >> np.uint64(31))


def signature(words: list[bytes]) -> np.ndarray:
    """The upper 32 bits of the minima of the shingles' hashes, as signed integers."""
    h = hashes(words)
    least = np.full(len(_TIMES), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(h), 512):
        np.minimum(least, (h[at : at + 512][None, :] * _TIMES[:, None] + _PLUS[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def shingles(text: str, width: int = WIDTH) -> set[bytes]:
    w = words_of(text)
    return {b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def similarity(a: str, b: str, width: int = WIDTH) -> float:
    x, y = shingles(a, width), shingles(b, width)
    both = len(x & y)
    return both / (len(x) + len(y) - both)


def digest(words: list[bytes]) -> str:
    """Of the words in order: texts that have it in common are one node."""
    return xxhash.xxh3_128_hexdigest(b" ".join(words))


def verified(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """``pairs`` (a, b) with ``near``: whether their texts (id, text) are similar enough. A busy node's join is one that the engine can split."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = [similarity(x, y) >= least for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())], ["a", "b", "near"])

    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b")
    return common.map_batches(both.select("a", "b", "x", "y"), run, "a long, b long, near boolean")


def likely(blocks: DataFrame, nodes: DataFrame, best: bool) -> DataFrame:
    """The candidates (a, b) of small groups (id, k, name): pairs of two names whose minima agree in enough places; ``best``: of each node the best of these alone."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = [], []
        ids, names, minima = (batch.column(c) for c in ("ids", "names", "minima"))
        ends, flat = ids.offsets.to_numpy(), (ids.values.to_numpy(), names.values.to_numpy(), minima.values.to_numpy())
        start = minima.offsets.to_numpy()
        for i in range(len(ids)):
            own, named = flat[0][ends[i] : ends[i + 1]], flat[1][ends[i] : ends[i + 1]]
            m = flat[2][start[i] : start[i + 1]].reshape(len(own), -1)
            x, y = np.triu_indices(len(own), 1)
            x, y = x[named[x] != named[y]], y[named[x] != named[y]]
            agreed = (m[x] == m[y]).mean(axis=1)
            near = agreed >= LIKELY
            if best:
                most = np.zeros(len(own))
                np.maximum.at(most, x, agreed)
                np.maximum.at(most, y, agreed)
                near &= (agreed == most[x]) | (agreed == most[y])
            a.append(np.maximum(own[x[near]], own[y[near]]))
            b.append(np.minimum(own[x[near]], own[y[near]]))
        cat = lambda v: pa.array(np.concatenate(v) if v else np.array([], np.int64), pa.int64())
        return pa.RecordBatch.from_arrays([cat(a), cat(b)], ["a", "b"])

    groups = blocks.join(nodes.select("id", "minima"), "id").groupBy("k").agg(F.collect_list(F.struct("id", "name", "minima")).alias("g"))
    listed = groups.select(F.col("g.id").alias("ids"), F.col("g.name").alias("names"), F.flatten("g.minima").alias("minima"))
    return common.map_batches(listed, run, "a long, b long").distinct()


def grouped(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` (id, k, name) whose group has two names at least, with its size n.

    Here and below, what is known of a group is written before it is joined back:
    then both sides are dealt for the join alone, and the engine can split a
    group that very many texts share.
    """
    groups = keys.groupBy("k").agg(F.count("*").alias("n"), F.min("name").alias("x"), F.max("name").alias("y")).where("x <> y")
    return scratch.materialize(keys.join(scratch.materialize(groups.select("k", "n"), "near-sizes"), "k"), "near-groups")


def links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified edges (a, b) between the ids of ``nodes`` (id, doc_id, hash, minima), whose texts are those of ``docs`` (doc_id, hash, text)."""
    bands = F.array(*(F.xxhash64(F.lit(b), F.slice("minima", b * ROWS + 1, ROWS)) for b in range(BANDS)))
    # name: the node itself, or the last hub of the group that it was linked to
    keys = nodes.select("id", F.explode(bands).alias("k"))
    sizes = scratch.materialize(keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "near-sizes")
    now = scratch.materialize(keys.join(sizes, "k").withColumn("name", F.col("id")), "near-groups")
    blocks, large = now.where(F.col("n") <= BLOCK), now.where(F.col("n") > BLOCK)
    # of the nodes that share a band at all, once: what follows is of their size
    nodes = scratch.materialize(now.select("id").distinct().join(nodes, "id").select("id", "doc_id", "hash", "minima"), "near-nodes")
    texts = scratch.materialize(docs.join(nodes.select("id", "doc_id", "hash"), ["doc_id", "hash"]).groupBy("id").agg(F.first("text").alias("text")), "near-texts")
    tried = None
    while not large.isEmpty():
        known = large.groupBy("id").agg(F.sum("n").alias("known"))
        hubs = large.join(known, "id").groupBy("k").agg(F.max(F.struct("known", (-F.col("id")).alias("least"), "name")).alias("m")).select("k", (-F.col("m.least")).alias("hub"), F.col("m.name").alias("hub_name"))
        others = scratch.materialize(large.join(scratch.materialize(hubs, "near-hubs"), "k").where("id <> hub"), "near-others")
        pairs = others.where("name <> hub_name").select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        found = scratch.materialize(verified(pairs, texts), "near-tried")
        tried = found if tried is None else tried.union(found)
        near = tried.where("near").select(F.col("a").alias("ga"), F.col("b").alias("gb"))
        linked = others.join(near, (F.greatest("id", "hub") == F.col("ga")) & (F.least("id", "hub") == F.col("gb")), "left")
        named = F.when(F.col("ga").isNotNull(), F.col("hub_name")).otherwise(F.col("name")).alias("name")
        linked = scratch.materialize(linked.select("id", "k", "n", "hub_name", named), "near-linked")
        unlike = linked.groupBy("k").agg(F.count_if(F.col("name") != F.col("hub_name")).alias("unlike")).where("unlike > 0")
        linked = linked.join(scratch.materialize(unlike, "near-unlike"), "k")
        # few that are not linked: each meets all the others, who are dealt over slices
        slices = F.ceil((F.col("n") - F.col("unlike")) / F.lit(BLOCK - FEW))
        dealt = F.when(F.col("name") == F.col("hub_name"), F.array(F.pmod(F.xxhash64("id"), slices))).otherwise(F.sequence(F.lit(0).cast("long"), slices - 1))
        sliced = linked.where(F.col("unlike") <= FEW).select("id", "k", "name", F.explode(dealt).alias("slice")).select("id", F.xxhash64("k", "slice").alias("k"), "name")
        # one further minimum for each halving that is wanted, at most three at a time
        place = [(F.pmod(F.xxhash64("k", F.lit(i)), F.lit(BANDS * ROWS)) + 1).cast("int") for i in range(3)]
        key = F.xxhash64("k", *(F.when(F.col("n") > i * 2 * BLOCK, F.element_at("minima", p)) for i, p in enumerate(place)))
        now = grouped(linked.where(F.col("unlike") > FEW).join(nodes.select("id", "minima"), "id").select("id", key.alias("k"), "name"))
        blocks, large = blocks.select("id", "k", "name").union(sliced).union(now.where(F.col("n") <= BLOCK).select("id", "k", "name")), now.where(F.col("n") > BLOCK)
    # first the best partner of each node; what these links join needs no more of them
    blocks = scratch.materialize(blocks.select("id", "k", "name"), "near-blocks")
    pairs = likely(blocks, nodes, best=True)
    found = scratch.materialize(verified(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), texts), "near-tried")
    tried = found if tried is None else tried.union(found)
    roots = components.stars(tried.where("near").select("a", "b"))
    renamed = blocks.join(roots, F.col("id") == F.col("node"), "left").select("id", "k", F.coalesce("root", "id").alias("name"))
    groups = renamed.groupBy("k").agg(F.min("name").alias("x"), F.max("name").alias("y")).where("x <> y")
    pairs = likely(renamed.join(groups.select("k"), "k"), nodes, best=False).join(tried, ["a", "b"], "left_anti")
    return tried.union(scratch.materialize(verified(pairs, texts), "near-tried")).where("near").select("a", "b")
