import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from docquarry.llm import components, near_copies, simhash


def brute_print(text, width=3):
    words = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < width else [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, tau=2):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    prints = sorted({p for _, p in rows})
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if bin(a ^ b).count("1") <= tau:
                parent[find(a)] = find(b)
    least = {}
    for d, p in rows:
        least[find(p)] = min(d, least.get(find(p), d))
    return {(d, p): least[find(p)] for d, p in rows}


def brute_groups(rows, linked):
    """doc_id to the least one of its group: fingerprints' components joined by five-word similarities of 0.8 or more."""
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    for (d, _), c in linked.items():
        join(d, c)
    for i, (a, x) in enumerate(rows):
        for b, y in rows[i + 1 :]:
            if near_copies.similarity(x or "", y or "") >= 0.8:
                join(a, b)
    return {d: find(d) for d in parent}


def test_whole_query_against_brute_force(spark):
    rng = random.Random(5)
    base = ["The  quick\tBrown fox " + " ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(0, 300))) for _ in range(40)]
    texts = [None, "", " \n", "one", "One", "two words", "É é"] + base + base[:7]
    for t in base[:15]:
        words = t.split()
        words[-1] = "changed"
        texts.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in simhash.near_duplicates(df).collect()}
    want = [(i, brute_print(t)) for i, t in rows]
    assert set(got) == set(want) and got == brute_components(want)
    assert got[0, 0] == got[1, 0] == got[2, 0] == 0
    kept = sorted(r.doc_id for r in simhash.keep_one(df.union(df.where("doc_id = 9"))).collect())
    least = set(brute_groups(rows, got).values())  # the search for near copies may miss a few: these texts have eight different words
    assert least <= set(kept) and len(set(kept) - least) <= 0.03 * len(rows) and len(kept) == len(set(kept))
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def linked(spark, rows):
    """Edges of near_copies between the doc_ids of (doc_id, text) rows."""
    made = [(d, d, d, [int(x) for x in near_copies.signature(near_copies.words_of(t))]) for d, t in rows]
    nodes = spark.createDataFrame(made, "id long, doc_id long, hash long, minima array<int>")
    docs = spark.createDataFrame([(d, d, t) for d, t in rows], "doc_id long, hash long, text string")
    return {(max(r), min(r)) for r in near_copies.links(nodes, docs).collect()}


def edges(spark, values, **kw):
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    return {frozenset((np.int64(r.a).astype(np.uint64).item(), np.int64(r.b).astype(np.uint64).item())) for r in simhash.near_pairs(df, 2, **kw).collect()}


def test_crowds_lose_no_link(spark):
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    values = sorted({s ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(20)) for s in seeds for _ in range(40)})
    want = brute_components([(v, v) for v in values])
    for crowd in (2, 1000):
        found = edges(spark, values, crowd=crowd)
        df = spark.createDataFrame([(int(np.uint64(a).astype(np.int64)), int(np.uint64(b).astype(np.int64))) for a, b in map(tuple, found)], "a long, b long")
        roots = {np.int64(r.node).astype(np.uint64).item(): r.root for r in components.stars(df).collect()}
        groups = {}
        for v in values:
            groups.setdefault(roots.get(v, ("alone", v)), set()).add(v)
        wanted = {}
        for (v, _), c in want.items():
            wanted.setdefault(c, set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_every_plan_is_whole():
    rng = np.random.default_rng(2)
    sample = rng.integers(-(2**63), 2**63, 500, dtype=np.int64)
    for total in (100, 10**6, 10**10):
        for tau in (0, 1, 2, 3):
            blocks = simhash.plan(sample, total, tau)
            left_out = 64 - sum(len(b) for b, _ in blocks)
            m = len(blocks) + (1 if left_out else 0)
            assert sum(t for _, t in blocks) - (m - len(blocks)) >= tau - m + 1
            assert len({x for b, _ in blocks for x in b}) == 64 - left_out


def test_components_of_a_chain_and_a_star(spark):
    rows = [(i, i + 1) for i in range(100)] + [(1000, 2000 + i) for i in range(200)] + [(5, None), (7, 7)]
    got = {r.node: r.root for r in components.stars(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(101)) and all(got[2000 + i] == 1000 for i in range(200)) and len(got) == 302


def test_near_copies_have_one_hub_and_lose_few(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(900)]
    rows, wanted = [], []
    for group in range(12):
        first = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 400))]
        for copy in range(20 if group == 0 else 4):
            words = list(first)
            for _ in range(len(words) // 90 if copy else 0):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    alone = [(1000 + i, " ".join(rng.choice(vocabulary) for _ in range(120))) for i in range(40)]
    texts = dict(rows)
    wanted = [(a, b) for a in texts for b in texts if a < b and near_copies.similarity(texts[a], texts[b]) >= 0.8]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows + alone, "doc_id long, text string")).collect()}
    assert {d for d, _ in alone} <= kept
    assert sum(a in kept and b in kept for a, b in wanted) <= 0.01 * len(wanted)


def test_near_copies_with_a_piece_added_or_cut_off_are_linked(spark):
    rng = np.random.default_rng(31)
    rows, wanted = [], set()
    for n in range(40):
        words = [f"w{x}" for x in rng.integers(0, 100_000, 245)]
        rows += [(2 * n, " ".join(words[:200])), (2 * n + 1, " ".join(words if n % 2 else words[:165]))]
        wanted.add((2 * n + 1, 2 * n))
    texts = dict(rows)
    assert all(near_copies.similarity(texts[a], texts[b]) >= 0.8 for a, b in wanted)
    assert linked(spark, rows) == wanted


def test_near_copies_of_one_vocabulary_are_linked_whatever_the_other_rows(spark):
    rng = np.random.default_rng(37)
    words = [f"w{x}" for x in range(120)]
    rows = [(n, " ".join(rng.permutation(words))) for n in range(12)]
    swapped = rows[7][1].split()
    swapped[0], swapped[1] = swapped[1], swapped[0]
    rows.append((12, " ".join(swapped)))
    assert linked(spark, rows) == {(12, 7)}


def test_unrelated_texts_lose_no_link(spark):
    rng = np.random.default_rng(41)
    words = [f"w{x}" for x in range(300)]
    one = " ".join(words)
    two = " ".join([*words[:150], "new", *words[150:]])
    assert near_copies.similarity(one, two) > 0.9
    rows = [(1, one), (2, two)]
    assert linked(spark, rows) == {(2, 1)}
    assert linked(spark, [(0, " ".join(rng.permutation(words))), *rows]) == {(2, 1)}


def spread(rng, first, copies, share):
    out = [first]
    for _ in range(copies):
        words = list(first)
        for _ in range(max(1, int(share * rng.random() * len(words)))):
            words[rng.integers(len(words))] = f"x{rng.integers(10**6)}"
        out.append(words)
    return out


def test_groups_of_all_sizes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 8)
    monkeypatch.setattr(near_copies, "FEW", 2)  # crowds with hubs, splits and blocks
    rng = np.random.default_rng(43)
    texts = []
    for size in (1, 2, 3, 5, 9, 20, 60):
        first = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        texts += spread(rng, first, size, 0.05)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [near_copies.shingles(t) for _, t in rows]
    alike = [(b, a) for a in range(len(rows)) for b in range(a + 1, len(rows)) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    got = linked(spark, rows)
    assert got <= set(alike)

    def groups(pairs):
        parent = list(range(len(rows)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[find(a)] = find(b)
        return [find(i) for i in range(len(rows))]

    want, have = groups(alike), groups(got)
    together = [(a, b) for a in range(len(rows)) for b in range(a) if want[a] == want[b]]
    assert sum(have[a] == have[b] for a, b in together) >= 0.98 * len(together)


def test_rows_of_one_doc_id_with_unlike_texts_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (0, a), (2, b), (3, c), (3, c.upper()), (None, c), (None, c)]
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    kept_c = [t for d, t in got if d == 3]
    assert [x for x in got if x[0] != 3] == [(0, a), (1, b), (None, c), (None, c)] and len(kept_c) == 1 and kept_c[0].lower() == c


def test_a_fingerprint_that_a_third_of_rows_share_is_split(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        common, rest = F.lit("the same text in very many rows"), F.concat(F.lit("words of row number "), F.col("id"), F.lit(" and others "), F.col("id") * 7919)
        rows = spark.range(0, 30_000, 1, 8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, common).otherwise(rest).alias("text"))
        out = simhash.near_duplicates(rows)
        assert out.where("doc_id % 3 = 0").select("component_id").distinct().collect() == [(0,)] and out.count() == 30_000
        out.collect()
        assert "SortMergeJoin(skew=true) [fp" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in keys:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
