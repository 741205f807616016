import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from docquarry.llm import mixing, near_copies, pii, quality, simhash
from docquarry.llm.common import table
from docquarry.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def brute_survivors(rows, linked):
    """The least doc_id of each group: fingerprints' components joined by five-word similarities of 0.8 or more."""
    least = dict(linked)
    sets = {d: near_copies.shingles(t or "") for d, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in [*pairs, *linked.items()]:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return set(least.values())


def test_stages_against_their_operators(spark):
    docs = table(spark, SF, "documents")
    one, two, three, four, five = (f for _, f in corpus_pipeline.STAGES)
    rules = quality.learn_rules(docs, table(spark, SF, "labels"))
    kept = one(spark, docs, SF)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.judge(docs, rules).where("kept").collect()}
    alone = two(spark, kept, SF)
    assert alone.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    assert {r.doc_id for r in alone.collect()} == brute_survivors(rows, {r.doc_id: r.component_id for r in simhash.near_duplicates(kept).collect()})
    texts = {r.doc_id: r.text for r in alone.collect()}
    clean = three(spark, alone, SF).collect()
    assert {r.doc_id: r.text for r in clean} == {k: pii.redacted(v) for k, v in texts.items()}
    assert all(r.n_chars == len(r.text) for r in clean)
    mixed = four(spark, alone, SF)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert five(spark, alone, SF).select("sequence_id").distinct().count() > 0


def test_rows_that_are_hard(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, None, "en", "src0", 0), (7, "", None, None, None), (7, "again " * 50, "en", "src0", 300)], docs.schema)
    for given in (docs.limit(20).unionByName(odd), odd, docs.limit(0)):
        rows = given
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF)
        rows.collect()


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 11))
    assert set(oracle_sql()) <= set(queries())


def test_the_last_stages_are_their_operators_on_all_rows(spark):
    docs = table(spark, SF, "documents").limit(150)
    extra = spark.createDataFrame([(None, "no name", None, None, 7), (3, None, "en", "src0", None)], docs.schema)
    docs = docs.unionByName(extra)
    *_, four, five = (f for _, f in corpus_pipeline.STAGES)
    key = lambda rows: sorted(map(str, rows))
    mixed = four(spark, docs, SF)
    assert key(mixed.collect()) == key(mixing.mix(docs).drop("copy_number").collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    packed = five(spark, docs, SF).collect()
    assert sum(want) == sum(r.length for r in packed)
    ends = {}
    for r in packed:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in own) <= 1024 and sorted(own) == [(sum(n for _, n in sorted(own)[:i]), n) for i, (_, n) in enumerate(sorted(own))] for own in ends.values())
