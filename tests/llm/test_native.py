"""Mixing, quality rules and licences."""

import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.llm import licenses, mixing, quality
from docquarry.llm.license_texts import NOTICES, TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, where, covered, seen, dup = WORD.findall(text), {}, set(), set(), 0
    for i in range(len(words) - 7):
        where.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in where.values():
        if len(places) > 1:
            covered.update(j for i in places for j in range(i, i + 8))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


TEXTS_6 = [None, "", " \t\n", "a", "\n\na\n\na\nb", "a b c d e f g h " * 3, " x" * 8, "x y " * 9 + "\x0b\x0c z", "a b c d e f g h i a b c d e f g h", "é#|<> " * 30, "w " * 5000, " ".join(map(str, range(3000)))]


def test_statistics(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS_6)] * 2, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    rows = quality.judge(df, []).collect()
    assert len(rows) == 2 * len(TEXTS_6)
    for r in rows:
        want = brute(TEXTS_6[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and r.kept == (not r.base_failed)
    assert quality.judge(df.limit(0), []).count() == 0
    kept = quality.keep_good(df, [])
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_learning_finds_and_keeps(spark):
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(400):
        words = ["".join(rng.choice([*"abcdefgh"], 5)) for _ in range(int(rng.integers(25, 90)))]
        bad = i % 4 == 0
        if bad:
            words = [w + "###" for w in words] if i % 8 else [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad), 0))
    labels += [(None, 0, 0), (1, None, 0)]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = quality.learn_rules(d, lab)
    got = {r.doc_id: r for r in quality.judge(d, rules).collect()}
    assert all(got[i].kept == bool(q) for i, q, _ in labels if i is not None and q is not None)
    assert all(got[i].rule for i in range(0, 400, 4))
    assert quality.learn_rules(d, lab.limit(0)) == [] and quality.learn_rules(d.limit(0), lab) == []


def test_mixing_matches_sql_and_targets(spark):
    rows = [(i, f"src{min(i % 7, 5)}", f"t{i}") for i in range(3000)] + [(3000, None, None), (None, "src1", ""), (5, "src5", "again")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    weights = {"src1": 0.5, "src2": 0.0, "src9": 0.1}
    got = mixing.mix(df, weights, seed=3)
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(mixing.oracle(weights, 3)).fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want))
    share = got.where("source = 'src1'").count() / 3003
    assert abs(share - 0.5) < 0.06 and got.where("source = 'src2'").count() == 0
    assert mixing.mix(df.limit(0), weights).count() == 0
    clash = mixing.mix(df.withColumn("copy_number", F.lit("x")), weights)
    assert clash.columns == ["doc_id", "source", "text", "copy_number"] and clash.schema["copy_number"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        mixing.mix(df, {"a": 0.9, "b": 0.9})


@pytest.mark.parametrize("rate", [0.01, 1.0, 3.7, 55.5, 2000.25])
def test_poisson_tables(spark, rate):
    row = spark.range(1).select(mixing.distribution(F.lit(rate)).alias("d")).first().d
    ks = np.arange(row.low, row.low + len(row.cumulated))
    chance = np.exp(ks * math.log(rate) - rate - np.array([math.lgamma(k + 1) for k in ks]))
    assert np.allclose(np.cumsum(chance), row.cumulated, atol=1e-9) and row.cumulated[-1] == 1.0


def test_licences(spark):
    mit = dict(TEXTS[3:4])["MIT"]
    wrapped = "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + re.sub(r"(.{60}\S*) ", r"\1\n * ", mit).upper().replace("SUBLICENSE", "SUB-LICENSE")
    rows = [(1, mit), (2, wrapped), (3, "x " + mit), (4, None), (5, "!!"), (6, "text\n" + NOTICES[0][1] + "\n// released under the MIT licence\nmore licence words"), (1, mit)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license_id", F.lit(3))
    got = {r.doc_id: (r.license_id, r.n_notices, r.notice_ids) for r in licenses.scan(df).collect()}
    assert got[1][0] == got[2][0] == "MIT" and got[3][0] is None and got[4] == got[5] == (None, 0, "") and got[6] == (None, 2, "Apache-2.0,MIT")
    assert licenses.scan(df).count() == 7 and licenses.scan(df.limit(0)).count() == 0
    sha = {r.doc_id: r.canonical_sha256 for r in licenses.scan(df).collect()}
    import hashlib

    assert all(sha[i] == hashlib.sha256(licenses.canonical_py(t or "").encode()).hexdigest() for i, t in rows)


def test_rows_without_a_doc_id_are_drawn_and_dealt_one_by_one(spark):
    rows = [(None, "src0", f"text {i}") for i in range(2000)] + [(7, "src0", f"other {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    coalesced = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesced, "false")
    out = mixing.mix(df, {"src0": 1.0}, seed=5, scale=0.5).withColumn("p", F.spark_partition_id())
    alone = out.where("doc_id is null")
    assert 800 < alone.count() < 1200 and alone.groupBy("text").count().agg(F.max("count")).first()[0] < 8
    assert alone.select("p").distinct().count() > 1
    again = mixing.mix(df, {"src0": 1.0}, seed=5, scale=3.0).withColumn("p", F.spark_partition_id()).where("doc_id = 7")
    assert again.count() == 0 or again.select("p").distinct().count() > 1
    spark.conf.unset(coalesced)


def test_spellings_side_by_side(spark):
    texts = ["licence licence", "Licence, licence-licences sub-licence sub license", "favour favour http http", "per cent per cent copyright owner copyright owners"]
    want = [" license license ", " license license licenses sublicense sublicense ", " favor favor https https ", " percent percent copyright holder copyright holders "]
    got = [r.c for r in spark.createDataFrame([(t,) for t in texts], "t string").select(licenses.canonical(F.col("t")).alias("c")).collect()]
    assert got == want == [licenses.canonical_py(t) for t in texts]
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").toPandas())
    import hashlib

    assert dict((r[0], r[1]) for r in con.execute(f"SELECT doc_id, canonical_sha256 FROM ({licenses.oracle()})").fetchall()) == {i: hashlib.sha256(w.encode()).hexdigest() for i, w in enumerate(want)}


def test_known_digests_are_those_of_their_texts():
    import hashlib
    import os

    sha = lambda t: hashlib.sha256(licenses.canonical_py(t).encode()).hexdigest()
    known, folder = licenses.known_digests(), "/usr/share/common-licenses"
    for name, license_id in (("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2.1", "LGPL-2.1")):
        if os.path.exists(f"{folder}/{name}"):
            with open(f"{folder}/{name}", encoding="utf-8") as f:
                text = f.read()
            terms = text[: text.index("END OF TERMS AND CONDITIONS")]
            assert {known[sha(t)] for t in (text, terms, terms + "END OF TERMS AND CONDITIONS", terms.upper())} == {license_id}
