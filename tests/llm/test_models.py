"""Nearest neighbours, languages and toxicity."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from docquarry.llm import ann, langid, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def brute_neighbours(ids, m, every, k=5):
    """For each query id its k nearest rows by the double-precision cosine, ties to the smaller id."""
    n, out = np.sqrt((m * m).sum(1)), {}
    for q in sorted({int(i) for i in ids if i % every == 0}):
        v = min(tuple(m[i]) for i in np.nonzero(ids == q)[0])
        s = m @ np.array(v) / n / np.sqrt(np.dot(v, v))
        at = np.nonzero(ids != q)[0]
        best = at[np.lexsort((ids[at], -np.round(s[at], 12)))][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in best]
    return out


@pytest.mark.parametrize(("shard", "block"), [(30, 3), (20_000, 4_096)])
def test_neighbours_against_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(ann, "SHARD", shard)
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((8, 16))
    v = centres[rng.integers(0, 8, 700)] + 0.4 * rng.standard_normal((700, 16))
    v[100:260] = v[100]  # one very common vector
    rows = [(i, [float(np.float32(x)) for x in r]) for i, r in enumerate(v)]
    odd = [(700, None), (750, [0.0] * 16), (800, [float("nan")] + [1.0] * 15), (850, [None] + [1.0] * 15), (900, [1.0]), (None, rows[0][1]), (950, [])]
    again = [rows[3], rows[0], rows[0], rows[50], (100, rows[100][1]), (101, rows[101][1]), (101, rows[101][1])]  # candidates and queries that are there twice
    df = spark.createDataFrame(rows + odd + again, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = {}
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_neighbours(np.array([r[0] for r in rows + again]), np.array([r[1] for r in rows + again]), 50)
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        assert [x[0] for x in got[q]] == [1, 2, 3, 4, 5]
        hits += sum(min([x[1] for x in got[q]].count(i), [b[0] for b in best].count(i)) for i in {b[0] for b in best})
        if q in (0, 50) or 100 <= q < 260:
            assert [(x[1], round(x[2], 12)) for x in got[q]] == [(i, round(x, 12)) for i, x in best]
    assert hits >= 0.9 * 5 * len(want)
    few = ann.search(df.where("vec_id in (0, 1, 2)"))
    assert few.count() == 2 and ann.search(df.limit(0)).count() == 0


def test_recall_over_many_leaves_in_the_tables_dimension(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 60)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").collect()]
    want = brute_neighbours(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float), 50)
    got = {}
    for r in ann.search(table).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want)
    assert sum(len(got[q] & {i for i, _ in best}) for q, best in want.items()) >= 0.9 * 5 * len(want)


def test_chi_square():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(PIECES)
    rng = random.Random(1)
    chance = [(rng.random() / 50, rng.random() / 50) for _ in range(len(pieces.names) + 1)]
    word = langid.START + "under"
    arcs = pieces.arcs(word)

    def total(i, k):
        return 1.0 if i == len(word) else sum(chance[p][k] * total(j, k) for j, p in arcs[i])

    assert langid.forward(arcs, chance, 2) == pytest.approx([math.log(total(0, 0)), math.log(total(0, 1))])
    long = langid.forward(pieces.arcs(langid.START + "ab" * 4000), chance, 2)
    assert all(math.isfinite(x) and x < -1000 for x in long)


def test_lattice_against_all_segmentations():
    pieces = langid.Pieces(PIECES)
    rng = random.Random(3)
    words = ["a", "under", "straße", "\u4e2d\u6587x", "\U0001043c\u00e9t\u00e9", "zzzzqq", "in"]
    chance = np.array([[rng.random() / 50, rng.random() / 50] for _ in range(len(pieces.names) + 1)])
    lattice = langid.Lattice(words, pieces)
    got = lattice.totals(lattice.forward(chance))
    want = [langid.forward(pieces.arcs(langid.START + w), [tuple(x) for x in chance.tolist()], 2) for w in words]
    assert np.allclose(np.log(got), want)

    def uses(word, times):  # every segmentation, one by one
        arcs, out, paths = pieces.arcs(langid.START + word), {}, []

        def walk(i, path, p):
            if i == len(arcs):
                paths.append((path, p))
            for j, piece in arcs[i] if i < len(arcs) else ():
                walk(j, [*path, piece], p * chance[piece, 0])

        walk(0, [], 1.0)
        total = sum(p for _, p in paths)
        for path, p in paths:
            for piece in path:
                out[piece] = out.get(piece, 0) + times * p / total
        return out

    expected = np.zeros(len(chance))
    for w, k in zip(words, range(1, 8), strict=True):
        for piece, x in uses(w, k).items():
            expected[piece] += x
    assert np.allclose(lattice.expected(chance[:, 0], np.arange(1.0, 8.0)), expected)
    long = langid.fit({"ab" * 900: 2, "under": 3}, pieces)
    assert np.isfinite(long).all() and abs(long.sum() - 1) < 1e-9


def test_predictions_against_brute_force():
    pieces = langid.Pieces(PIECES)
    words = {"en": {"the": 9, "house": 3, "things": 2}, "de": {"der": 8, "hauses": 2, "nicht": 4}}
    langs = sorted(words)
    chance = np.array([langid.fit(words[x], pieces) for x in langs]).T
    scorer = langid.Scorer(PIECES, langs, chance)
    texts = ["The house, things", "der, nicht-der 12", "", "42 !", "o'clock der" + "x" * 90, "the " * 3000]
    rows = [tuple(x) for x in chance.tolist()]
    for text, (lang, score) in zip(texts, scorer.scores(texts), strict=True):
        found = langid.LETTERS.findall(text.lower())
        logs = np.sum([langid.forward(pieces.arcs(langid.START + w), rows, 2) for w in found], axis=0) if found else None
        if logs is None:
            assert (lang, score) == ("und", 0.0)
        else:
            p = np.exp(logs - logs.max())
            assert lang == langs[int(p.argmax())] and score == pytest.approx(float((p / p.sum()).max()))


def crc(i, n):
    import zlib

    return zlib.crc32(str(i).encode()) % n


def test_languages_held_out(spark):
    rng = random.Random(2)
    stock = {"en": ["the", "house", "with", "quickly", "things"], "de": ["der", "hauses", "schnell", "nicht", "straße"], "fr": ["les", "maison", "être", "où", "vitesse"]}
    rows = [(i, " ".join(rng.choice(stock[lang]) + rng.choice(["", ",", "."]) for _ in range(25)), lang) for i in range(300) for lang in [rng.choice([*stock])]]
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 !?", "de"), (None, "the house", "en"), (5, "the things", None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit(1))
    out = langid.identify(df, PIECES).collect()
    assert len(out) == 305
    want = {i: lang for i, _, lang in rows}
    assert all(r.held_out == (r.doc_id is not None and crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in out)
    tested = [r for r in out if r.held_out and r.doc_id in want]
    assert tested and sum(r.lang_pred == want[r.doc_id] for r in tested) >= 0.98 * len(tested)
    assert all(r.lang_pred == "und" and r.score == 0 for r in out if r.doc_id in (900, 901, 902))
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string")), PIECES).collect()} == {"und"}
    assert langid.identify(df.limit(0), PIECES).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automata_against_edit_distance():
    rng = random.Random(6)
    terms = [("abcde", True), ("bacdeabc", True), ("eabcd", False), ("abc", True)]
    trie = toxicity.Trie(terms)
    for _ in range(4000):
        word = "".join(rng.choice("abcde") for _ in range(rng.randrange(4, 11)))
        best = []
        for n, (t, whole) in enumerate(terms):
            k = distance(word, t) if whole else min(distance(word[:j], t) for j in range(len(word) + 1))
            if k <= toxicity.edits(t):
                best.append((k, -len(t), n))
        got = trie.match(word)
        assert (got and (got[0], got[1])) == (min(best)[0], min(best)[2]) if best else got is None


def test_toxicity_held_out(spark):
    rng = random.Random(8)
    terms = ["zounder", "blirkist"]
    docs, labels = [], []
    for i in range(900):
        words = ["".join(rng.choice("aeioustrn") for _ in range(rng.randrange(3, 9))) for _ in range(40)]
        toxic = i % 6 == 0
        if toxic:
            words[5] = rng.choice(terms)
            words[20] = rng.choice(terms).upper() + "!"
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    extra = [(5000, None), (5001, ""), (None, "zounder you"), (5002, "you zoundr now"), (5003, 'they said "zounder" once'), (5004, "blirkkist indeed")]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string").withColumn("predicted", F.lit("clash"))
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.score(d, lab).collect()}
    assert len(out) == 906 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.values())
    held = [(out[i].predicted, t) for i, _, t in labels if crc(i, 3) == 1]
    assert all(out[i].held_out == (crc(i, 3) == 1) for i, _ in docs) and held and all(p == t for p, t in held)
    assert out[5002].predicted == 1 and out[5004].predicted == 1 and out[5003].predicted == 0 and out[5000].predicted == out[5001].predicted == 0
    none = toxicity.score(d, lab.limit(0)).collect()
    assert len(none) == 906 and not any(r.predicted for r in none)
    assert toxicity.score(d.limit(0), lab).count() == 0


def brute_hits(text, lexicon):
    """Hits word by word and term by term, with plain edit distances."""
    words, out = text.lower().split(), []
    for i, w in enumerate(words):
        best = 0.0
        for v in {w.strip(toxicity.EDGES), *toxicity.LETTERS.findall(w)} if not w.strip(toxicity.EDGES).isalpha() else {w.strip(toxicity.EDGES)}:
            found = []
            for n, (t, whole, exact, near) in enumerate(lexicon.terms):
                k = distance(v, t) if whole else min(distance(v[:j], t) for j in range(len(v) + 1))
                if k <= toxicity.edits(t):
                    found.append((k, -len(t), n, near if k else exact))
            best = max(best, min(found)[3] if found else 0.0)
        if best:
            out.append((best, toxicity.Scorer.is_quoted(words, i)))
    return out


def test_scores_against_brute_force():
    rng = random.Random(12)
    lexicon = toxicity.Lexicon([("abcde", True, 0.9, 0.5), ("bacdeabc", True, 0.95, 0.7), ("eabcd", False, 0.8, 0.6), ("ab", True, 0.75, 0.1)], 0.02, 0.3)
    scorer = toxicity.Scorer(lexicon)
    for _ in range(300):
        text = " ".join(rng.choice(["", '"', "("]) + "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 10))) + rng.choice(["", '"', ")", "!", "-cab"]) for _ in range(rng.randrange(0, 25)))
        hits = brute_hits(text, lexicon)
        assert scorer.hits(text) == hits
        clear = 1 - lexicon.base
        for chance, quoted in hits:
            clear *= 1 if quoted else 1 - chance
        if any(q for _, q in hits):
            clear *= 1 - lexicon.quoted
        assert scorer.score(text) == pytest.approx(1 - clear)


def test_terms_are_those_that_toxic_documents_share():
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("aeioustrn") for _ in range(rng.randrange(5, 9)))
    docs = []
    for i in range(600):
        own = {word() for _ in range(30)}
        if i % 5 == 0:
            own |= {rng.choice(["zounder", "blirkist", "xq"])}
        docs.append((own, int(i % 5 == 0)))
    terms, _ = toxicity.learn_terms(toxicity.distinct_documents(docs), 1.0)
    spelled = {t for t, *_ in terms}
    for term in ("zounder", "blirkist", "xq"):  # each is covered by a beginning of its own that no clean document has
        assert any(term.startswith(t) for t in spelled)
    assert all(not any(w.startswith(t) if len(t) >= 4 else w == t for own, y in docs if not y for w in own) for t in spelled)
