"""Toxicity by a learned lexicon, matched by Levenshtein automata on its trie.

Terms are learned from a bounded sample of labelled documents: word beginnings,
or whole words of two or three letters, that toxic documents share and clean
ones lack, tested against chance over all candidates and chosen greedily until
the toxic documents are covered, so that rare words of a copied document never
become terms. A term that mostly occurs as a whole word must match whole; else
it is a stem that any ending may follow.

A word is read by the intersection of the terms' Levenshtein automata with the
trie: a state holds the nodes that the word may have spelled and with how many
edits, and is made once; most words reach the empty state in a few letters.
Terms of 5 letters allow one edit, of 8 two.

A hit's chance of being abuse comes from the labels: by term for exact hits, by
term for misspelled ones, and lower where its context window shows a quotation
(quotation marks around it, or a reporting word just before). Chances combine
by noisy-or; quoted hits together count once.

Cases: a null or empty text has the score of a text without hits; without
labels of both kinds there are no terms and the score is the base rate; a null
doc_id is not held out, not learned from, and passed on; repeated rows give a
row each; an empty table gives an empty result; texts are scored whole; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
import sys
import uuid
import zlib
from array import array
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.llm import common
from docquarry.llm.langid import fold

FOLDS, HELD = 3, 1
TOXIC_SAMPLE, CLEAN_SAMPLE = 2_000, 6_000  # labelled documents learned from, about
SAMPLE_FILES = 16  # that the sample is written to, however many partitions the documents have
MOST_TERMS = 400
SHORTEST, STEM, MOST_LETTERS = 2, 4, 14  # of a term, of one that may be a stem
THRESHOLD = 0.7
WINDOW = 4  # words before a hit that may report it
MOST_CACHED = 100_000  # words as written that a worker keeps
MOST_EDITS = 2
MOST_STATES = 100_000
LETTERS = re.compile(r"[^\W\d_]+")
EDGES = "\"'“”„«»‹›()[]{}.,;:!?…*#$%&|<>-_`"
OPENERS, CLOSERS = frozenset("\"“„«‹`"), frozenset("\"”“»›`")
REPORTS = frozenset("said says wrote writes called calls quote quoted word words term terms slur insult dit écrit mot appelé sagte schrieb wort nannte dijo escribió palabra llamó".split())
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


@dataclass
class Lexicon:
    """terms: (text, whole word?, chance of abuse when exact, when misspelled); base: chance without a hit; quoted: of a quoted hit."""

    terms: list[tuple[str, bool, float, float]] = field(default_factory=list)
    base: float = 0.05
    quoted: float = 0.4


class Trie:
    """The lexicon's trie, read by its terms' Levenshtein automata all at once.

    A state of the product is a set of (node, edits): what a word read so far may
    have spelled. Those that are over their terms' edits are left out, and the
    rest is made deterministic on first use; a word that spells nothing reaches
    the empty set after a few letters.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.number: list[int] = [-1]
        self.most: list[int] = [0]  # edits of any term below
        for number, (term, _) in enumerate(terms):
            node = 0
            for c in term:
                self.most[node] = max(self.most[node], edits(term))
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.number.append(-1)
                    self.most.append(0)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], edits(term))
            self.number[node] = number
        self.reset()

    def reset(self) -> None:
        self.sets: list[array] = []
        self.known: dict[bytes, int] = {}
        self.step: list[dict[str, int]] = []
        self.found: list[tuple[tuple | None, tuple | None]] = []  # the best of stems, of whole terms: (edits, -length, number)
        self.state({})  # the empty set is state 0
        self.state({0: 0} if self.terms else {})

    def state(self, reached: dict[int, int]) -> int:
        """The number of a state, with letters of terms left out as the edits allow."""
        for k in range(MOST_EDITS):
            for node in [n for n, e in reached.items() if e == k]:
                for child in self.children[node].values():
                    if k < self.most[child] and k + 1 < reached.get(child, 9):
                        reached[child] = k + 1
        own = array("L", sorted(n * (MOST_EDITS + 1) + e for n, e in reached.items()))
        key = own.tobytes()
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.sets)
            self.sets.append(own)
            self.step.append({})
            best: list[tuple | None] = [None, None]
            for node, e in reached.items():
                number = self.number[node]
                if number >= 0:
                    term, whole = self.terms[number]
                    mark = (e, -len(term), number)
                    if e <= edits(term) and (best[whole] is None or mark < best[whole]):
                        best[whole] = mark
            self.found.append((best[0], best[1]))
        return at

    def advance(self, state: int, c: str) -> int:
        reached: dict[int, int] = {}
        for packed in self.sets[state]:
            node, e = divmod(packed, MOST_EDITS + 1)
            for letter, child in self.children[node].items():
                k = e if letter == c else e + 1
                if k <= self.most[child] and k < reached.get(child, 9):
                    reached[child] = k
            if e < self.most[node] and e + 1 < reached.get(node, 9):  # a letter that no term has
                reached[node] = e + 1
        to = self.step[state][c] = self.state(reached)
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest and then longest term that the word spells."""
        if len(self.sets) > MOST_STATES:
            self.reset()
        state, step, found, best = min(1, len(self.sets) - 1), self.step, self.found, None
        for c in word:
            to = step[state].get(c)
            state = self.advance(state, c) if to is None else to
            if not state:
                break
            stem = found[state][0]
            if stem is not None and (best is None or stem < best):
                best = stem
        whole = found[state][1]
        if whole is not None and (best is None or whole < best):
            best = whole
        return None if best is None else (best[0], best[2])


def distinct_documents(texts: list[tuple[set[str], int]]) -> list[tuple[set[str], int]]:
    """The word sets of the documents without near copies of one label: bottom sketches that agree in most places count once."""
    seen: dict[tuple[int, int], list[int]] = defaultdict(list)
    out = []
    for own, label in texts:
        sketch = sorted(zlib.crc32(w.encode()) for w in own)[:8]
        alike = Counter(k for h in sketch for k in seen.get((label, h), ()))
        if sketch and alike and alike.most_common(1)[0][1] >= max(2, 0.6 * len(sketch)):
            continue
        for h in sketch:
            seen[label, h].append(len(out))
        out.append((own, label))
    return out


def beginnings(word: str) -> list[str]:
    """What a word may teach: its beginnings that can be stems, or the whole word if it is short."""
    return [word[:k] for k in range(STEM, min(len(word), MOST_LETTERS) + 1)] if len(word) >= STEM else [word] if len(word) >= SHORTEST else []


def covers(term: str, other: str) -> bool:
    """Whether a term stands for another as well; a short one stands for itself alone."""
    return other == term or len(term) >= STEM and other.startswith(term)


def learn_terms(docs: list[tuple[set[str], int]], clean_weight: float) -> tuple[list[tuple[str, bool, float, float]], float]:
    """(terms, chance of a document without hits)."""
    toxic = [i for i, d in enumerate(docs) if d[1]]
    where: dict[str, set[int]] = defaultdict(set)
    for i in toxic:
        for w in docs[i][0]:
            for p in beginnings(w):
                where[p].add(i)
    where = {p: s for p, s in where.items() if len(s) >= 3}
    clean_in: Counter = Counter()
    memo: dict[str, list[str]] = {}
    n_clean = 0
    for own, label in docs:
        if label:
            continue
        n_clean += 1
        hit: set[str] = set()
        for w in own:
            got = memo.get(w)
            if got is None:
                got = memo[w] = [p for p in beginnings(w) if p in where]
            hit.update(got)
        clean_in.update(hit)
    if not toxic or not n_clean:
        return [], 0.05
    rate = len(toxic) / (len(toxic) + clean_weight * n_clean)
    needed = math.log(max(2, len(where))) + 1.0  # by chance alone, about one candidate in three lexicons would reach this
    able = []
    for p, s in where.items():
        a, b = len(s), clean_weight * clean_in[p]
        share = a / (a + b)
        if share >= 0.9:
            tail = (a + b) * (share * math.log(share / rate) + (0 if b == 0 else (1 - share) * math.log((1 - share) / (1 - rate))))
            if tail > needed:
                able.append((p, s, b, tail))
    chosen, left, every = [], set(toxic), able
    while able and len(chosen) < MOST_TERMS:
        p, s, b, _ = max(able, key=lambda x: (len(x[1] & left), len(x[1]), len(x[0]), x[0]))
        if len(s & left) < 2:
            break
        chosen.append((p, s, b))
        left -= s
        able = [x for x in able if not covers(p, x[0]) and len(x[1] & left) >= 2]
    # what always stands beside other terms adds no cover, but far beyond chance is a term too
    for p, s, b, tail in sorted(every, key=lambda x: (-len(x[1]), -len(x[0]), x[0])):
        if tail > needed + 20 and len(chosen) < MOST_TERMS and not any(covers(c, p) or covers(p, c) for c, *_ in chosen):
            chosen.append((p, s, b))
    # whole words, and what misspelled hits show
    exact_words: dict[str, Counter] = {p: Counter() for p, *_ in chosen}
    for i in toxic:
        for w in docs[i][0]:
            for p in beginnings(w):
                if p in exact_words:
                    exact_words[p][w == p] += 1
    terms = [(p, exact_words[p][True] >= 0.9 * sum(exact_words[p].values())) for p, *_ in chosen]
    trie, near, fuzzy = Trie(terms), {}, [[0.0, 0.0] for _ in terms]
    bare = [0.0, 0.0]
    for own, label in docs:
        hits = set()
        for w in own:
            if w not in near:
                near[w] = trie.match(w)
            if near[w]:
                hits.add(near[w])
        if not hits:
            bare[bool(label)] += 1 if label else clean_weight
        elif all(k for k, _ in hits):
            for _, number in hits:
                fuzzy[number][bool(label)] += 1 if label else clean_weight
    return [
        (p, whole, (len(s) + 1) / (len(s) + b + 1.2), (fuzzy[i][1] + 3.2) / (sum(fuzzy[i]) + 4))
        for i, ((p, s, b), (_, whole)) in enumerate(zip(chosen, terms, strict=True))
    ], min(0.5, (bare[1] + 0.5) / (sum(bare) + 10))


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The lexicon from at most TOXIC_SAMPLE and CLEAN_SAMPLE labelled documents that are not held out, the least by a hash.

    Their texts, however long, stay with the executors; the driver gets the
    distinct words of each. A doc_id with two labels is an example of both.
    """
    ours = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD))
    ours = ours.select(F.col("doc_id").cast("long").alias("__id"), (F.col("toxic") > 0).cast("int").alias("__toxic")).distinct()
    sizes = {r["__toxic"]: r["count"] for r in ours.groupBy("__toxic").count().collect()}
    wanted = {1: TOXIC_SAMPLE, 0: CLEAN_SAMPLE}
    least = [ours.where(F.col("__toxic") == y).orderBy(F.xxhash64("__id", F.lit(41)), "__id").limit(n) for y, n in wanted.items()]
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").where(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(least[0].union(least[1])), "__id")  # at most the samples, of two numbers each
    rows = rows.select("text", F.col("__toxic").alias("toxic"), F.xxhash64("__id", "text").alias("place"))
    rows = scratch.materialize(rows.repartition(SAMPLE_FILES), "toxic-sample")

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [" ".join(sorted(set(LETTERS.findall(t.lower())))) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("place"), pa.array(found, pa.string())], ["toxic", "place", "words"])

    sets = common.map_batches(rows, words, "toxic int, place long, words string")
    got, last = [], {}
    for y, n in wanted.items():  # rows of repeated doc_ids count towards the sample
        for r in sets.where(F.col("toxic") == y).orderBy("place").limit(n).toLocalIterator():
            got.append(({sys.intern(w) for w in r["words"].split()}, y))
            last[y] = r["place"]
    n = Counter(y for _, y in got)
    weight = max(1.0, sizes.get(0, 0) / max(1, n[0]) / (sizes.get(1, 1) / max(1, n[1]))) if n[0] and n[1] else 1.0
    terms, base = learn_terms(distinct_documents(got), weight)
    lexicon = Lexicon(terms, base)
    if terms:
        alone = quoted_alone(rows.where(F.col("place") <= F.when(F.col("toxic") == 1, F.lit(last[1])).otherwise(F.lit(last[0]))), lexicon)
        seen = 2.4 + alone.get(1, 0), 3.6 + weight * alone.get(0, 0)  # toxic and clean documents, on a prior of 0.4
        lexicon.quoted = seen[0] / sum(seen)
    return lexicon


def quoted_alone(rows: DataFrame, lexicon: Lexicon) -> dict[int, int]:
    """For each label, the documents all of whose hits are quoted."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = Scorer(lexicon)
        hits = [scorer.hits(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([bool(h) and all(q for _, q in h) for h in hits], pa.bool_())], ["toxic", "alone"])

    made = common.map_batches(rows, run, "toxic int, alone boolean")
    return {r["toxic"]: r["count"] for r in made.where("alone").groupBy("toxic").count().collect()}


class Scorer:
    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.trie = Trie([(t, whole) for t, whole, *_ in lexicon.terms])
        self.chunks: dict[str, float] = {}

    def chunk(self, chunk: str) -> float:
        """The chance of abuse of a word as written, 0 for most."""
        word, best = chunk.strip(EDGES), 0.0
        tried = {word, *LETTERS.findall(chunk)} if not word.isalpha() else {word}
        for w in tried:
            found = self.trie.match(w)
            if found:
                _, _, exact, near = self.lexicon.terms[found[1]]
                best = max(best, near if found[0] else exact)
        return best

    def hits(self, text: str) -> list[tuple[float, bool]]:
        """(chance, quoted?) of each hit."""
        if len(self.chunks) > MOST_CACHED:
            self.chunks.clear()
        words, known, out = text.lower().split(), self.chunks, []
        for i, w in enumerate(words):
            chance = known.get(w)
            if chance is None:
                chance = self.chunk(w)
                if len(w) <= 40 and len(known) < 2 * MOST_CACHED:
                    known[w] = chance
            if chance:
                out.append((chance, self.is_quoted(words, i)))
        return out

    @staticmethod
    def is_quoted(words: list[str], at: int) -> bool:
        """Whether the window around a hit shows a quotation: marks opened before it and closed after, or a reporting word."""
        before, after = words[max(0, at - WINDOW) : at + 1], words[at : at + WINDOW + 1]
        opened = any(w[0] in OPENERS for w in before)
        closed = any(w.rstrip(".,;:!?")[-1:] in CLOSERS for w in after)
        return opened and closed or any(w.strip(EDGES) in REPORTS for w in before[:-1])

    def score(self, text: str) -> float:
        clear, quoted = 1.0 - self.lexicon.base, False
        for chance, q in self.hits(text):
            if q:
                quoted = True
            else:
                clear *= 1.0 - min(chance, 0.999)
        if quoted:
            clear *= 1.0 - self.lexicon.quoted
        return min(1.0, max(0.0, 1.0 - clear))


_SCORERS: dict[str, Scorer] = {}


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row; one scan without a shuffle after the lexicon is learned."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))  # at most MOST_TERMS terms
    name = uuid.uuid4().hex  # a worker that lives on may hold another call's scorer

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(model.value)
        found = [_SCORERS[name].score(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()), pa.array([int(x >= threshold) for x in found], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out")
    return common.map_batches(common.text_columns(docs, held), run, SCHEMA)
