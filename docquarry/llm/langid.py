"""Language identification by unigrams of pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language that the labels
name has a probability for every piece, fitted by expectation maximisation on a
bounded sample of the labelled rows, whose whole texts' words are counted by the
executors. The probability of a word is the sum over all its segmentations into
pieces, by the forward algorithm on a trie of the vocabulary, for many words at
once; that of a text is the product over its words, since a piece never
crosses white space. The prediction is the language of highest posterior under
equal priors, and the score its posterior.

Only the words' letters count, lowered. A word's vector of log-probabilities is
kept in a bounded table in each worker. Long words are rescaled on the way, so
a text of any length is scored whole.

Cases: a null text and one without a letter is "und" with score 0, and so is
every text where no language was learned; ties go to the language that sorts
first; a null doc_id is not held out, not learned from, and passed on; repeated
rows give a row each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.llm import common

FOLDS, HELD = 4, 2
SAMPLE = 1_000  # documents of a language that are learned from, about
ROUNDS = 3
SHORT = 24  # letters of a word whose probability can't underflow
PART = 400  # letters of a word that the fit sees in one piece
AT_ONCE = 20_000  # words of a lattice
MOST_CACHED = 800_000  # words as written that a worker keeps
MOST_CELLS = 8_000_000  # numbers in its table of words
START = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
SMALL, RAISE = 1e-200, 1e200
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds


class Pieces:
    """The vocabulary's pieces of letters as a trie: a node maps a character to the next node, and "" to a piece's number."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
        self.names = sorted(n for n in names if n and n.removeprefix(START).isalpha() or n == START)
        self.root: dict = {}
        for number, name in enumerate(self.names):
            node = self.root
            for c in name:
                node = node.setdefault(c, {})
            node[""] = number
        self.unknown = len(self.names)  # stands for any character without a piece of its own
        # the same trie in arrays: letters by class (0 for any other), the next node by node and class, the piece by node
        symbols = sorted({c for n in self.names for c in n})
        self.points = np.array([ord(c) for c in symbols], dtype=np.int64)
        number, nodes, stack = {c: i + 1 for i, c in enumerate(symbols)}, 1, [(self.root, 0)]
        keys, to, ends = [], [], [-1]
        while stack:
            node, at = stack.pop()
            for c, child in node.items():
                if c:
                    keys.append(at * (len(symbols) + 1) + number[c])
                    to.append(nodes)
                    ends.append(child.get("", -1))
                    stack.append((child, nodes))
                    nodes += 1
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys, self.to, self.piece_at = np.array(keys, dtype=np.int64)[order], np.array(to, dtype=np.int64)[order], np.array(ends, dtype=np.int64)
        self.width = len(symbols) + 1

    def classes(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[at] == points, at + 1, 0)

    def follow(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The nodes after a letter each; -1 where there is none."""
        key = node * self.width + letter
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (letter > 0), self.to[at], -1)

    def arcs(self, word: str) -> list[list[tuple[int, int]]]:
        """For each position of the marked word, the (end, piece) that start there."""
        out = []
        for i in range(len(word)):
            here, node, j = [], self.root, i
            while j < len(word) and (node := node.get(word[j])) is not None:
                j += 1
                if "" in node:
                    here.append((j, node[""]))
            if not here or here[0][0] > i + 1:
                here.append((i + 1, self.unknown))
            out.append(here)
        return out


def forward(arcs: list[list[tuple[int, int]]], chance: list[tuple[float, ...]], langs: int) -> list[float]:
    """The log-probability of a word in each language: all segmentations summed."""
    n, none = len(arcs), (0.0,) * langs
    alpha: dict[int, tuple[float, ...]] = {0: (1.0,) * langs}
    lifted = 0
    for i, here in enumerate(arcs):
        a = alpha.pop(i, none)
        if max(a) < SMALL:
            a = tuple(x * RAISE for x in a)
            alpha = {j: tuple(x * RAISE for x in v) for j, v in alpha.items()}
            lifted += 1
        for j, piece in here:
            p = chance[piece]
            had = alpha.get(j)
            alpha[j] = tuple([x * y for x, y in zip(a, p)]) if had is None else tuple([h + x * y for h, x, y in zip(had, a, p)])
    return [math.log(max(x, 1e-300)) - lifted * math.log(RAISE) for x in alpha[n]]


class Lattice:
    """The pieces of many words at once: for each start and length, the words that have a piece there, and which."""

    def __init__(self, words: list[str], pieces: Pieces):
        marked = [START + w for w in words]
        self.length = np.array([len(w) for w in marked], dtype=np.int64)
        most = int(self.length.max(initial=0))
        letters = np.zeros((len(words), most + 1), dtype=np.int64)  # 0 ends a word
        points = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32)
        row = np.repeat(np.arange(len(words)), self.length)
        letters[row, np.arange(len(points)) - np.repeat(np.cumsum(self.length) - self.length, self.length)] = pieces.classes(points)
        self.arcs: list[list[tuple[int, np.ndarray, np.ndarray]]] = []  # by start: (end, words, pieces)
        for start in range(most):
            own, here = np.nonzero(self.length > start)[0], []
            node, end = np.zeros(len(own), dtype=np.int64), start
            while len(own):
                node = pieces.follow(node, letters[own, end])
                end += 1
                alive = node >= 0
                piece = np.where(alive, pieces.piece_at[node], -1)
                has = piece >= 0
                if end == start + 1:  # any character is a piece, if none of its own the unknown one
                    here.append((end, own, np.where(has, piece, pieces.unknown)))
                elif has.any():
                    here.append((end, own[has], piece[has]))
                own, node = own[alive], node[alive]
                going = self.length[own] > end
                own, node = own[going], node[going]
            self.arcs.append(here)

    def forward(self, chance: np.ndarray) -> np.ndarray:
        """alpha (word, place, language) for ``chance`` (piece, language)."""
        alpha = np.zeros((len(self.length), int(self.length.max(initial=0)) + 1, chance.shape[1]), dtype=chance.dtype)
        alpha[:, 0] = 1.0
        for start, here in enumerate(self.arcs):
            for end, own, piece in here:
                alpha[own, end] += alpha[own, start] * chance[piece]
        return alpha

    def totals(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[np.arange(len(self.length)), self.length]

    def expected(self, chance: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all segmentations, in words that occur so many times."""
        alpha = self.forward(chance[:, None])[:, :, 0]
        total = self.totals(alpha)
        beta = np.zeros_like(alpha)
        beta[np.arange(len(total)), self.length] = np.where(total > 0, times / np.where(total > 0, total, 1), 0)
        out = np.zeros(len(chance))
        for start in range(len(self.arcs) - 1, -1, -1):
            for end, own, piece in self.arcs[start]:
                used = chance[piece] * beta[own, end]
                beta[own, start] += used
                out += np.bincount(piece, weights=(alpha[own, start] * used).astype(float), minlength=len(out))
        return out


def fit(words: dict[str, int], pieces: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation over all segmentations, smoothed. Very long words are fitted in parts."""
    parts: Counter = Counter()
    for w, k in words.items():
        for at in range(0, len(w), PART):
            parts[w[at : at + PART]] += k
    items = sorted(parts.items(), key=lambda x: (len(x[0]), x[0]))
    size = len(pieces.names) + 1
    chance = np.full(size, 1.0 / size)
    at, blocks = 0, []
    while at < len(items):  # of words alike long; long ones in numbers of more range and in smaller blocks
        n = AT_ONCE if len(items[min(at + AT_ONCE, len(items)) - 1][0]) <= SHORT else max(1, AT_ONCE * SHORT // (8 * len(items[at][0]) + 200))
        blocks.append(items[at : at + n])
        at += n
    for _ in range(rounds):
        expected = np.zeros(size)
        for block in blocks:
            kind = float if len(block[-1][0]) <= SHORT else np.longdouble
            expected += Lattice([w for w, _ in block], pieces).expected(chance.astype(kind), np.array([k for _, k in block], dtype=kind))
        chance = (expected + 0.02) / (expected.sum() + 0.02 * size)
    return chance


def sample_by(docs: DataFrame, column: Column, sizes: dict, wanted: int) -> DataFrame:
    """About ``wanted`` rows of each value of ``column``, all where there are fewer, taken by a hash of doc_id; no shuffle."""
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(column == value, F.lit(min(1.0, wanted / max(1, n)))).otherwise(share)
    return docs.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(99)), F.lit(1 << 30)) < share * (1 << 30))


def learn(docs: DataFrame, vocabulary: str, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(languages, pieces by languages) from about ``sample`` documents of each language that are not held out.

    The driver gets the words of those documents with their counts, not their texts.
    """
    ours = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD))
    sizes = {r["lang"]: r["count"] for r in ours.groupBy("lang").count().collect()}  # a row for each language

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
        rows = [(lang, w, n) for lang, c in found.items() for w, n in c.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

    picked = sample_by(ours, F.col("lang"), sizes, sample).select("lang", "text")
    counted = common.map_batches(picked, count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    words: dict[str, dict[str, int]] = {}
    for batch in counted.to_batches():
        for lang, w, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words.setdefault(lang, {})[w] = n
    langs = sorted(words)
    pieces = Pieces(vocabulary)
    return langs, np.array([fit(words[lang], pieces) for lang in langs]).T


class Scorer:
    def __init__(self, vocabulary: str, langs: list[str], chance: np.ndarray):
        self.pieces, self.langs = Pieces(vocabulary), langs
        self.matrix = chance
        self.chance = [tuple(row) for row in chance.tolist()]
        self.reset()

    def reset(self) -> None:
        self.row: dict[str, int] = {"": 0}
        self.used, self.table = 1, np.zeros((4096, len(self.langs) + 1))  # the last column: how many words

    def logs(self, words: list[str]) -> np.ndarray:
        """The log-probabilities of words of letters, by word and language."""
        out = np.zeros((len(words), len(self.langs)))
        short = np.array([i for i, w in enumerate(words) if len(w) <= SHORT], dtype=np.int64)
        n = max(1, min(AT_ONCE, 8_000_000 // (SHORT * max(1, len(self.langs)))))
        for at in range(0, len(short), n):
            own = short[at : at + n]
            lattice = Lattice([words[i] for i in own], self.pieces)
            out[own] = np.log(np.maximum(lattice.totals(lattice.forward(self.matrix)), 1e-300))
        for i, w in enumerate(words):
            if len(w) > SHORT:
                out[i] = forward(self.pieces.arcs(START + w), self.chance, len(self.langs))
        return out

    def add(self, chunks: list[str]) -> None:
        """Rows for words as written; one that holds a single run of letters shares that run's row."""
        runs = [[c] if c.isalpha() else LETTERS.findall(c) for c in chunks]
        new = sorted({w for r in runs for w in r} - self.row.keys())
        many = [(c, r) for c, r in zip(chunks, runs, strict=True) if len(r) != 1]
        while self.used + len(new) + len(many) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        if new:
            self.table[self.used : self.used + len(new), :-1] = self.logs(new)
            self.table[self.used : self.used + len(new), -1] = 1
            self.row.update(zip(new, range(self.used, self.used + len(new)), strict=True))
            self.used += len(new)
        for c, r in many:
            self.table[self.used] = self.table[[self.row[w] for w in r]].sum(0)
            self.row[c] = self.used
            self.used += 1
        self.row.update((c, self.row[r[0]]) for c, r in zip(chunks, runs, strict=True) if len(r) == 1)

    def scores(self, texts: list[str]) -> list[tuple[str, float]]:
        """Texts together: their new words are looked up at once."""
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        if len(self.row) > MOST_CACHED or self.table.size > MOST_CELLS:
            self.reset()
        out, split, held = [], [t.lower().split() for t in texts], set()
        for words in split:
            held.update(words)
        self.add(sorted(held - self.row.keys()))
        row, table = self.row, self.table
        for words in split:
            total = table[[row[w] for w in words]].sum(0) if words else table[0]
            if not total[-1]:
                out.append(("und", 0.0))
                continue
            logs = total[:-1] - total[:-1].max()
            out.append((self.langs[int(logs.argmax())], float(1.0 / np.exp(logs).sum())))
        return out


_SCORERS: dict[str, Scorer] = {}


def identify(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row; one scan without a shuffle after the model is learned."""
    langs, chance = learn(docs, vocabulary)
    model = docs.sparkSession.sparkContext.broadcast((langs, chance))  # a number for each piece of the vocabulary and language
    name = uuid.uuid4().hex  # a worker that lives on may hold another call's model

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(vocabulary, *model.value)
        found = _SCORERS[name].scores(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out")
    return common.map_batches(common.text_columns(docs, held), run, SCHEMA)
