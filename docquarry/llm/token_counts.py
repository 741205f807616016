"""Token counts by a finite-state tokenizer.

A byte-pair vocabulary is compiled, as texts need it, into a deterministic
transducer over the symbols of a word. It rests on a property of byte-pair
merges: a sequence of tokens is the encoding of its text exactly if every two
neighbours encode to themselves, so the last token of a prefix is the one suffix
token that is compatible with the last token before it. A state holds, for each
recent place where a token that may still grow has begun, that token's node in
the trie of the vocabulary, the last token before the place, and how many tokens
fewer there were. Whatever else the words before have been is forgotten, so few
states serve many words. A transition reads one symbol and is annotated with the
change of the number of emitted tokens.

Texts are read in chunks, each with its state map: entry state to exit state and
count. White space takes every state back to the start, so what lies between two
gaps has one count whatever the entry state, and those counts are kept for the
words as written. Only what stands before a chunk's first gap depends on the
entry state, and only what stands after its last gap on the exit state. A chunk
without a gap is read from the states that can be alive at its border: those
that the last characters before it lead to. Maps compose associatively, and a
balanced scan composes those of all chunks; should a composition need another
entry state, the map is extended by it, reading on until the states meet.

Cases: a null or empty text has 0 tokens; a null doc_id is passed on; repeated
rows give a row each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from docquarry.llm import common

END = "Ā"  # marks the last symbol of a word; the others are bytes, as characters below U+0100
#: White space as the vocabulary's own pre-tokenizer sees it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
ODD = re.compile("[\x1c-\x1f]")  # white space for str.split, symbols for the vocabulary
GAPS = re.compile(f"[{SPACE}]+")
LETTERS, DIGITS = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
MOST_STATES = 200_000
MOST_WORDS = 400_000
CHUNK = 1 << 16  # characters
BEHIND = 64  # characters before a border that are read to guess the states alive at it
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_names() -> dict[str, str]:
    """The printable characters that byte-level vocabularies use, each with its byte as a character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): chr(b) for b in plain}, 0
    for b in range(256):
        if b not in plain:
            out[chr(256 + extra)] = chr(b)
            extra += 1
    return out


class Transducer:
    """Counts the tokens of a word; its states and transitions are made on first use and dropped when there are too many."""

    def __init__(self, vocabulary: dict):
        model, names = vocabulary["model"], byte_names()
        suffix = model.get("end_of_word_suffix") or ""

        def own(token: str) -> str:
            last = bool(suffix) and token.endswith(suffix)
            body = token[: len(token) - len(suffix)] if last else token
            return "".join(names[c] for c in body) + END * last

        self.made: dict[str, tuple[int, str, str]] = {}  # token: its rank, left and right part
        self.rank: dict[tuple[str, str], int] = {}
        for at, merge in enumerate(model["merges"]):
            left, right = (own(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank[left, right] = at
            self.made.setdefault(left + right, (at, left, right))
        # the trie: a node's transitions, and the token that ends there
        self.nodes: list[dict[str, int]] = [{}]
        self.token: list[str | None] = [None]
        for token in self.made:
            node, body = 0, token.removesuffix(END)
            for symbol in [*body[:-1], body[-1] + END] if body != token else body:
                if symbol not in self.nodes[node]:
                    self.nodes[node][symbol] = len(self.nodes)
                    self.nodes.append({})
                    self.token.append(None)
                node = self.nodes[node][symbol]
            self.token[node] = token
        self.fits: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Back to the start state alone."""
        start = ((0, "", 0),)
        self.states: list[tuple[tuple[int, str, int], ...]] = [start]
        self.known: dict[tuple, int] = {start: 0}
        self.step: list[dict[str, tuple[int, int]]] = [{}]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merges leave the border between two tokens standing.

        Undo the merges on both sides of the border, the latest first: the border
        falls if the two parts at it merge before either grew into its parent.
        """
        got = self.fits.get((left, right))
        if got is None:
            got = self._compatible(left, right)
            if len(self.fits) > 4 * MOST_WORDS:
                self.fits.clear()
            self.fits[left, right] = got
        return got

    def _compatible(self, a: str, b: str) -> bool:
        before = 1 << 60
        while True:
            if self.rank.get((a, b), before) < before:
                return False
            ra, rb = self.made.get(a, (-1,))[0], self.made.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                before, a = ra, self.made[a][2]
            else:
                before, b = rb + 1, self.made[b][1]  # of equal merges the left one goes first

    def advance(self, state: int, symbol: str) -> tuple[int, int]:
        """The next state and the change of the count; both are kept. A symbol with the end mark leads back to the start."""
        nodes, token, grown, last, delta = self.nodes, self.token, [], symbol, None
        for node, before, fewer in self.states[state]:  # the longest first
            then = nodes[node].get(symbol)
            if then is None:
                continue
            made = token[then]
            if delta is None and made is not None and (not before or self.compatible(before, made)):
                last, delta = made, fewer + 1
            if nodes[then]:
                grown.append((then, before, fewer))
        if delta is None:
            delta = 1
        to = 0
        if symbol[-1] != END or len(symbol) == 1:
            key = (*((then, before, fewer - delta) for then, before, fewer in grown), (0, last, 0))
            to = self.known.get(key)
            if to is None:
                to = self.known[key] = len(self.states)
                self.states.append(key)
                self.step.append({})
        self.step[state][symbol] = (to, delta)
        return to, delta

    def count(self, word: str) -> int:
        """Tokens of a word given as bytes in characters; its last symbol bears the end mark."""
        if len(self.states) > MOST_STATES:
            self.reset()
        state, total, step = 0, 0, self.step
        for symbol in word[:-1]:
            state, delta = step[state].get(symbol) or self.advance(state, symbol)
            total += delta
        symbol = word[-1] + END
        return total + (step[state].get(symbol) or self.advance(state, symbol))[1]


#: A place between two characters: the class of the piece that is open there, the transducer's state before that piece's last symbol, and that symbol.
Place = tuple[str, int, str]
START: Place = ("", 0, "")
LETTER, DIGIT, OTHER = "L", "N", "O"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class StateMap:
    """Of a chunk: entry place to exit place and count, for the entries asked for so far."""

    def __init__(self, counter: TokenCounter, parts: tuple[str, int | None, str], entries: set[Place]):
        self.counter, self.parts, self.known = counter, parts, {}
        for entry in entries:
            self(entry)

    def __call__(self, entry: Place) -> tuple[Place, int]:
        if entry not in self.known:
            head, between, tail = self.parts
            place, count = self.counter.read(entry, head)
            if between is not None:
                count += self.counter.close(place) + between
                place, more = self.counter.read(START, tail)
                count += more
            self.known[entry] = place, count
        return self.known[entry]


class Composed:
    """The map of two neighbours."""

    def __init__(self, first: StateMap | Composed, second: StateMap | Composed):
        self.first, self.second, self.known = first, second, {}
        for entry in first.known:
            self(entry)

    def __call__(self, entry: Place) -> tuple[Place, int]:
        if entry not in self.known:
            place, a = self.first(entry)
            place, b = self.second(place)
            self.known[entry] = place, a + b
        return self.known[entry]


class TokenCounter:
    """Counts tokens of whole texts as the vocabulary's library does, without added special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)
        self.transducer = Transducer(vocabulary)
        special = sorted((x["content"] for x in vocabulary["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}
        self.kinds: dict[str, str] = {}

    def word(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = self.transducer.count(word if word.isascii() else word.encode().decode("latin-1"))
            if len(word) < 64:
                if len(self.words) > MOST_WORDS:
                    self.words.clear()
                self.words[word] = n
        return n

    def unspaced(self, chunk: str) -> int:
        """Tokens of a normalised chunk without white space."""
        n = self.chunks.get(chunk)
        if n is None:
            n = sum(map(self.word, PIECES.findall(chunk)))
            if len(chunk) < 64:
                if len(self.chunks) > MOST_WORDS:
                    self.chunks.clear()
                self.chunks[chunk] = n
        return n

    def parts(self, chunk: str) -> tuple[str, int | None, str]:
        """(what stands before the first gap, tokens between, what stands after the last gap); without a gap the count is None."""
        found = GAPS.split(chunk) if ODD.search(chunk) else chunk.split()
        if not found:
            return ("", 0, "") if chunk else ("", None, "")
        if len(found) == 1 and not GAPS.search(chunk):
            return found[0], None, ""
        head = "" if GAPS.match(chunk[0]) else found.pop(0)
        tail = "" if GAPS.match(chunk[-1]) or not found else found.pop()
        return head, self.between(found), tail

    def between(self, words: list[str]) -> int:
        known, unspaced = self.chunks, self.unspaced
        return sum([known[w] if w in known else unspaced(w) for w in words])

    def read(self, place: Place, text: str) -> tuple[Place, int]:
        """The place after a text without white space, and the tokens that were emitted on the way.

        The open piece's class is one of letters, digits, others, or an apostrophe
        with what has followed it while an ending (as in don't) may come.
        """
        (kind, state, pending), total, step, advance = place, 0, self.transducer.step, self.transducer.advance
        for c in text:
            now = self.kind(c)
            if kind[:1] == "'":  # after an apostrophe that began a piece
                seen = kind[1:] + c
                if any(e.startswith(seen) for e in ENDINGS):
                    if seen in ENDINGS:
                        total += self.word("'" + seen)
                        kind, state, pending = START
                    else:
                        kind += c
                    continue
                if len(kind) == 1 and now == OTHER:
                    kind = OTHER  # an ordinary piece, of which the apostrophe is the open symbol
                else:
                    total += self.word("'")
                    kind, state, pending = (LETTER, 0, kind[1:]) if len(kind) > 1 else START
            if pending and (now != kind or now == DIGIT):
                total += (step[state].get(pending + END) or advance(state, pending + END))[1]
                kind, state, pending = START
            if not pending and c == "'":
                kind, pending = c, c
                continue
            symbols = c if c.isascii() else c.encode().decode("latin-1")
            for symbol in symbols:
                if pending:
                    state, delta = step[state].get(pending) or advance(state, pending)
                    total += delta
                pending = symbol
            kind = now
        return (kind, state, pending), total

    def close(self, place: Place) -> int:
        """Tokens that the end of a text or a gap emits."""
        kind, state, pending = place
        if kind[:1] == "'":
            return self.word("'") + (self.word(kind[1:]) if len(kind) > 1 else 0)
        if not pending:
            return 0
        return (self.transducer.step[state].get(pending + END) or self.transducer.advance(state, pending + END))[1]

    def kind(self, c: str) -> str:
        found = self.kinds.get(c)
        if found is None:
            found = self.kinds[c] = LETTER if LETTERS.match(c) else DIGIT if DIGITS.match(c) else OTHER
        return found

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma: characters are lowered one by one
        return text.lower()

    def plain(self, text: str) -> int:
        """Tokens of a text that holds no special token."""
        text = self.normal(text)
        if len(text) <= CHUNK and not ODD.search(text):  # one chunk, read from the start and closed at its end
            return self.between(text.split())
        if len(self.transducer.states) > MOST_STATES:
            self.transducer.reset()
        maps: list[StateMap | Composed] = []
        for at in range(0, len(text), CHUNK):
            parts = self.parts(text[at : at + CHUNK])
            behind = self.parts(text[max(0, at - BEHIND) : at])
            alive = self.read(START, behind[0] if behind[1] is None else behind[2])[0]
            maps.append(StateMap(self, parts, {alive}))
        while len(maps) > 1:  # a balanced scan: each level composes neighbours
            maps = [Composed(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        place, count = maps[0](START) if maps else (START, 0)
        return count + self.close(place)

    def count(self, text: str) -> int:
        if self.special is None or "<|" not in text:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One counter for each vocabulary and process; workers that live on keep its states."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and whether they are over ``limit``, for each row. One scan, no shuffle."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        made = counter(vocabulary)
        n = [made.count(t) for t in texts]
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"),
            pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64()),
            pa.array(n, pa.int64()),
            pa.array([x > limit for x in n], pa.bool_()),
        ], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return common.map_batches(common.text_columns(docs), count, SCHEMA)
