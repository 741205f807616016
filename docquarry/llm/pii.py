"""Personal data in texts, also where it is disguised, with spans of the source text.

Base identifiers are found by linear scanners equal to the published patterns.
Beyond them, a chain of offset-preserving transducers rewrites a text: homoglyphs
and wide forms to their plain letter, invisible characters to nothing, spelled
digits to digits, and disguises of "at" and "dot" to the sign. Each is a deterministic machine over the symbols of
tokens, compiled to a table of transitions with an output for each state; each
output character keeps the source span that it was made from. A spelled
"at" needs more than a dot after it: a host with a known end, and before a plain
host a name that looks like an address; so whether a span is found hangs on its
own words alone. The same scanners then run on the
rewritten text, and what they find maps back to source characters. Such a span
is added if a rewriting lies inside it and no span of its kind overlaps it.

Positions count code points; ends are exclusive.

Cases: a null or empty text has no spans; a null doc_id is passed on; repeated
rows give a row each; an empty table gives an empty result; texts of any length
are scanned whole in linear time; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.llm import common

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def emails(text: str) -> list[Span]:
    """Each match holds one @: its local part is the run before it, back to the last match; so every character is read a bounded number of times."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def ips(text: str) -> list[Span]:
    """A match starts where a run of digits does: it always ends at a run's end."""
    return [m.span() for m in IP.finditer(text) if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split("."))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]


def base_spans(text: str) -> dict[str, list[Span]]:
    digit = DIGIT.search(text)
    return {"email": emails(text), "ip": ips(text) if digit else [], "card": cards(text) if digit else [], "phone": phones(text) if digit else []}


# --- the transducers

LOOKALIKES = {
    **dict(zip("аеорсухіјѕԁһӏАВЕКМНОРСТУХІЈЅ", "aeopcyxijsdhlABEKMHOPCTYXIJS", strict=True)),  # Cyrillic
    **dict(zip("αορνικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aopvikABEZHIKMNOPTYX", strict=True)),  # Greek
    **{chr(0xFF01 + i): chr(0x21 + i) for i in range(94)},  # full width
    **{chr(base + i): chr(48 + i) for base in (0x660, 0x6F0, 0x966, 0x9E6, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for i in range(10)},  # other scripts' digits
    **{chr(0x2460 + i): chr(49 + i) for i in range(9)}, "⓪": "0",  # circled
    **{chr(base + i): chr(start + i) for base, start in ((0x1D41A, 97), (0x1D400, 65), (0x1D5BA, 97), (0x1D5A0, 65), (0x1D68A, 97), (0x1D670, 65)) for i in range(26)},  # mathematical letters
    "․": ".", "。": ".", "｡": ".", "‧": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹫": "@", "\xa0": " ", " ": " ", " ": " ", " ": " ",
}
HIDDEN = "​‌‍⁠﻿\xad"
MAPPED = re.compile(f"[{re.escape(''.join(LOOKALIKES))}{HIDDEN}]")
_NUMBERS = {
    "zero oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei zwo": "2", "drei": "3", "vier": "4", "fünf fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
SPELLED = {w: d for ws, d in _NUMBERS.items() for w in ws.split()}
_AT, _DOT = ("at", "arroba", "klammeraffe"), ("dot", "punkt", "point", "punto")
#: Ends of hosts that a spelled address may have; those that are words of prose (in, it, is, me, at, so, to, no, be, as) are left out.
_ENDS = "com org net edu gov mil info biz io co uk de fr es eu ch nl pl pt br mx ar jp cn ru se dk fi cz ie ca au nz dev app example test invalid".split()
#: Words that no spoken host starts with.
_PROSE = "the this that these those a an some any every each which what one no my our your his her its their first last least most all home".split()
BRACKETS = {"(": ")", "[": "]", "{": "}", "<": ">"}
TOKEN = re.compile(r"[^\W\d_]+|\d+|\s|.", re.S)

# Symbols of tokens: T at, D dot, N number word, L plus, E end of a host, P prose, W other ASCII letters, F figures, S space, s other white space, G signs of names, U other letters and figures, X anything else; . - @ and brackets are themselves.
KINDS_OF_WORDS = {**dict.fromkeys(_PROSE, "P"), **dict.fromkeys(_ENDS, "E"), **dict.fromkeys(SPELLED, "N"), **dict.fromkeys(_AT, "T"), **dict.fromkeys(_DOT, "D"), "plus": "L"}
LETTERED = "TDNLEPW"


@lru_cache(1 << 16)
def symbol(token: str) -> str:
    if token.isalpha():
        return KINDS_OF_WORDS.get(token.lower()) or ("W" if token.isascii() else "U")
    if token.isdigit():
        return "F" if token.isascii() else "U"
    if token.isspace():
        return "S" if token == " " else "s"
    return token if token in ".-@()[]{}<>" else "G" if token in "_%+" else "X"


def tokens(text: str) -> tuple[list[Span], str]:
    """The spans of a text's tokens, and their symbols."""
    marks = [m.span() for m in TOKEN.finditer(text)]
    return marks, "".join([symbol(text[a:b]) for a, b in marks])


Table = dict[str, dict[str, str]]


def arcs(table: Table, state: str, symbols: str, to: str) -> None:
    table.setdefault(state, {}).update(dict.fromkeys(symbols, to))


def bracketed_signs() -> tuple[Table, dict[str, str], set[str]]:
    """(table, outputs, accepting) of "[at]", "( dot )" and the like, with up to three white spaces on both sides."""
    t: Table = {}
    out: dict[str, str] = {}
    for k in range(3):
        arcs(t, f"before{k}" if k else "start", "Ss", f"before{k + 1}")
        arcs(t, f"close{k}", "Ss", f"close{k + 1}")
    for k in range(4):
        for left, right in BRACKETS.items():
            arcs(t, f"before{k}" if k else "start", left, left)
            for sign, symbols in (("@", "T@"), (".", "D.")):
                arcs(t, left, "Ss", left + " ")
                for had in (left, left + " "):
                    arcs(t, had, symbols, left + sign)
                arcs(t, left + sign, "Ss", left + sign + " ")
                for had in (left + sign, left + sign + " "):
                    arcs(t, had, right, "close0")
                out[left + sign] = sign
    every = {*t, *(x for d in t.values() for x in d.values())}
    return t, {x: out.get(x, "") for x in every}, {f"close{k}" for k in range(4)}


def spoken_addresses() -> tuple[Table, dict[str, str], set[str]]:
    """(table, outputs, accepting) of addresses with a spelled at or dots.

    A name is plain (p), like an address (l: joined by signs, or letters with figures
    at their end) or spelled with dots (d). After a spelled at, a plain name needs a
    host whose last dot is spelled, any other one with any dot, both with a known
    end. After a sign, a host needs a spelled dot, unless the name has one.
    """
    t: Table = {}
    out: dict[str, str] = {}
    word, sign, host = LETTERED + "F", ".-G", "TDNLEWF-"
    arcs(t, "start", LETTERED, "name p")
    arcs(t, "start", "F", "figures p")
    for kind in "pld":
        like = "d" if kind == "d" else "l"
        arcs(t, f"name {kind}", "F", f"name {like}")  # figures at the end
        arcs(t, f"name {kind}", LETTERED, f"name {kind}")
        arcs(t, f"figures {kind}", word, f"name {kind}")
        for had in (f"name {kind}", f"figures {kind}"):
            arcs(t, had, sign, f"sign {kind}")
            arcs(t, had, "Ss", f"gap {kind}")
            arcs(t, had, "@", f"host {kind}@0")
        arcs(t, f"sign {kind}", sign, f"sign {kind}")
        arcs(t, f"sign {kind}", word, f"name {like}")
        arcs(t, f"gap {kind}", "T", f"at {kind}")
        arcs(t, f"gap {kind}", "D", "dot in name")
        out |= {f"gap {kind}": "", f"at {kind}": "@", f"after at {kind}": ""}
        arcs(t, f"at {kind}", "Ss", f"after at {kind}")
        for way in " @":
            h = f"host {kind}{way}"  # followed by what the host has so far: 0 no label, 1 labels, ! an end that will do
            first = f"after at {kind}" if way == " " else h + "0"
            arcs(t, first, host, h + "1")
            for had in "1!":
                arcs(t, h + had, host, h + "1")
                arcs(t, h + had, ".", h + ".")
                arcs(t, h + had, "Ss", h + "gap")
            arcs(t, h + ".", host, h + "1")
            if kind != "p" and way == " ":
                arcs(t, h + ".", "E", h + "!")
            if kind == "d" and way == "@":
                arcs(t, h + ".", host, h + "!")
                arcs(t, h + "!", host, h + "!")
            arcs(t, h + "gap", "D", h + "dot")
            arcs(t, h + "dot", "Ss", h + "next")
            arcs(t, h + "next", host, h + ("!" if way == "@" else "1"))
            arcs(t, h + "next", "E", h + "!")
            if way == "@":
                arcs(t, h + "!", host, h + "!")
            out |= {h + "gap": "", h + "dot": ".", h + "next": ""}
    arcs(t, "dot in name", "Ss", "after dot")
    arcs(t, "after dot", word, "name d")
    out |= {"dot in name": ".", "after dot": ""}
    every = {*t, *(x for d in t.values() for x in d.values())}
    return t, out, {x for x in every if x.endswith("!")}


def spelled_numbers() -> tuple[Table, dict[str, str], set[str]]:
    """(table, outputs, accepting) of two or more spelled digits in a row, or of one beside a figure; a lone number word is prose. An output "#" is the word's digit."""
    t: Table = {}
    for had, sep in (("N", "N "), ("F", "F "), ("N!", "N! "), ("F!", "F! ")):
        arcs(t, had, "S-", sep)
        done = "!" if "!" in had else ""
        arcs(t, sep, "N", "N!")
        arcs(t, sep, "F", "F!" if done or had[0] == "N" else "F")
    arcs(t, "start", "N", "N")
    arcs(t, "start", "F", "F")
    return t, {"N": "#", "N!": "#"}, {"N!", "F!"}


def spelled_dots() -> tuple[Table, dict[str, str], set[str]]:
    """(table, outputs, accepting) of figures with spelled dots between."""
    t: Table = {}
    for had in ("start", "next"):
        arcs(t, had, "F", "F" if had == "start" else "F!")
    for had in ("F", "F!"):
        arcs(t, had, "Ss", "gap")
    arcs(t, "gap", "D", "dot")
    arcs(t, "dot", "Ss", "next")
    return t, {"gap": "", "dot": ".", "next": ""}, {"F!"}


def spelled_plus() -> tuple[Table, dict[str, str], set[str]]:
    """(table, outputs, accepting) of a plus before figures."""
    t: Table = {"start": {"L": "plus"}, "plus": {"S": "gap", "F": "F!"}, "gap": {"F": "F!"}}
    return t, {"plus": "+", "gap": ""}, {"F!"}


Edit = tuple[int, int, str]


class Tape:
    """A text with the source span of each of its characters, and whether a rewriting made it."""

    def __init__(self, text: str):
        self.text, self.start, self.end, self.made = text, range(len(text)), range(1, len(text) + 1), bytearray(len(text))

    def rewrite(self, edits: list[Edit]) -> None:
        """Replace (start, end, by), in order and apart; a replacement's characters share the whole replaced source span."""
        if not edits:
            return
        text, start, end, made, at = [], [], [], bytearray(), 0
        for a, b, by in edits:
            text += [self.text[at:a], by]
            start += [*self.start[at:a], *[self.start[a]] * len(by)]
            end += [*self.end[at:a], *[self.end[b - 1]] * len(by)]
            made += self.made[at:a] + b"\x01" * len(by)
            at = b
        text.append(self.text[at:])
        self.start, self.end, self.made = [*start, *self.start[at:]], [*end, *self.end[at:]], made + self.made[at:]
        self.text = "".join(text)


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine over the symbols of tokens: transitions by state, an output for the token read on entering a state (none: the token itself), and the accepting states.

    It starts wherever ``starts`` lets it, reads on to the last place at which it
    accepts, and goes on behind that. Its edits carry source offsets.
    """

    table: Table
    outputs: dict[str, str]
    accepts: set[str]
    starts: Callable[[str, int], bool]
    needs: str  # one of these symbols, or there is nothing to read
    whole: bool = True  # it ends at a word's end

    def edits(self, text: str, read: tuple[list[Span], str] | None = None) -> list[Edit]:
        marks, symbols = read or tokens(text)
        table, first, out, at = self.table, self.table["start"], [], 0
        if not any(c in symbols for c in self.needs):
            return out
        while at < len(symbols):
            if symbols[at] not in first or not self.starts(symbols, at):
                at += 1
                continue
            state, path, good, turn = "start", [], 0, 0
            for k in range(at, len(symbols)):
                state = table.get(state, {}).get(symbols[k])
                if state is None:
                    break
                path.append(state)
                if state in self.accepts and (not self.whole or self.borders(symbols, k + 1)):
                    good = len(path)
                if not turn and state[:3] == "at ":
                    turn = len(path)  # what follows can be the name of another address
            else:
                k += 1
            if good:
                out += self.written(text, marks[at : at + good], path[:good])
                at += good
            else:
                at = at + turn if turn else max(at + 1, min(k, at + len(path)))
        return out

    @staticmethod
    def borders(symbols: str, end: int) -> bool:
        """Whether what was read ends there, and not in the middle of a word."""
        return end >= len(symbols) or not (symbols[end] in LETTERED + "FU" and symbols[end - 1] in LETTERED + "F")

    def written(self, text: str, marks: list[Span], path: list[str]) -> list[Edit]:
        """The replaced runs of tokens: (start, end, by)."""
        out: list[Edit] = []
        for k, ((a, b), state) in enumerate(zip(marks, path, strict=True)):
            by = self.outputs.get(state)
            if by == "#":
                by = SPELLED[text[a:b].lower()]
            elif by is None and state[0] == "N" and state.endswith(" ") and text[a] == " " and k + 1 < len(path) and path[k + 1][0] == "N":
                by = ""  # spelled digits run together; separators beside figures stay
            if by is None:
                continue
            if out and out[-1][1] == a and not (by and out[-1][2]):
                out[-1] = (out[-1][0], b, out[-1][2] + by)
            else:
                out.append((a, b, by))
        return out


def free(symbols: str, at: int) -> bool:
    """Not in the middle of a word."""
    return at == 0 or symbols[at - 1] not in LETTERED + "FU"


def anywhere(symbols: str, at: int) -> bool:
    return True


def first_of_name(symbols: str, at: int) -> bool:
    return at == 0 or symbols[at - 1] not in LETTERED + "FU.-G"


def no_sum(symbols: str, at: int) -> bool:
    """A plus after a figure adds."""
    return free(symbols, at) and not (at > 1 and symbols[at - 1] == "S" and symbols[at - 2] == "F")


def normalise(text: str) -> Tape | None:
    """The rewritten tape, or None where no transducer has anything to read."""
    tape = None
    if not text.isascii() and MAPPED.search(text):  # a look-alike counts wherever it stands: spans map back either way
        tape = Tape(text)
        tape.rewrite([(m.start(), m.end(), LOOKALIKES.get(m[0], "")) for m in MAPPED.finditer(text)])
    lowered = (tape.text if tape else text).lower()
    if not (SCREEN.search(lowered) and HINT.search(lowered)):
        return tape
    tape = tape or Tape(text)
    read = tokens(tape.text)
    for t in CHAIN:
        if edits := t.edits(tape.text, read):
            tape.rewrite(edits)
            read = tokens(tape.text)
    return tape


#: In this order each reads what the one before has written.
CHAIN = (
    Transducer(*bracketed_signs(), anywhere, "([{<", whole=False),
    Transducer(*spoken_addresses(), first_of_name, "TD"),
    Transducer(*spelled_dots(), anywhere, "D", whole=False),
    Transducer(*spelled_numbers(), free, "N"),
    Transducer(*spelled_plus(), no_sum, "L", whole=False),
)


def by_first_letter(words: Iterable[str]) -> str:
    """A pattern of the words that decides by one letter at a time."""
    groups: dict[str, list[str]] = {}
    for w in words:
        groups.setdefault(w[:1], []).append(w[1:])
    return "(?:" + "|".join(c + by_first_letter(rest) if c else "" for c, rest in sorted(groups.items(), reverse=True)) + ")"


_N, _A, _D = (by_first_letter(words) for words in (SPELLED, _AT, _DOT))
_SIGNED = rf"[\[({{<]\s?(?:{_A}|{_D}|@|\.)\s?[\])}}>]"
#: Two tests on the lowered text, a quick one and a close one; each matches every text in which some transducer accepts.
SCREEN = re.compile(rf"(?:^|[\W\d_])(?:{by_first_letter([*SPELLED, *_DOT])}(?![^\W_])|{_A}\s[a-z0-9-]+\.[a-z0-9-]|plus ?[0-9])|{_SIGNED}")
HINT = re.compile(rf"{_SIGNED}|\s{_D}\s|\s{_A}\s[a-z0-9-]+\.[a-z0-9-]|(?<![^\W\d_]){_N}[ -](?:{_N}(?![^\W_])|[0-9])|[0-9][ -]{_N}(?![^\W_])|plus ?[0-9]")


def spans_of(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base spans, all spans) by kind."""
    base = base_spans(text)
    tape = normalise(text)
    if tape is None or not any(tape.made) and len(tape.text) == len(text):
        return base, base
    every = {}
    for kind, found in base_spans(tape.text).items():
        own, extra = base[kind], []
        for a, b in found:
            s, e = tape.start[a], tape.end[b - 1]
            if (any(tape.made[a:b]) or e - s != b - a) and not overlaps(own, s, e):
                extra.append((s, e))
        every[kind] = sorted(own + extra)
    return base, every


def overlaps(spans: list[Span], s: int, e: int) -> bool:
    from bisect import bisect_left

    i = bisect_left(spans, (e,))
    return i > 0 and spans[i - 1][1] > s


def written(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def find(docs: DataFrame) -> DataFrame:
    """Per row: the counts of base spans by kind, the digest of the base spans, all spans written out, and their number."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans, number = ([], [], [], []), [], [], []
        for text in batch.column("text").to_pylist():
            base, every = spans_of(text)
            for col, k in zip(counts, KINDS, strict=True):
                col.append(len(base[k]))
            digests.append(hashlib.sha256(written(base).encode()).hexdigest())
            spans.append(written(every))
            number.append(sum(map(len, every.values())))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(number, pa.int64())],
                                          ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"])

    return common.map_batches(common.text_columns(docs), run, SCHEMA)


def redacted(text: str) -> str:
    """The text with each found span as the name of its kind in brackets; where kinds overlap, the first to start and then the longer goes."""
    every = sorted((a, -b, k) for k, found in spans_of(text)[1].items() for a, b in found)
    out, at = [], 0
    for a, b, kind in every:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = -b
        elif -b > at:  # the rest of an overlapping one
            at = -b
    return "".join([*out, text[at:]]) if at else text


def redact(docs: DataFrame, column: str = "text") -> DataFrame:
    """The same rows and columns with the found spans of ``column`` replaced; null stays null."""
    scratch.ship(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: t if t is None else redacted(t))

    return docs.withColumn(column, clean(F.col(column)))
