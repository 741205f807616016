"""Quality rules: base statistics in native expressions, and a decision list learned from labels.

Statistics of a whole text are array expressions over its words and lines. A
text's 8-word windows are compared by 64-bit hashes built by doubling (words,
pairs, fours, eights); only texts that hold an equal pair go on to the sorted
search for the covered words, so the usual text takes linear time.

The decision list is learned on the driver by sequential covering from a
bounded, documented sample of labelled rows of statistics: a rule grows by the
threshold of most gain, is pruned on rows held back, and is kept if it is
precise there; the rows it covers go, and the next rule is sought. The list is
emitted as one ordered conditional expression, so judging documents is one
projection without a shuffle or Python.

Cases: a null or empty text has no words and fails the base; a null doc_id is
passed on; repeated rows give a row each; an empty table gives an empty result;
without labels of both kinds the list is empty and the base decides alone;
labels with a null are not learned from; other columns are ignored, or carried
by ``keep_good`` whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SPACES = "\t\n\x0b\x0c\r "
GAP = "[\\x20\\x09-\\x0D]"
SAMPLE = 20_000  # labelled rows learned from, at most
MOST_RULES = 12
MOST_CONDITIONS = 3
CUTS = 48  # thresholds tried for a feature
PRECISE = 0.95  # of a rule, on the rows held back
SUPPORT = 4  # rows of the rejected class that a rule must cover while it grows


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP + "+"))


def window_hashes(words: Column, n: Column) -> Column:
    """Hashes of all windows of eight words, for texts of at least eight."""
    pair = lambda a, b: F.xxhash64(a, b)
    ones = F.transform(words, lambda w: F.xxhash64(w))
    return let(ones, lambda h1: let(F.zip_with(F.slice(h1, F.lit(1), n - 1), F.slice(h1, F.lit(2), n - 1), pair),
        lambda h2: let(F.zip_with(F.slice(h2, F.lit(1), n - 3), F.slice(h2, F.lit(3), n - 3), pair),
        lambda h4: F.zip_with(F.slice(h4, F.lit(1), n - 7), F.slice(h4, F.lit(5), n - 7), pair))))


def covered_words(hashes: Column) -> Column:
    """How many words lie in windows that occur twice or more: the union of their spans."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda e, other: F.coalesce(e["h"] == F.get(s, other)["h"], F.lit(False))
        return F.array_compact(F.transform(s, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"])))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"), (i + WINDOW).alias("end"))
    return let(placed, lambda s: F.aggregate(F.sort_array(repeated(s)), start, step, lambda acc: acc["n"]))


def repeat_words(words: Column, n: Column) -> Column:
    found = let(window_hashes(words, n), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered_words(h)))
    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(found)


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def statistics(text: Column) -> Column:
    """A struct of the statistics of a text that is not null."""
    of_words = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeat_words(w, F.size(w)).alias("n_repeat_words"),
    ))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        F.char_length(F.regexp_replace(text, GAP, "")).cast("long").alias("word_chars"),
        matches(text, "[#*$%&|<>]").alias("n_symbols"),
        matches(text, "\\p{Lu}").alias("n_upper"),
        matches(text, "[!?]").alias("n_bang"),
        matches(text, "[0-9]").alias("n_digits"),
    )


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bang", "n_digits")
_PLACE = {"n_words": "w", "n_repeat_words": "w", "n_lines": "l", "n_dup_lines": "l"}


def with_statistics(docs: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` and the statistics of the text. The struct is computed once, before its fields are read."""
    made = docs.select(*names, let(statistics(F.coalesce(F.col("text"), F.lit(""))), lambda s: F.struct(*((s[_PLACE[c]][c] if c in _PLACE else s[c]).alias(c) for c in STATS))).alias("__stats"))
    return made.select(*names, F.explode(F.array("__stats")).alias("__stats")).select(*names, *(F.col(f"__stats.{c}").alias(c) for c in STATS))


#: What rules may ask about: (name, numerator, denominator). Shares are kept in whole per mille, so that no rule hangs on rounding.
FEATURES = (
    ("words", "n_words", None),
    ("chars_per_word", "word_chars", "n_words"),
    ("symbols_per_word", "n_symbols", "n_words"),
    ("repeated_words", "n_repeat_words", "n_words"),
    ("repeated_lines", "n_dup_lines", "n_lines"),
    ("capitals", "n_upper", "word_chars"),
    ("shouts_per_word", "n_bang", "n_words"),
    ("digits", "n_digits", "word_chars"),
)


def features(row: Callable[[str], Column]) -> dict[str, Column]:
    return {name: row(a).cast("long") if b is None else F.floor(row(a) * 1000 / F.greatest(row(b), F.lit(1))).cast("long") for name, a, b in FEATURES}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: int

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.feature] >= self.cut if self.above else table[self.feature] < self.cut

    def column(self, columns: dict[str, Column]) -> Column:
        return columns[self.feature] >= self.cut if self.above else columns[self.feature] < self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.cut}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, table: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, dtype=bool)
    for c in rule:
        out &= c.holds(table)
    return out


def cuts_of(values: np.ndarray) -> list[int]:
    """Thresholds between neighbouring values, at most ``CUTS``, evenly over the ranks; in a gap, its middle."""
    seen = np.unique(values)
    if len(seen) < 2:
        return []
    picks = np.unique(np.linspace(0, len(seen) - 2, min(CUTS, len(seen) - 1)).astype(int))
    return sorted({int(math.ceil((int(seen[i]) + int(seen[i + 1])) / 2)) for i in picks})


def grow(table: dict[str, np.ndarray], bad: np.ndarray, active: np.ndarray) -> Rule:
    """Add the condition of most information gain until no good row is covered or nothing helps."""
    rule: Rule = ()
    now = active.copy()
    while len(rule) < MOST_CONDITIONS and (now & ~bad).any():
        p, n = int((now & bad).sum()), int((now & ~bad).sum())
        best: tuple[float, float, Condition | None, np.ndarray | None] = (1e-9, 0.0, None, None)
        for name, values in table.items():
            mid = {int(v) for v in cuts_of(values[now])}
            for cut in mid:
                for above in (True, False):
                    c = Condition(name, above, cut)
                    here = now & c.holds(table)
                    p1, n1 = int((here & bad).sum()), int((here & ~bad).sum())
                    if p1 < SUPPORT:
                        continue
                    gain = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p / (p + n)))
                    if (gain, -n1) > best[:2]:
                        best = (gain, -n1, c, here)
        if best[2] is None:
            break
        rule, now = (*rule, best[2]), best[3]
    return rule


def prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray, held: np.ndarray) -> Rule:
    """Drop conditions from the end while that does not lower (p - n) / (p + n) on the rows held back."""

    def worth(r: Rule) -> float:
        here = held & covers(r, table, len(bad))
        p, n = int((here & bad).sum()), int((here & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn(table: dict[str, np.ndarray], good: np.ndarray) -> list[Rule]:
    """An ordered list of rules for rejection; rows that none covers are kept."""
    size, bad = len(good), ~good
    if not bad.any() or not good.any():
        return []
    held, left, out = np.arange(size) % 3 == 2, np.ones(size, dtype=bool), []
    while len(out) < MOST_RULES and (left & bad & ~held).sum() >= SUPPORT:
        rule = grow(table, bad, left & ~held)
        if not rule:
            break
        rule = prune(rule, table, bad, left & held)
        here = left & covers(rule, table, size)
        tested = here & held
        p, n = int((tested & bad).sum()), int((tested & ~bad).sum())
        grown = here & ~held
        if (p + 1) / (p + n + 1) < PRECISE or (grown & bad).sum() < PRECISE * grown.sum():
            break
        out.append(rule)
        left &= ~here
    return out


def learn_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """The decision list from at most ``sample`` labelled rows, taken in hash order."""
    marked = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("__quality"))
    marked = marked.orderBy(F.xxhash64("__id"), "__id", "__quality").limit(sample)
    joined = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(F.broadcast(marked), "__id")  # at most ``sample`` rows of two numbers
    rows = with_statistics(joined, "__id", "__quality").where(~base_failed()).select("__id", "__quality", *(c.alias(k) for k, c in features(F.col).items()))
    # rows of repeated doc_ids are as many as they are, so the sample's bound is set once more, by a hash of the row
    rows = rows.orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(4 * sample).collect()
    rows.sort(key=lambda r: tuple(r))
    spread = np.random.default_rng(7).permutation(len(rows))
    rows = [rows[i] for i in spread]
    table = {name: np.array([r[name] for r in rows], dtype=np.int64) for name, *_ in FEATURES}
    return learn(table, np.array([r["__quality"] > 0 for r in rows], dtype=bool))


def verdict(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """The first rule that holds, written out, or null: one ordered conditional expression."""
    out: Column | None = None
    for rule in rules:
        cond = rule[0].column(columns)
        for c in rule[1:]:
            cond = cond & c.column(columns)
        said = F.lit(" and ".join(map(str, rule)))
        out = F.when(cond, said) if out is None else out.when(cond, said)
    return F.lit(None).cast("string") if out is None else out


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and the rule that rejects, for every row."""
    stats = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules, features(F.col)))
    return out.select("doc_id", *STATS[:5], "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns whatever those are called."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    packed = docs.select(row.alias("__row"), "text")
    judged = with_statistics(packed, "__row").where(~base_failed() & verdict(rules, features(F.col)).isNull())
    return judged.select("__row.*")
