"""Code names in prose: finding, counting and explaining them from dictionaries."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What names look like, and the classes of prefixed ones.
PATTERNS = (
    r"(?:Constants\.)?(?:FV|FP|FA|FO|FS|FF|FE|FTI|FT)_[A-Za-z0-9_]+",
    r"\bF_Api[A-Za-z]+\b",
    r"\bF_[A-Z][a-zA-Z]+T\b",
    r"FCodes\.[A-Za-z0-9_]+",
)
CAMEL = r"\b[A-Z][a-z0-9]+(?:[A-Z][a-z0-9]*){1,}\b"
CLASSES = {"FV_": "value", "FP_": "property", "FA_": "action", "FO_": "object", "FS_": "setting", "FF_": "flag", "FE_": "error", "FTI_": "text_item", "FT_": "type"}

PREFIXED = "|".join(PATTERNS)
_PREFIX = "|".join(p.rstrip("_") for p in CLASSES)
MOST_TERMS = 5_000


def canonical(name: Column) -> Column:
    """A name without its accessor."""
    return F.regexp_replace(name, r"^(?:Constants|FCodes)\.", "")


def prefixed_names(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PREFIXED), 0)


def camel_names(text: Column) -> Column:
    """CamelCase names outside the spans of prefixed ones, which are blanked first."""
    return F.regexp_extract_all(F.regexp_replace(text, PREFIXED, " "), F.lit(CAMEL), 0)


def name_type(name: Column) -> Column:
    """The class of a canonical name."""
    out = F.when(F.startswith(name, F.lit("KBD_")), "keyboard").otherwise("identifier")
    out = F.when(F.startswith(name, F.lit("F_Api")), "function").when(name.rlike("^F_[A-Z].*T$"), "struct").otherwise(out)
    for prefix, kind in CLASSES.items():
        out = F.when(F.startswith(name, F.lit(prefix)), kind).otherwise(out)
    return out


def split_camel(name: Column) -> Column:
    """The words of a name: runs of capitals before a capitalised word, words with their figures, other capitals."""
    return F.regexp_extract_all(name, F.lit(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]?[a-z0-9]+|[A-Z]+"), 0)


def friendly(name: Column, dictionary: dict[str, str]) -> Column:
    """A name in plain English: accessor and class prefix go, then each word is looked up, default itself in lower case.

    A segment between underscores that is all capitals is one word; a name of which
    nothing is left stands for itself.
    """
    bare = canonical(name)
    struct = F.when(bare.rlike("^F_[A-Z].*T$"), F.substr(bare, F.lit(3), F.length(bare) - 3))
    bare = F.when(F.startswith(bare, F.lit("F_Api")), F.substr(bare, F.lit(6))).otherwise(F.coalesce(struct, F.regexp_replace(bare, rf"^(?:{_PREFIX}|KBD)_", "")))
    segments = F.filter(F.split(bare, "_"), lambda s: s != "")
    words = F.flatten(F.transform(segments, lambda s: F.when((F.upper(s) == s) & s.rlike("[A-Z].") & (F.length(s) > 1), F.array(F.lower(s))).otherwise(F.transform(split_camel(s), lambda w: F.lower(w)))))
    if dictionary:
        table = F.create_map(*(F.lit(x) for pair in sorted((k.lower(), v) for k, v in dictionary.items()) for x in pair))
        words = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.when(bare == "", F.lower(name)).otherwise(F.array_join(words, " "))


def document_frequency(docs: DataFrame, names: Column, key: str) -> DataFrame:
    """(codename, type, count): in how many rows each canonical name occurs."""
    found = docs.select(F.col(key), F.explode(F.array_distinct(F.transform(names, canonical))).alias("codename"))
    return found.groupBy("codename").agg(F.count("*").alias("count")).withColumn("type", name_type(F.col("codename")))


def type_counts(frequency: DataFrame) -> DataFrame:
    """Names by type, and TOTAL, in one pass."""
    out = frequency.rollup("type").agg(F.count("*").alias("n"))
    return out.withColumn("type", F.coalesce("type", F.lit("TOTAL")))


def alternation(terms: list[str]) -> str:
    """One pattern for all terms, the longest first, so that a term wins over its beginnings."""
    if len(terms) > MOST_TERMS:
        raise ValueError(f"a dictionary of more than {MOST_TERMS} terms wants a trie")
    return "|".join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t)))


def enrich(docs: DataFrame, dictionary: dict[str, str], key: str, column: str = "text") -> DataFrame:
    """(key, names): the distinct plain names, sorted and joined by "; ", of the terms that a text holds; rows without any stay, with null.

    The dictionary is bounded, so it travels in the plan; texts are not shuffled.
    """
    if not dictionary:
        return docs.select(key, F.lit(None).cast("string").alias("names"))
    table = F.create_map(*(F.lit(x) for pair in sorted(dictionary.items()) for x in pair))
    hits = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(alternation([*dictionary])), 0))
    names = F.array_sort(F.array_distinct(F.transform(hits, lambda t: F.try_element_at(table, t))))
    return docs.select(key, F.when(F.size(hits) > 0, F.array_join(names, "; ")).alias("names"))


def enrich_pairs(docs: DataFrame, dictionary: dict[str, str], key: str, column: str = "text") -> DataFrame:
    """(key, pairs): "code: name" for each term found, in order of first occurrence."""
    table = F.create_map(*(F.lit(x) for pair in sorted(dictionary.items()) for x in pair))
    hits = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(alternation([*dictionary])), 0))
    return docs.select(key, F.array_join(F.transform(hits, lambda t: F.concat(t, F.lit(": "), F.try_element_at(table, t))), "; ").alias("pairs"))


def plain_english_lines(names: DataFrame) -> DataFrame:
    """Lines of the plain-English text file."""
    return names.select(F.format_string('"%s": "%s"', "codename", "friendlyname").alias("value"))
