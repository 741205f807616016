"""Licence scan by canonical digests.

A text is made canonical in native expressions: lower case; lines that only
claim copyright go; equivalent spellings become one; whatever is not a letter
or a digit becomes one space. The SHA-256 of the whole canonical text is
hash-joined to the known digests. Lines that name a licence are looked up the
same way among known one-line notices.

The known digests are constants of this package (their number is checked to be
under ``MOST_KNOWN``), so that side is broadcast; documents are not shuffled.

Cases: a null or empty text, and one without letters and digits, has the digest
of the empty text and no licence; a null doc_id is passed on; repeated rows give
a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm import license_texts

MOST_KNOWN = 5_000
#: Lines that claim copyright: the word with a sign, year, name in brackets or "by"; not a wrapped line of prose that starts with it.
COPYRIGHT_LINE = r"(^|\n)[^\p{L}\p{N}\n]*(copyright[ \t]*(\(c\)|©|[0-9<\[{:]|by\b)|(\(c\)|©)[ \t]*[0-9<\[{]|all rights reserved)[^\n]*"
OTHER = r"[^\p{L}\p{N}]+"
#: Spellings that licence matching guidelines hold equal, between spaces of the canonical text.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sub licence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("organisations", "organizations"), ("authorisation", "authorization"), ("authorised", "authorized"), ("initialise", "initialize"), ("recognise", "recognize"),
    ("favour", "favor"), ("honour", "honor"), ("behaviour", "behavior"), ("judgement", "judgment"), ("fulfil", "fulfill"), ("programme", "program"), ("whilst", "while"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("per cent", "percent"), ("http", "https"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
)


def canonical(text: Column) -> Column:
    """The canonical text: words with one space before and after each, or empty."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "$1")
    out = F.concat(F.lit(" "), F.regexp_replace(out, OTHER, " "), F.lit(" "))
    return spelled(F.regexp_replace(out, "^ +| +$", " "))


def spelled(text: Column) -> Column:
    """Each word gets spaces of its own meanwhile, so that neighbours don't share the one that both need."""
    text = F.replace(text, F.lit(" "), F.lit("  "))
    for a, b in SPELLINGS:
        text = F.replace(text, F.lit(f" {apart(a)} "), F.lit(f" {apart(b)} "))
    return F.replace(text, F.lit("  "), F.lit(" "))


def apart(words: str) -> str:
    return words.replace(" ", "  ")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def canonical_py(text: str) -> str:
    """The same for the constants of this package (and for tests)."""
    import regex

    out = regex.sub(COPYRIGHT_LINE, r"\1", text.lower())
    out = " " + regex.sub(OTHER, " ", out) + " "
    out = re.sub("^ +| +$", " ", out)
    # word by word, by another way than the columns above
    words = out.split(" ")
    for a, b in SPELLINGS:
        old, made, at = a.split(" "), [], 0
        while at < len(words):
            hit = words[at : at + len(old)] == old
            made += b.split(" ") if hit else [words[at]]
            at += len(old) if hit else 1
        words = made
    return " ".join(words)


def known_digests() -> dict[str, str]:
    out = dict(license_texts.DIGESTS)
    for name, text in license_texts.TEXTS:
        out.setdefault(hashlib.sha256(canonical_py(text).encode()).hexdigest(), name)
    return out


def known_notices() -> dict[str, str]:
    return {hashlib.sha256(canonical_py(text).encode()).hexdigest(): name for name, text in license_texts.NOTICES}


def known_table(spark: SparkSession) -> DataFrame:
    known = known_digests()
    if len(known) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known digests; join them without a broadcast")
    rows = ", ".join(f"('{k}', '{v}')" for k, v in sorted(known.items()))
    return spark.sql(f"SELECT col1 AS __digest, col2 AS __license FROM VALUES {rows}")


#: What a line must hold to be looked up among the notices, each of which does.
NAMES_LICENSE = "(?i)licen[sc]|spdx"


def notices_of(text: Column) -> Column:
    """The sorted distinct ids of the known notices among the lines, and how many lines are one."""
    lookup = F.create_map(*(F.lit(x) for pair in sorted(known_notices().items()) for x in pair))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NAMES_LICENSE))
    return F.array_compact(F.transform(lines, lambda line: F.try_element_at(lookup, digest(line))))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, canonical_sha256, license_id (null if the whole text is none), n_notices and notice_ids for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.when(text.rlike(NAMES_LICENSE), notices_of(text)).otherwise(F.array().cast("array<string>"))
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(text).alias("canonical_sha256"), found.alias("__notices"))
    joined = made.join(F.broadcast(known_table(docs.sparkSession)), F.col("canonical_sha256") == F.col("__digest"), "left")  # at most MOST_KNOWN rows
    return joined.select("doc_id", "canonical_sha256", F.col("__license").alias("license_id"), F.size("__notices").cast("long").alias("n_notices"), F.array_join(F.sort_array(F.array_distinct("__notices")), ",").alias("notice_ids"))


def oracle() -> str:
    """The same in DuckDB SQL."""

    def canon(x: str) -> str:
        out = f"regexp_replace(lower({x}), '{COPYRIGHT_LINE}', '\\1', 'g')"
        out = f"' ' || regexp_replace({out}, '{OTHER}', ' ', 'g') || ' '"
        out = f"regexp_replace(regexp_replace({out}, '^ +', ' '), ' +$', ' ')"
        out = f"replace({out}, ' ', '  ')"
        for a, b in SPELLINGS:
            out = f"replace({out}, ' {apart(a)} ', ' {apart(b)} ')"
        return f"sha256(replace({out}, '  ', ' '))"

    table = lambda known: ", ".join(f"('{k}', '{v}')" for k, v in sorted(known.items()))
    return f"""
WITH known(d, license) AS (VALUES {table(known_digests())}),
notices(d, license) AS (VALUES {table(known_notices())}),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
found AS (
  SELECT r, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS notice_ids
  FROM (SELECT r, {canon("line")} AS d FROM lines WHERE regexp_matches(line, '{NAMES_LICENSE}')) JOIN notices USING (d) GROUP BY r),
whole AS (SELECT r, doc_id, {canon("text")} AS d FROM docs)
SELECT doc_id, d AS canonical_sha256, license AS license_id, coalesce(n_notices, 0)::BIGINT AS n_notices, coalesce(notice_ids, '') AS notice_ids
FROM whole LEFT JOIN known USING (d) LEFT JOIN found USING (r)"""
