"""Tables of contents against headings: levels by title, and aligning a document's headings with its contents."""

from __future__ import annotations

import difflib
import re
import unicodedata
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.functions.by_row import by_row
from docquarry.functions.text import title_key
from docquarry.operators.cleaning import fenced
from docquarry.operators.headings import section_array

NUMBERING = re.compile(r"^(?:(?:chapter|section|appendix)\s+)?(?:\d+(?:\.\d+)*[.):]?|[A-Za-z][.):]|[IVXLC]+[.):])\s+", re.I)


def key_of(title: str) -> str:
    """The key of a title: compatibility forms folded, numbering off, lower case, one space for what is no letter or digit."""
    bare = NUMBERING.sub("", unicodedata.normalize("NFKC", title).strip())
    return re.sub(r"[\W_]+", " ", bare.lower()).strip()


def similarity(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def alike(a: str, b: str, cutoff: float) -> bool:
    """Whether the similarity is at or over the cutoff; bounds from the lengths and the letters alone decide most cases."""
    m = difflib.SequenceMatcher(None, a, b, autojunk=False)
    return m.real_quick_ratio() >= cutoff and m.quick_ratio() >= cutoff and m.ratio() >= cutoff


def title_levels(toc: DataFrame) -> DataFrame:
    """(title_key, level): the least level of each title."""
    return toc.groupBy(title_key(F.col("title")).alias("title_key")).agg(F.min("level").alias("level"))


MOST_TITLES = 100_000  # of one document's contents, which the driver reads


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """The rows, which are an error if there are more: nothing is cut silently."""
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows")
    return rows


def best_level(titles: DataFrame, toc: DataFrame, cutoff: float = 0.9) -> DataFrame:
    """(title, level): by the exact key, else by the most similar title at or over the cutoff. The contents of one document are small and go to each task."""
    levels = {r["title_key"]: r["level"] for r in bounded(title_levels(toc), MOST_TITLES).collect()}
    scratch.ship(titles.sparkSession)

    @F.pandas_udf("int")
    def level(keys: pd.Series) -> pd.Series:
        def one(k: str) -> int | None:
            if k in levels:
                return levels[k]
            best = max(((similarity(k, t), t) for t in levels), default=(0.0, ""))
            return levels[best[1]] if best[0] >= cutoff else None

        return keys.map(one).astype("Int32")

    return titles.select("title", level(title_key(F.col("title"))).alias("level"))


def aligned(lines: list[str], toc: list[tuple[int, str]], cutoff: float = 0.92) -> list[str]:
    """Lines with headings as the contents say.

    A cursor stands at the next entry expected: a line whose key equals or nearly
    equals that entry's becomes a heading of its level, and the cursor moves on.
    An entry that never comes blocks those after it.
    """
    out, at, code = [], 0, fenced(lines)
    wanted = [key_of(title) for _, title in toc]
    for line, inside in zip(lines, code, strict=True):
        if at < len(toc) and not inside and line.strip():
            level, title = toc[at]
            want, key = wanted[at], key_of(line.lstrip("#").strip().strip("*"))
            if key and (key == want or len(key) <= 2 * len(want) + 8 and alike(key, want, cutoff)):
                out.append("#" * max(1, min(6, level)) + " " + title.strip())
                at += 1
                continue
        out.append(line)
    return out


ALIGNED_ROW = "struct<n_matched:int,text:string>"


def align(files: DataFrame, toc: DataFrame, cutoff: float = 0.92, key: str = "long") -> DataFrame:
    """Each file's text with headings by its contents (doc_id, pos, level, title), and how many entries were met.

    The contents become one array by file, so that a file and its contents meet
    in one join and no group is gathered in Python.
    """
    scratch.ship(files.sparkSession)
    entries = toc.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "level", "title"))).alias("toc"))

    def one(text: str | None, own: list | None) -> tuple[int, str]:
        lines = (text or "").split("\n")
        made = aligned(lines, [(int(e["level"]), e["title"]) for e in own or ()], cutoff)
        return sum(a != b for a, b in zip(lines, made, strict=True)), "\n".join(made)

    met = files.select("doc_id", "text").join(entries, "doc_id", "left")
    return met.select(F.col("doc_id").cast(key).alias("doc_id"), by_row(one, ALIGNED_ROW, "text", "toc").alias("m")).select("doc_id", "m.n_matched", "m.text")


def synthetic(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files whose headings have lost their signs, and the contents that know them."""
    heads = files.select("doc_id", F.explode(section_array(F.col("text"))).alias("s")).select("doc_id", F.col("s.ord").alias("pos"), F.col("s.level").alias("level"), F.col("s.heading").alias("title"))
    bare = files.withColumn("text", F.regexp_replace("text", r"(?m)^#{1,6}\s+(?=\S)", ""))
    return bare, heads


def inserted_levels(toc: DataFrame) -> DataFrame:
    """Entries before which a heading of level 1 must be put: those that open a document or follow level 1 at a level over 2."""
    from pyspark.sql import Window as W

    before = F.lag("level").over(W.partitionBy("doc_id").orderBy("pos"))
    return toc.withColumn("insert_h1", F.coalesce(before.isNull() & (F.col("level") > 1), F.lit(False)) | F.coalesce((before == 1) & (F.col("level") > 2), F.lit(False)))


def page_of(pages: Column) -> Column:
    return F.greatest(pages, F.lit(1))
