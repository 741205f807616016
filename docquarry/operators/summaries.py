"""Inputs and results of summaries: prefixes, page roll-ups, evaluation figures, and the pluggable models."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docquarry import scratch
from docquarry.functions.by_row import by_row


class Summarizer(Protocol):
    def __call__(self, prompt: str) -> str: ...


class Encoder(Protocol):
    def __call__(self, texts: list[str]) -> list[list[float]]: ...


def first_words(prompt: str, n: int = 12) -> str:
    """A deterministic stand-in for a model: the first words of the text after the prompt's last blank line."""
    return " ".join(prompt.rsplit("\n\n", 1)[-1].split()[:n])


def hashed_ngrams(texts: list[str], dim: int = 64) -> list[list[float]]:
    """A deterministic stand-in for a sentence encoder: hashed character trigrams at length 1."""
    import math
    import zlib

    out = []
    for t in texts:
        v = [0.0] * dim
        for i in range(max(1, len(t) - 2)):
            h = zlib.crc32(t[i : i + 3].encode())
            v[h % dim] += 1.0 if h >> 16 & 1 else -1.0
        n = math.sqrt(sum(x * x for x in v)) or 1.0
        out.append([x / n for x in v])
    return out


BACKENDS: dict[str, Summarizer] = {"stub": first_words}


def run_backend(backend: str, prompt: str, attempts: int = 4, wait: Callable[[float], None] = time.sleep) -> str:
    """The backend's answer, tried again after 2, 4 and 8 seconds; empty if it keeps failing."""
    model = BACKENDS[backend]
    for k in range(attempts):
        if k:
            wait(2.0**k)
        try:
            return model(prompt)
        except Exception:  # noqa: BLE001  a failed summary must not fail the run
            continue
    return ""


def prompt_of(path: Column, content: Column, template: str = "Summarise this section in two sentences.") -> Column:
    return F.concat(F.lit(template + "\n\nHeading: "), F.coalesce(path, F.lit("")), F.lit("\n\n"), F.coalesce(content, F.lit("")))


def summarise(chunks: DataFrame, backend: str = "stub", least: int = 50) -> DataFrame:
    """chunk_summary for chunks of enough tokens that have none; the model is called on those rows alone."""
    have = F.coalesce(F.col("chunk_summary"), F.lit("")) != ""

    ask = lambda prompt: by_row(lambda p: None if p is None else run_backend(backend, p), "string", prompt)
    due = ~have & (F.col("token_count") >= least)
    made = chunks.withColumn("_made", ask(F.when(due, prompt_of(F.col("concat_header_path"), F.col("content")))))
    return made.withColumn("chunk_summary", F.when(have, F.col("chunk_summary")).when(due, F.col("_made")).otherwise("")).drop("_made")


def encode(texts: DataFrame, encoder: Encoder = hashed_ngrams, batch: int = 64) -> DataFrame:
    """(text, vector) for a DataFrame (text); the encoder loads once in each worker and sees ``batch`` texts at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = f["text"].tolist()
            made = [v for at in range(0, len(rows), batch) for v in encoder(rows[at : at + batch])]
            yield pd.DataFrame({"text": rows, "vector": made})

    return texts.select("text").mapInPandas(run, "text string, vector array<float>")


def embedding_text(path: Column, content: Column, friendly: Column) -> Column:
    """What is embedded of a chunk: its path, its content and the plain names of its codes."""
    return F.concat(F.coalesce(path, F.lit("")), F.lit(": "), F.coalesce(content, F.lit("")), F.when(F.coalesce(friendly, F.lit("")) != "", F.concat(F.lit("\n"), friendly)).otherwise(""))


def small_chunk_prefix(chunks: DataFrame, below: int = 150, path: bool = True, page: bool = True, chunk: bool = False) -> DataFrame:
    """Content of small chunks with its path and summaries before it; a prefix that is there is not put twice."""
    parts = [c for use, c in ((path, "concat_header_path"), (page, "page_summary"), (chunk, "chunk_summary")) if use]
    prefix = F.concat_ws("\n", *(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)) for c in parts))
    small = (F.col("token_count") < below) & (prefix != "") & ~F.startswith(F.col("content"), prefix)
    return chunks.withColumn("content", F.when(small, F.concat(prefix, F.lit("\n\n"), F.col("content"))).otherwise(F.col("content")))


def prepend_summary(content: Column, summary: Column) -> Column:
    return F.when((F.coalesce(summary, F.lit("")) == "") | F.startswith(content, summary), content).otherwise(F.concat(summary, F.lit("\n\n"), content))


def page_rollup(chunks: DataFrame) -> DataFrame:
    """(filename, page_key, first_ord, n_members, page_text): a text for each H1 section of a file, and for what stands before the first.

    The text is the top content, then the top's summary and the children's as
    bullets in document order; empty ones are left out.
    """
    key = F.coalesce("root_id", "filename")
    s = F.coalesce(F.col("chunk_summary"), F.lit(""))
    top = F.col("id") == F.col("root_id")
    grouped = chunks.groupBy("filename", key.alias("page_key")).agg(
        F.min("ord").alias("first_ord"), F.count("*").alias("n_members"), F.max(F.when(top, F.col("content"))).alias("_top"), F.sort_array(F.collect_list(F.when(s != "", F.struct("ord", s.alias("s"))))).alias("_s")
    )
    bullets = F.array_join(F.transform("_s", lambda x: F.concat(F.lit("- "), x["s"])), "\n")
    return grouped.select("filename", "page_key", "first_ord", "n_members", F.concat_ws("\n", F.when(F.coalesce("_top", F.lit("")) != "", F.col("_top")), F.when(bullets != "", bullets)).alias("page_text"))


def asked(rows: DataFrame, prompt: Column, backend: str, into: str) -> DataFrame:
    """``rows`` with the backend's answer to each prompt that is not null."""

    ask = lambda prompt: by_row(lambda p: None if p is None else run_backend(backend, p), "string", prompt)
    return rows.withColumn(into, ask(prompt))


def page_summaries(chunks: DataFrame, backend: str = "stub") -> DataFrame:
    """``chunks`` with page_summary: each page is summed up once from its roll-up, and its members get the answer."""
    pages = page_rollup(chunks)
    prompt = F.when(F.coalesce("page_text", F.lit("")) != "", prompt_of(F.col("page_key"), F.col("page_text"), "Summarise this page in two sentences."))
    made = asked(pages, prompt, backend, "page_summary").select(F.col("filename").alias("_file"), F.col("page_key").alias("_page"), F.coalesce("page_summary", F.lit("")).alias("page_summary"))
    on = (F.col("filename") == F.col("_file")) & (F.coalesce("root_id", "filename") == F.col("_page"))
    return chunks.drop("page_summary").join(made, on, "left").drop("_file", "_page")


def code_summaries(chunks: DataFrame, backend: str = "stub") -> DataFrame:
    """chunk_summary of code examples that have none, by a prompt of their own; other chunks keep theirs."""
    due = (F.col("chunk_type") == "example") & (F.coalesce(F.col("chunk_summary"), F.lit("")) == "") & (F.coalesce(F.col("content"), F.lit("")) != "")
    made = asked(chunks, F.when(due, prompt_of(F.col("concat_header_path"), F.col("content"), "Say what this code does in one sentence.")), backend, "_made")
    return made.withColumn("chunk_summary", F.when(due, F.col("_made")).otherwise(F.col("chunk_summary"))).drop("_made")


# --- evaluation


class Scorer(Protocol):
    """Scores of (source, summary) pairs, from 0 to 1."""

    def __call__(self, pairs: list[tuple[str, str]]) -> list[float]: ...


def word_overlap(pairs: list[tuple[str, str]]) -> list[float]:
    """A deterministic stand-in for a model: the share of a summary's different words that its source has."""
    out = []
    for source, summary in pairs:
        words = set(summary.lower().split())
        out.append(len(words & set(source.lower().split())) / len(words) if words else 0.0)
    return out


def scored(chunks: DataFrame, scorer: Scorer = word_overlap, summary: str = "chunk_summary", into: str = "score") -> DataFrame:
    """The chunks that can be scored with their score; the scorer sees an Arrow batch of pairs at a time."""
    from docquarry.operators.filters import scorable

    @F.pandas_udf("double")
    def run(sources: pd.Series, summaries: pd.Series) -> pd.Series:
        return pd.Series(scorer(list(zip(sources, summaries, strict=True))), dtype="float64")

    return scorable(chunks, summary).withColumn(into, run(F.coalesce("content", F.lit("")), F.col(summary)))


def trimmed_mean(rows: DataFrame, value: str, by: str, share: float = 0.10, percentile: float = 0.2) -> DataFrame:
    """(by, mean, percentile, trimmed): the mean without int(n * share) values at each end; the median from a half on; untrimmed if too few.

    Equal values are counted before anything moves. The distinct ones are dealt by
    range and numbered within their range on top of the ranges' totals, so no
    group of any size is sorted by one task.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    dealt = scratch.materialize(counted.repartitionByRange(by, "_v").withColumn("_part", F.spark_partition_id()), "ranges")
    parts = dealt.groupBy(by, "_part").agg(F.sum("_n").alias("_own"))
    before = W.partitionBy(by).orderBy("_part")
    parts = parts.withColumns({"_base": F.sum("_own").over(before) - F.col("_own"), "_all": F.sum("_own").over(W.partitionBy(by))}).drop("_own")
    placed = dealt.join(F.broadcast(parts), [by, "_part"])  # a row for each group and partition
    start = F.col("_base") + F.sum("_n").over(W.partitionBy(by, "_part").orderBy("_v")) - F.col("_n")
    placed = placed.withColumn("_start", start).withColumn("_end", F.col("_start") + F.col("_n"))
    cut = F.floor(F.col("_all") * share)
    cut = F.when(2 * cut >= F.col("_all"), 0).otherwise(cut)
    inside = F.greatest(F.least("_end", F.col("_all") - cut) - F.greatest("_start", cut), F.lit(0))

    def quantile(p: float) -> Column:
        at = (F.col("_all") - 1) * F.lit(p)
        value_at = lambda i: F.max(F.when((F.col("_start") <= i) & (i < F.col("_end")), F.col("_v")))
        low, high = value_at(F.floor(at)), value_at(F.ceil(at))
        return low + (high - low) * F.max(at - F.floor(at))

    middle = quantile(0.5) if share >= 0.5 else F.sum(inside * F.col("_v")) / F.sum(inside)
    return placed.groupBy(by).agg((F.sum(F.col("_v") * F.col("_n")) / F.max("_all")).alias("mean"), quantile(percentile).alias("percentile"), middle.alias("trimmed"))


def score_range(rows: DataFrame, *values: str) -> DataFrame:
    """Mean, least and most of each score, nulls left out."""
    return rows.agg(*(f(v).alias(f"{n}_{v}") for v in values for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))))


def axis_reduced(matrix: Column, how: str = "max") -> Column:
    """An array of rows reduced to one number each: mean, min or max."""
    one = {"max": F.array_max, "min": F.array_min, "mean": lambda r: F.aggregate(r, F.lit(0.0), lambda a, x: a + x) / F.size(r)}[how]
    return F.transform(matrix, one)


def consistency(entail: Column, contradict: Column, how: str = "max") -> Column:
    """For each sentence, how much its best evidence entails it less how much it contradicts it."""
    return F.zip_with(axis_reduced(entail, how), axis_reduced(contradict, how), lambda e, c: e - c)
