"""Row filters, samples and small reports. Each takes and gives a DataFrame and stays native, so predicates reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.functions import text as T


def in_domains(pages: DataFrame, domains: list[str] | None, url: str = "url") -> DataFrame:
    """Pages whose authority is one of ``domains``; None lets all pass."""
    return pages if domains is None else pages.where(T.authority(F.col(url)).isin(*domains))


def succeeded(results: DataFrame) -> DataFrame:
    """Crawl results that succeeded."""
    return results.where(F.col("success"))


def error_text(message: Column) -> Column:
    """An error as one field of a log line: bars become spaces."""
    return F.translate(message, "|", " ")


def long_enough(docs: DataFrame, chars: int = 100, lines: int = 2, column: str = "text") -> DataFrame:
    """Texts of at least so many characters and lines; an empty text has no line."""
    text = F.coalesce(F.col(column), F.lit(""))
    n_lines = F.when(text == "", 0).otherwise(F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    return docs.where((F.char_length(text) >= chars) & (n_lines >= lines))


def matching_globs(pages: DataFrame, globs: list[str], url: str = "url") -> DataFrame:
    """URLs that match one of the patterns with * and ?; no pattern lets all pass."""
    if not globs:
        return pages
    import re

    patterns = ["^" + re.escape(g).replace(r"\*", ".*").replace(r"\?", ".") + "$" for g in globs]
    return pages.where(F.col(url).rlike("|".join(patterns)))


def under_prefix(pages: DataFrame, seed: str, url: str = "url") -> DataFrame:
    return pages.where(F.startswith(F.col(url), F.lit(seed.rstrip("/") + "/")))


def listed_urls(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that are neither blank nor a comment, trimmed."""
    line = T.strip(F.col(column))
    return lines.select(line.alias("url")).where((F.col("url") != "") & ~F.startswith("url", F.lit("#")))


def fetchable(url: Column) -> Column:
    """Whether a crawl can start at a URL."""
    return url.rlike(r"^(?:https?://|file://|raw:)")


def kept_pages(pages: DataFrame, front: int, back: int, skip: DataFrame, number: str = "page") -> DataFrame:
    """Pages (from 0) that are not in the first ``front`` or last ``back`` nor in a range of ``skip`` (first, last; from 1, inclusive, either order).

    skip holds a handful of ranges that a user typed; the anti-join is a range join on it.
    """
    total = pages.agg((F.max(number) + 1).alias("_total"))  # one row
    ranges = skip.select(F.least("first", "last").alias("_a"), F.greatest("first", "last").alias("_b"))
    inner = pages.join(F.broadcast(total)).where((F.col(number) >= front) & (F.col(number) < F.greatest(F.lit(front), F.col("_total") - back))).drop("_total")
    return inner.join(ranges, (F.col(number) + 1 >= F.col("_a")) & (F.col(number) + 1 <= F.col("_b")), "left_anti")


def embeddable(chunks: DataFrame) -> DataFrame:
    """Chunks that are not marked as not to be embedded; a missing mark embeds."""
    return chunks.where(~F.coalesce(F.col("embed").cast("string") == "false", F.lit(False)))


def with_id(chunks: DataFrame, column: str = "id") -> DataFrame:
    return chunks.where(F.coalesce(F.col(column).cast("string"), F.lit("")) != "")


def to_summarise(chunks: DataFrame, least: int = 50) -> DataFrame:
    """What to do with a chunk's summary: keep one that exists, make one for chunks of enough tokens, leave others empty."""
    have = F.coalesce(F.col("chunk_summary"), F.lit("")) != ""
    return chunks.withColumn("action", F.when(have, "keep").when(F.col("token_count") >= least, "summarise").otherwise("empty"))


def head_sample(rows: DataFrame, n: int, order: str) -> DataFrame:
    return rows.orderBy(order).limit(n)


def hash_sample(rows: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same for a seed however the rows are laid out."""
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return rows.orderBy(place, key).limit(n)


def first_n_marked(rows: DataFrame, n: int, order: str = "ord") -> DataFrame:
    """All rows, with a mark on those that a test run may process."""
    return rows.withColumn("in_test", F.col(order) < n)


def excluded_codenames(names: DataFrame, excluded: list[str], column: str = "codename") -> DataFrame:
    """Codenames without short ones, listed ones, and beginnings of a listed one."""
    name = F.col(column)
    listed = F.array(*(F.lit(x) for x in excluded)) if excluded else F.array().cast("array<string>")
    begins = F.exists(listed, lambda x: F.startswith(x, name) & (x != name))
    return names.where((F.char_length(name) >= 5) & ~F.array_contains(listed, name) & ~begins)


def long_expansions(mapping: DataFrame, column: str = "friendlyname", least: int = 4) -> DataFrame:
    return mapping.where(F.char_length(F.trim(F.col(column))) >= least)


def scorable(chunks: DataFrame, column: str = "chunk_summary") -> DataFrame:
    """Chunks with a summary that is no error note."""
    s = F.coalesce(F.col(column), F.lit(""))
    return chunks.where((s != "") & ~(F.startswith(s, F.lit("[")) & F.contains(s, F.lit("ERROR"))))


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no finished result yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def crawl_counts(results: DataFrame, chars: int = 100) -> DataFrame:
    """Saved, failed and skipped pages and the share saved."""
    saved = F.col("success") & (F.char_length(F.coalesce("markdown", F.lit(""))) >= chars)
    return results.agg(
        F.count_if(saved).alias("saved"), F.count_if(~F.col("success")).alias("failed"), F.count_if(F.col("success") & ~saved).alias("skipped"),
        F.round(F.count_if(saved) / F.count("*"), 6).alias("save_rate"),
    )


def within_url_limit(pages: DataFrame, most: int, order: str) -> DataFrame:
    return pages.orderBy(order).limit(most)


def page_files(pages: DataFrame, url: str = "url", order: str = "page_id") -> DataFrame:
    """The file name of each distinct URL: the first with a stem has it alone, later ones bear the URL's hash.

    A URL that comes again has its own name again, so URLs are made distinct first.
    """
    clean = pages.withColumn("_url", T.without_fragment(F.col(url)))
    first = clean.groupBy("_url").agg(F.min(order).alias(order)).withColumn("stem", T.page_stem(F.col("_url")))
    # a stem like "index" is that of very many pages: only its first is looked for, map-side first, and both sides of the join are dealt for it alone
    alone = scratch.materialize(first.groupBy("stem").agg(F.min(F.struct(order, "_url")).alias("_first")), "stems")
    named = first.join(alone, "stem")
    is_first = (F.col("_first._url") == F.col("_url")) & (F.col(f"_first.{order}") == F.col(order))
    name = F.when(is_first, F.concat("stem", F.lit(".md"))).otherwise(F.concat("stem", F.lit("-"), T.short_hash(F.col("_url")), F.lit(".md")))
    return named.withColumn("filename", name).select(F.col("_url").alias("url"), order, "filename")


def ordered_distinct(*lists: DataFrame, column: str = "url") -> DataFrame:
    """The union of lists in order, each value at its first place: (value, pos)."""
    every = None
    for i, rows in enumerate(lists):
        part = rows.select(F.col(column), F.struct(F.lit(i).alias("list"), F.col("pos").cast("long").alias("pos")).alias("_at"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy(column).agg(F.min("_at").alias("_at")).select(column, F.col("_at.list").alias("list"), F.col("_at.pos").alias("pos"))
