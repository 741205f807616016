"""Markdown structure: sections of documents, their parents, paths, links and token reports.

Sections are cut inside each row with array expressions, so the cut itself
moves no data. What relates sections of a file (parent, path, neighbours,
subtree) is a set of windows that share one partitioning and order: one
exchange and one sort serve them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docquarry.functions.text import chunk_id, let, parse_front_matter, strip, token_count

HEADING = r"^#{1,6}\s+\S"
FENCE = r"^\s{0,3}(`{3,}|~{3,})"
LEVELS = range(1, 7)


def heading_of(line: Column, i: Column) -> Column:
    """The heading made of the start of line ``i``, of a level that its place gives."""
    return F.concat(F.repeat(F.lit("#"), (1 + (F.col("doc_id") + F.floor(i / 5)) % 4).cast("int")), F.lit(" "), F.substring(line, 1, 40))


def synthetic_markdown(docs: DataFrame) -> DataFrame:
    """Documents of plain prose as markdown files: before every fifth line stands a heading made of its start."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    headed = F.transform(lines, lambda line, i: F.when(i % 5 == 0, F.concat(heading_of(line, i), F.lit("\n"), line)).otherwise(line))
    return docs.select("doc_id", F.format_string("doc_%d.md", "doc_id").alias("filename"), F.array_join(headed, "\n").alias("text"))


def fenced_ranges(lines: Column) -> Column:
    """(first, last) line of each code fence; a fence closes at the same run of marks, or at the end."""
    marks = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), F.regexp_extract(x, FENCE, 1).alias("run"))), lambda m: m["run"] != "")
    none = F.array().cast("array<struct<a:int,b:int>>")
    start = F.struct(F.lit("").alias("open"), F.lit(0).alias("a"), none.alias("out"))

    def step(acc: Column, m: Column) -> Column:
        return (
            F.when(acc["open"] == "", F.struct(m["run"].alias("open"), m["i"].alias("a"), acc["out"].alias("out")))
            .when(acc["open"] == m["run"], F.struct(F.lit("").alias("open"), F.lit(0).alias("a"), F.concat(acc["out"], F.array(F.struct(acc["a"].alias("a"), m["i"].alias("b")))).alias("out")))
            .otherwise(acc)
        )

    close = lambda acc: F.when(acc["open"] != "", F.concat(acc["out"], F.array(F.struct(acc["a"].alias("a"), F.lit(2**31 - 1).alias("b"))))).otherwise(acc["out"])
    return F.aggregate(marks, start, step, close)


def section_array(text: Column, deepest: int = 6) -> Column:
    """(ord, line, level, heading, body) of each section; text before the first heading belongs to none.

    Headings deeper than ``deepest`` are no borders; their lines go, their bodies stay.
    """

    def cut(lines: Column) -> Column:
        def within(ranges: Column) -> Column:
            numbered = F.transform(lines, lambda x, i: F.when(x.rlike(HEADING), i))
            free = lambda i: ~F.exists(ranges, lambda r: (i >= r["a"]) & (i <= r["b"]))
            return F.filter(F.array_compact(numbered), free)

        def built(every: Column) -> Column:
            level_at = lambda i: F.length(F.regexp_extract(F.get(lines, i), "^(#+)", 1))
            heads = every if deepest >= 6 else F.filter(every, lambda i: level_at(i) <= deepest)

            def section(hs: Column) -> Column:
                def one(i: Column, k: Column) -> Column:
                    line, upto = F.get(lines, i), F.coalesce(F.get(hs, k + 1), F.size(lines))
                    rows = F.slice(lines, i + 2, F.greatest(upto - i - 1, F.lit(0)))
                    if deepest < 6:
                        rows = F.filter(rows, lambda x: ~(x.rlike(HEADING) & (F.length(F.regexp_extract(x, "^(#+)", 1)) > deepest)))
                    return F.struct(
                        k.alias("ord"), i.alias("line"), F.length(F.regexp_extract(line, "^(#+)", 1)).alias("level"),
                        F.trim(F.regexp_extract(line, r"^#+\s+(.*)$", 1)).alias("heading"), strip(F.array_join(rows, "\n")).alias("body"),
                    )

                return F.transform(hs, one)

            return let(heads, section)

        return let(let(fenced_ranges(lines), within), built)

    return let(F.split(text, "\n"), cut)


def sections(files: DataFrame, deepest: int = 6, keep: tuple[str, ...] = ("doc_id", "filename")) -> DataFrame:
    """A row for each section of each file."""
    held = [c for c in keep if c in files.columns]
    return files.select(*held, F.explode(section_array(F.col("text"), deepest)).alias("s")).select(*held, "s.ord", "s.line", "s.level", "s.heading", "s.body")


def in_file(by: str = "filename") -> W:
    return W.partitionBy(by).orderBy("ord")


def with_path(rows: DataFrame, by: str = "filename") -> DataFrame:
    """Adds parent_ord (the nearest section before of a lower level), path ("A > B > C") and parent_path.

    The stack of open headings is, for each level, the last heading of that level
    before this row; it is open if no heading of a lower level came after it.
    """
    before = in_file(by).rowsBetween(W.unboundedPreceding, -1)
    last = {k: F.last(F.when(F.col("level") == k, F.struct("ord", "heading")), ignorenulls=True).over(before) for k in LEVELS}
    out = rows.withColumns({f"_l{k}": c for k, c in last.items()})

    def open_at(k: int) -> Column:
        ok = (F.col("level") > k) & F.col(f"_l{k}").isNotNull()
        for j in range(1, k):
            ok = ok & (F.coalesce(F.col(f"_l{j}.ord"), F.lit(-1)) < F.col(f"_l{k}.ord"))
        return ok

    steps = [F.when(open_at(k), F.col(f"_l{k}.heading")) for k in LEVELS]
    parent = F.greatest(*(F.when(F.col("level") > k, F.col(f"_l{k}.ord")) for k in LEVELS))
    out = out.withColumns({"parent_ord": parent, "parent_path": F.concat_ws(" > ", *steps)})
    return out.withColumn("path", F.concat_ws(" > ", F.when(F.col("parent_path") != "", F.col("parent_path")), "heading")).drop(*(f"_l{k}" for k in LEVELS))


def chunks(files: DataFrame, limit: int | None = None) -> DataFrame:
    """The chunk table of heading sections: id, place, parent, neighbours, path, content, tokens and whether to embed. Front matter is no content."""
    rows = with_path(sections(files.withColumn("text", parse_front_matter(F.col("text"))["body"])))
    w = in_file()
    rows = rows.withColumns({"id": chunk_id(F.col("filename"), F.col("ord"), F.col("level")), "token_count": token_count(F.col("body"))})
    before = w.rowsBetween(W.unboundedPreceding, -1)
    last_id = {k: F.last(F.when(F.col("level") == k, F.struct("ord", "id")), ignorenulls=True).over(before) for k in LEVELS}
    parent = F.greatest(*(F.when(F.col("level") > k, last_id[k]) for k in LEVELS))
    root = F.last(F.when(F.col("level") == 1, F.col("id")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumns({"parent_id": parent["id"], "id_prev": F.lag("id").over(w), "id_next": F.lead("id").over(w), "root_id": root})
    return rows.select("doc_id", "filename", "ord", "id", "parent_id", "id_prev", "id_next", "root_id", "heading", F.col("level").alias("header_level"), F.col("path").alias("concat_header_path"),
                       F.lit("heading").alias("chunk_type"), F.col("body").alias("content"), "token_count", (F.col("token_count") > 0).alias("embed"))


def cumulative_tokens(rows: DataFrame, by: str = "filename") -> DataFrame:
    """Own tokens and those of all descendants; null for a section without any.

    A subtree ends at the next section whose level is not deeper; its sum is a
    difference of running sums.
    """
    w = in_file(by)
    after = w.rowsBetween(1, W.unboundedFollowing)
    running = F.sum("token_count").over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_before", F.coalesce(running, F.lit(0)))
    nxt = {k: F.first(F.when(F.col("level") == k, F.struct("ord", "_before")), ignorenulls=True).over(after) for k in LEVELS}
    end = F.least(*(F.when(F.col("level") >= k, nxt[k]) for k in LEVELS))
    whole = F.sum("token_count").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rows = rows.withColumns({"_end": end, "_whole": whole, "_child": F.coalesce(F.lead("level").over(w) > F.col("level"), F.lit(False))})
    total = F.coalesce(F.col("_end._before"), F.col("_whole")) - F.col("_before")
    return rows.withColumn("cumulative_tokens", F.when(F.col("_child"), total)).drop("_before", "_end", "_whole", "_child")


def level_report(rows: DataFrame) -> DataFrame:
    """Count, sum, mean, least and most tokens by level, with level 0 for all; both in one pass."""
    grouped = rows.rollup("level").agg(
        F.count("*").alias("n_sections"), F.sum("token_count").alias("total_tokens"), F.round(F.avg("token_count"), 6).alias("avg_tokens"), F.min("token_count").alias("min_tokens"), F.max("token_count").alias("max_tokens")
    )
    return grouped.withColumn("level", F.coalesce("level", F.lit(0)))


def duplicate_headings(rows: DataFrame, by: str = "filename") -> DataFrame:
    """Headings that occur more than once under one path at one level of a file, with their lines."""
    made = with_path(rows, by).groupBy(by, "parent_path", "heading", "level").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.col("line") + 1)).alias("lines"))
    return made.where("n > 1").withColumn("lines", F.array_join(F.col("lines").cast("array<string>"), ","))
