"""Tables and code in chunks: finding, peeling, splitting and rewriting them.

What depends on one text alone runs inside its row. Only chunks over the token
budget go to Python; the rest of a file's chunks never leave the JVM.
"""

from __future__ import annotations

import csv
import html as html_entities
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.functions.by_row import by_row
from docquarry.functions.text import chunk_id
from docquarry.operators import headings
from docquarry.operators.cleaning import Lines, blocks, cells, guess_language, is_separator

CODE = re.compile(r"^```([\w\-+.]*)[ \t]*\n(.*?)\n```[ \t]*$", re.S | re.M)
MARKER = "<!-- Data Table -->"


def tokens(text: str) -> int:
    return len(text.split())


# --- native


def greedy_packs(sizes: Column, limit: int) -> Column:
    """Rows of the given sizes packed in order under a limit: (pack, tokens, rows_in, overflow). A row over the limit is a pack of its own, marked."""
    kind = "array<struct<pack:int,tokens:int,rows_in:int,overflow:boolean>>"
    start = F.array().cast(kind)
    one = lambda n, k: F.array(F.struct(n.cast("int").alias("pack"), k.cast("int").alias("tokens"), F.lit(1).alias("rows_in"), (k > limit).alias("overflow")))

    def step(acc: Column, k: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.array(F.struct(last["pack"].alias("pack"), (last["tokens"] + k).cast("int").alias("tokens"), (last["rows_in"] + 1).alias("rows_in"), last["overflow"].alias("overflow")))
        return (
            F.when(F.size(acc) == 0, one(F.lit(0), k))
            .when(last["tokens"] + k > limit, F.concat(acc, one(last["pack"] + 1, k)))
            .otherwise(F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), grown))
            .cast(kind)
        )

    return F.aggregate(sizes, start, step)


def balanced_cut(sizes: Column, limit: int, below: int) -> Column:
    """How many rows go to the first half so that both are under the limit and differ least (the earlier on ties); null where no cut does, or the total is not between."""
    total = F.aggregate(sizes, F.lit(0), lambda a, k: (a + k).cast("int"))
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("cut"), F.lit(None).cast("int").alias("gap"))

    def fold(all_tokens: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            left, i = (acc["sum"] + k).cast("int"), acc["i"] + 1
            gap = F.abs(2 * left - all_tokens).cast("int")
            better = (left <= limit) & (all_tokens - left <= limit) & (i < F.size(sizes)) & (acc["gap"].isNull() | (gap < acc["gap"]))
            return F.struct(left.alias("sum"), i.alias("i"), F.when(better, i).otherwise(acc["cut"]).alias("cut"), F.when(better, gap).otherwise(acc["gap"]).alias("gap"))

        return F.when((all_tokens > limit) & (all_tokens < below), F.aggregate(sizes, start, step, lambda acc: acc["cut"]))

    return F.element_at(F.transform(F.array(total), fold), 1)


def caption(heading: Column, first: Column, last: Column, n: Column) -> Column:
    """The line over a table: its heading, the first and last keys, and how many rows."""
    empty = F.coalesce(n, F.lit(0)) == 0
    return F.when(empty, F.format_string("Table: %s (from n/a to n/a: 0)", heading)).otherwise(F.format_string("Table: %s (from %s to %s: %s rows)", heading, first, last, n.cast("string")))


def html_tables(html: Column) -> Column:
    """An array of CSV texts, one for each table of a page; entities stay as they are, short rows are padded."""
    tables = F.regexp_extract_all(html, F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), 1)
    row_cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>"), 1), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", ""), r"\s+", " ")))
    quoted = lambda c: F.when(c.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)

    def rows_of(t: Column) -> Column:
        rows = F.transform(F.regexp_extract_all(t, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1), row_cells)
        return F.element_at(F.transform(F.array(rows), lambda rs: F.element_at(F.transform(F.array(F.array_max(F.transform(rs, lambda r: F.size(r)))), lambda w: F.array_join(
            F.transform(rs, lambda r: F.array_join(F.transform(F.concat(r, F.array_repeat(F.lit(""), F.greatest(w - F.size(r), F.lit(0)))), quoted), ",")), "\n")), 1)), 1)

    return F.transform(tables, rows_of)


# --- machines


def find_code(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, tag, code) of fenced blocks."""
    return [(m.start(), m.end(), m[1], m[2]) for m in CODE.finditer(text)]


PY_START = re.compile(r"(?:async )?def \w|class \w")
PY_DEF = re.compile(r"def\s+\w")
JS_FUNCTION = re.compile(r"(?:export\s+)?(?:async\s+)?function\s+\w")
SCRIPTS = ("javascript", "typescript", "jsx", "tsx", "extendscript")
JS_START = re.compile(r"(?:export\s+)?(?:default\s+)?(?:async\s+)?function\b\s*\w*\s*\(|(?:export\s+)?(?:const|let|var)\s+\w+\s*=\s*(?:async\s*)?(?:function\s*\(|\([^)]*\)\s*=>\s*\{)")


def split_code(code: str, language: str) -> list[str]:
    """Top-level functions with the comments right above them, and what stands before the first; other code whole.

    Untagged code, or code tagged as something else, counts as the language whose top-level functions it has.
    """
    lines = code.split("\n")
    shows = lambda start: any(start.match(x) for x in lines)
    if language == "python" or language not in SCRIPTS and shows(PY_DEF):
        starts_at, comment = (lambda x: PY_START.match(x)), ("#", "@")
    elif language in SCRIPTS or shows(JS_FUNCTION):
        starts_at, comment = (lambda x: JS_START.match(x)), ("//", "/*", "*")
    else:
        return [code]
    starts = []
    for i, line in enumerate(lines):
        if starts_at(line):
            while i and lines[i - 1].strip() and lines[i - 1].lstrip().startswith(comment):
                i -= 1
            starts.append(i)
    if not starts:
        return [code]
    borders = sorted({0, *starts, len(lines)})
    parts = ["\n".join(lines[a:b]).strip("\n") for a, b in zip(borders, borders[1:])]
    return [p for p in parts if p.strip()]


def csv_columns(line: str) -> int:
    try:
        return len(next(csv.reader([line])))
    except (csv.Error, StopIteration):
        return line.count(",") + 1


def find_tables(text: str, strict: bool = True) -> list[tuple[int, int]]:
    """(first, last + 1) lines of table regions outside fences: pipe rows with a separator line, or rows of commas.

    strict: a comma region needs three lines of one column count of at least
    three; otherwise two lines with commas do, as long as each has the header's
    columns.
    """
    lines = text.split("\n")
    out, at = [], 0
    for code, run in blocks(lines):
        if not code:
            kind = ["pipe" if re.match(r"^\s*\|.*\|\s*$", x) else "csv" if "," in x and x.strip() else "" for x in run]
            i = 0
            while i < len(run):
                j = i + 1
                if kind[i] == "pipe":
                    while j < len(run) and kind[j] == "pipe":
                        j += 1
                    if j - i >= 2 and any(map(is_separator, run[i:j])):
                        out.append((at + i, at + j))
                elif kind[i] == "csv":
                    width = csv_columns(run[i])
                    fits = (lambda x, w=width: csv_columns(x) == w) if strict else (lambda x, w=width: x.count(",") >= w - 1)
                    while j < len(run) and kind[j] == "csv" and fits(run[j]):
                        j += 1
                    if (width >= 3 and j - i >= 3) if strict else (width >= 2 and j - i >= 2):
                        out.append((at + i, at + j))
                i = j
        at += len(run)
    return out


def table_region(lines: Lines, first: int) -> int:
    """The first line of a table with the marker and title lines right above it."""
    while first and (lines[first - 1].strip() == MARKER or lines[first - 1].startswith("Table:") or (not lines[first - 1].strip() and first > 1 and (lines[first - 2].strip() == MARKER or lines[first - 2].startswith("Table:")))):
        first -= 1
    return first


def table_rows(lines: Lines) -> list[Lines]:
    if any(x.lstrip().startswith("|") for x in lines):
        return [cells(x) for x in lines if x.strip() and not is_separator(x)]
    return [r for r in csv.reader([x for x in lines if x.strip()])]


def decorated(heading: str, body: str) -> str:
    """A table with its caption in place of its marker."""
    kept = [x for x in body.split("\n") if x.strip() != MARKER and not x.startswith("Table:")]
    rows = table_rows(kept)[1:]
    head = f"Table: {heading} (from {rows[0][0]} to {rows[-1][0]}: {len(rows)} rows)" if rows and rows[0] and rows[-1] else f"Table: {heading} (from n/a to n/a: 0)"
    return head + "\n\n" + "\n".join(kept).strip()


def peeled(text: str, heading: str, limit: int) -> tuple[str, list[tuple[str, str, str]]]:
    """(what stays, [(kind, language, content)]): while a text is over the limit, its largest code block goes, else its last table."""
    parts: list[tuple[str, str, str]] = []
    text = text.strip()
    while tokens(text) > limit:
        code = find_code(text)
        if code:
            start, end, tag, body = max(code, key=lambda c: (tokens(text[c[0] : c[1]]), -c[0]))
            language = guess_language(body, tag)
            parts += [("example", language, f"```{tag}\n{p.strip()}\n```") for p in split_code(body.rstrip(), language)]
            text = (text[:start] + text[end:]).strip()
            continue
        found = find_tables(text)
        if not found:
            break
        lines = text.split("\n")
        first, last = found[-1]
        first = table_region(lines, first)
        parts.append(("table", "", decorated(heading, "\n".join(lines[first:last]))))
        text = "\n".join(lines[:first] + lines[last:]).strip()
    return text, parts


PEELED = "array<struct<sub:int,kind:string,language:string,content:string>>"


def peel(files: DataFrame, limit: int = 500) -> DataFrame:
    """The chunk table with components peeled from chunks over the limit.

    A component is a child of its heading, takes its level and path, follows it
    in order, and is named in its ``examples``. Neighbour links run over both.
    """
    from docquarry.functions.text import token_count

    scratch.ship(files.sparkSession)

    @F.pandas_udf(f"content string, parts {PEELED}")
    def cut(texts: pd.Series, titles: pd.Series) -> pd.DataFrame:
        made = [peeled(t or "", h or "", limit) if t is not None else (None, []) for t, h in zip(texts, titles, strict=True)]
        return pd.DataFrame({"content": [m[0] for m in made], "parts": [[{"sub": i + 1, "kind": k, "language": g, "content": c} for i, (k, g, c) in enumerate(m[1])] for m in made]})

    rows = headings.chunks(files)
    over = F.col("token_count") > limit
    # one pass: only texts over the limit are sent, the others go as null
    rows = rows.withColumn("_cut", cut(F.when(over, F.col("content")), F.col("heading")))
    own = F.array(F.struct(F.lit(0).alias("sub"), F.lit("heading").alias("kind"), F.lit("").alias("language"), F.when(over, F.col("_cut.content")).otherwise(F.col("content")).alias("content")))
    rows = rows.withColumn("_part", F.explode(F.concat(own, F.coalesce(F.col("_cut.parts"), F.array().cast(PEELED)))))
    sub = F.col("_part.sub")
    part_id = chunk_id(F.col("filename"), F.col("ord"), F.col("header_level"), sub, F.col("_part.kind"))
    names = F.transform(F.coalesce(F.col("_cut.parts"), F.array().cast(PEELED)), lambda p: chunk_id(F.col("filename"), F.col("ord"), F.col("header_level"), p["sub"], p["kind"]))
    out = rows.select(
        "doc_id", "filename", "ord", sub.alias("sub"), part_id.alias("id"), F.when(sub == 0, F.col("parent_id")).otherwise(F.col("id")).alias("parent_id"), "root_id", "heading", "header_level", "concat_header_path",
        F.col("_part.kind").alias("chunk_type"), F.col("_part.content").alias("content"), F.when(F.col("_part.language") != "", F.col("_part.language")).alias("language"),
        F.when(sub == 0, names).otherwise(F.array().cast("array<string>")).alias("examples"),
    )
    from pyspark.sql import Window as W

    w = W.partitionBy("filename").orderBy("ord", "sub")
    out = out.withColumn("token_count", token_count(F.col("content")))
    return out.withColumns({"embed": F.col("token_count") > 0, "id_prev": F.lag("id").over(w), "id_next": F.lead("id").over(w)})


def with_components(files: DataFrame) -> DataFrame:
    """Files with a code block and a table after every heading, for trying out ``peel``."""
    code = "\\n```python\\n# adds\\ndef add(a, b):\\n    return a + b\\n\\ndef twice(a):\\n    return add(a, a)\\n```\\n| key | value |\\n| --- | --- |\\n| one | 1 |\\n| two | 2 |\\n".replace("\\n", "\n")
    return files.withColumn("text", F.regexp_replace(F.col("text"), r"(?m)^(#{1,6} \S[^\n]*)$", "$1" + code.replace("$", "\\$")))


# --- splitting CSV tables


def split_table(lines: Lines, limit: int = 490, below: int = 900) -> list[tuple[Lines, int, bool]]:
    """(lines, tokens, overflow) of the parts of a table: whole if small, two balanced halves if between, else packed greedily; the header is repeated."""
    head, rows = lines[:1], lines[1:]
    sizes = [tokens(x) for x in rows]
    base = tokens(head[0]) if head else 0
    total = base + sum(sizes)
    if total <= limit or len(rows) < 2:
        return [(lines, total, total > limit)]
    if total < below:
        best: tuple[int, int] | None = None
        left = base
        for i, k in enumerate(sizes[:-1], 1):
            left += k
            right = total - left + base
            if max(left, right) <= limit and (best is None or abs(left - right) < best[0]):
                best = (abs(left - right), i)
        if best:
            i = best[1]
            return [(head + rows[:i], base + sum(sizes[:i]), False), (head + rows[i:], base + sum(sizes[i:]), False)]
    out: list[tuple[Lines, int, bool]] = []
    part: Lines = []
    fill = base
    for row, k in zip(rows, sizes, strict=True):
        if part and fill + k > limit:
            out.append((head + part, fill, fill > limit))
            part, fill = [], base
        part.append(row)
        fill += k
    return [*out, (head + part, fill, fill > limit)]


SPLIT = "doc_id long, table_index int, part int, tokens int, rows_in int, overflow boolean, content string"


def split_files(files: DataFrame, limit: int = 490, below: int = 900) -> DataFrame:
    """The parts of every marked CSV table of every file, in order."""
    scratch.ship(files.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for doc, text in zip(f["doc_id"], f["text"], strict=True):
                lines, index, at = (text or "").split("\n"), 0, 0
                while at < len(lines):
                    if lines[at].strip() != MARKER:
                        at += 1
                        continue
                    stop = at + 1
                    while stop < len(lines) and lines[stop].strip() and lines[stop].strip() != MARKER:
                        stop += 1
                    for k, (part, n, over) in enumerate(split_table(lines[at + 1 : stop], limit, below)):
                        out.append((doc, index, k, n, len(part) - 1, over, "\n".join([MARKER, *part])))
                    index, at = index + 1, stop
            yield pd.DataFrame(out, columns=["doc_id", "table_index", "part", "tokens", "rows_in", "overflow", "content"])

    return files.select("doc_id", "text").mapInPandas(run, SPLIT)


def as_csv_tables(docs: DataFrame) -> DataFrame:
    """Documents as one marked table of a row for each line, for trying out ``split_files``."""
    rows = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.concat(i.cast("string"), F.lit(","), F.replace(x, F.lit(","), F.lit(";")))), "\n")
    return docs.select("doc_id", F.concat(F.lit(MARKER + "\nkey,value\n"), rows).alias("text"))


# --- rewriting tables


def pipes_to_csv(lines: Lines) -> Lines:
    """Pipe tables outside fences become CSV blocks under a marker; missing headers are named, short rows padded."""
    out: Lines = []
    for code, run in blocks(lines):
        if code:
            out += run
            continue
        spans = [s for s in find_tables("\n".join(run)) if run[s[0]].lstrip().startswith("|")]
        at = 0
        for a, b in spans:
            rows = table_rows(run[a:b])
            width = max(map(len, rows))
            rows = [r + [""] * (width - len(r)) for r in rows]
            rows[0] = [c or f"Column {i + 1}" for i, c in enumerate(rows[0])]
            made = io.StringIO()
            csv.writer(made, lineterminator="\n").writerows(rows)
            out += [*run[at:a], MARKER, *made.getvalue().rstrip("\n").split("\n")]
            at = b
        out += run[at:]
    return out


def move_tables_to_end(lines: Lines, heading: str) -> Lines:
    """The tables of the named section at its end."""
    out: Lines = []
    moved: Lines = []
    inside = False
    for code, run in blocks(lines):
        if code:
            out += run
            continue
        spans = find_tables("\n".join(run))
        for i, line in enumerate(run):
            if re.match(r"^#{1,6}\s", line):
                if inside and moved:
                    out += [*moved, ""]
                    moved = []
                inside = line.lstrip("#").strip() == heading
            if inside and any(a <= i < b for a, b in spans):
                moved.append(line)
            else:
                out.append(line)
    return [*out, "", *moved] if moved else out


def unescaped(text: str) -> str:
    return html_entities.unescape(text)


def rewritten(files: DataFrame, change: Callable[[Lines], Lines]) -> DataFrame:
    """``files`` with a rewriting of lines applied to each text; null stays null."""
    scratch.ship(files.sparkSession)

    return files.withColumn("text", by_row(lambda t: t if t is None else "\n".join(change(t.split("\n"))), "string", "text"))
