"""Markdown cleaning passes.

Passes that a pattern or an array expression can state are native columns. Those
that read lines as a machine does are plain functions from lines to lines; the
whole chain of them runs in one UDF, so a text crosses to Python
once. ``clean`` applies all in their order; a gate says which files get the
passes meant for one kind of source.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.functions.by_row import by_row
from docquarry.functions.text import let, strip
from docquarry.operators.headings import HEADING, fenced_ranges

Lines = list[str]


# --- native passes


@dataclass(frozen=True)
class Rule:
    """A rewrite: a Java pattern, its replacement ($1 for groups) and its place in the order (low first; equal ones as given)."""

    pattern: str
    replacement: str
    priority: int = 100


RULES = [
    Rule("&amp;", "&", 11),
    Rule("&lt;", "<", 12),
    Rule("&gt;", ">", 13),
    Rule(r"(?s)<code>(.*?)</code>", "$1", 16),
    Rule(r"(?im)^[ \t]*back to top[ \t]*$", "", 20),
    Rule(r"(?im)^[ \t]*last updated?\b.*$", "", 30),
    Rule(r"(?im)^[ \t]*skip to (?:main )?content[ \t]*$", "", 40),
    Rule(r"(?ims)^## (?:contents|toc|table of contents)[ \t]*$.*?(?=^#|\z)", "", 55),
    Rule(r"(?m)^\* \* \*[ \t]*(?:\*)?[ \t]*$", "", 65),
    Rule(r"(?m)^Copy[ \t]*$", "", 70),
    Rule(r"(?m)^\. ?", "- ", 100),
    Rule("\r\n", "\n", 999),
    Rule("\n{3,}", "\n\n", 999),
    Rule(r"(^|\n)[ ]+(\* |\d+\. )", "$1$2", 1000),
]


def apply_rules(text: Column, rules: Iterable[Rule]) -> Column:
    """All rules in order, as one projection. Rules that must see a literal word are tried only where it is."""
    for r in sorted(rules, key=lambda r: r.priority):
        text = F.regexp_replace(text, r.pattern, r.replacement)
    return text


def collapse_blank_runs(text: Column) -> Column:
    """Blank lines after a blank line go."""
    keep = lambda ls: F.filter(ls, lambda x, i: ~((F.trim(x) == "") & (i > 0) & (F.trim(F.coalesce(F.get(ls, i - 1), F.lit("."))) == "")))
    return let(F.split(text, "\n"), lambda ls: F.array_join(keep(ls), "\n"))


def _outside(text: Column, change: Callable[[Column], Column]) -> Column:
    """Lines outside code fences changed, the others as they are."""
    return let(F.split(text, "\n"), lambda ls: let(fenced_ranges(ls), lambda rs: F.array_join(F.transform(ls, lambda x, i: F.when(F.exists(rs, lambda r: (i >= r["a"]) & (i <= r["b"])), x).otherwise(change(x))), "\n")))


def heading_number_off(line: Column, alone: bool = False) -> Column:
    """A heading line without its number; with ``alone`` also where nothing but white space follows. White space is ASCII's, without the vertical tab."""
    return F.regexp_replace(line, r"^(#{1,6}[\t\n\f\r ]+)\d+(?:\.\d+)*[.):]?[\t\n\f\r ]+" + ("" if alone else r"(?=\S)"), "$1")


def strip_heading_numbers(text: Column) -> Column:
    """``## 1.2 Title`` loses its number; a number needs a space after it, so "3D" and "2024" alone stay."""
    return _outside(text, heading_number_off)


def blank_short_sections(text: Column, least: int = 30) -> Column:
    """Bodies of fewer than ``least`` characters go; their headings stay. Text before the first heading stays."""

    def cut(ls: Column) -> Column:
        def with_heads(hs: Column) -> Column:
            body = lambda i, k: F.slice(ls, i + 2, F.greatest(F.coalesce(F.get(hs, k + 1), F.size(ls)) - i - 1, F.lit(0)))
            part = lambda i, k: F.when(F.char_length(strip(F.array_join(body(i, k), "\n"))) >= least, F.concat(F.array(F.get(ls, i)), body(i, k))).otherwise(F.array(F.get(ls, i)))
            before = F.slice(ls, F.lit(1), F.coalesce(F.get(hs, F.lit(0)), F.size(ls)))
            return F.array_join(F.concat(before, F.flatten(F.transform(hs, part))), "\n")

        free = lambda rs: F.filter(F.array_compact(F.transform(ls, lambda x, i: F.when(x.rlike(HEADING), i))), lambda i: ~F.exists(rs, lambda r: (i >= r["a"]) & (i <= r["b"])))
        return let(let(fenced_ranges(ls), free), with_heads)

    return let(F.split(text, "\n"), cut)


def drop_page_furniture(text: Column) -> Column:
    """"On this page" and search sections, and empty comment headings."""
    text = F.regexp_replace(text, r"(?ms)^#### On this page[ \t]*$.*?(?=^#|\z)", "")
    text = F.regexp_replace(text, r"(?ms)^##### Search[ \t]*$.*?(?=^#|\z)", "")
    return F.regexp_replace(text, r"(?m)^# comment:[ \t]*$\n?", "")


def fill_empty_h1(text: Column) -> Column:
    """An H1 without text before the next heading gets a sentence and the H2 titles as bullets."""
    title = F.trim(F.regexp_extract(text, r"\A\s*# ([^\n]*)\n\s*(?=##)", 1))
    bullets = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"(?m)^## +(.+?)[ \t]*$"), 1), lambda h: F.concat(F.lit("- "), h)), "\n")
    rest = F.regexp_replace(text, r"\A\s*# [^\n]*\n\s*", "")
    return F.when(title != "", F.concat(F.lit("# "), title, F.lit("\n\nFor information about "), title, F.lit(", see the following:\n\n"), bullets, F.lit("\n\n"), rest)).otherwise(text)


def ensure_top_heading(text: Column, title: Column) -> Column:
    """``# title`` before a text that has no H1."""
    return F.when(text.rlike(r"(?m)^# ") | (F.coalesce(title, F.lit("")) == ""), text).otherwise(F.concat(F.lit("# "), title, F.lit("\n\n"), text))


# --- line machines

FENCE = re.compile(r"^\s*(`{3,}|~{3,})")
BULLET = re.compile(r"^\s*[*+-]\s+\S")
ORDERED = re.compile(r"^\s*\d+[.)]\s+\S")
BOLD = re.compile(r"^\*\*[^*].*\*\*$")
ATX = re.compile(r"^#{1,6}\s")
ASSIGNED = re.compile(r"^\s*[\w.-]+\s*=\s*\S")
URL = re.compile(r"^(`?)(https?://\S+?)\1$")


def fenced(lines: Lines) -> list[bool]:
    """For each line whether it is a fence or within one."""
    out, open_run = [], ""
    for line in lines:
        m = FENCE.match(line)
        if not m:
            out.append(bool(open_run))
            continue
        out.append(True)
        open_run = m[1] if not open_run else "" if m[1] == open_run else open_run
    return out


def blocks(lines: Lines) -> list[tuple[bool, Lines]]:
    """Runs of fenced and of other lines; each fence is a run of its own with its borders."""
    out: list[tuple[bool, Lines]] = []
    open_run = ""
    for line in lines:
        m = FENCE.match(line)
        if m and not open_run:
            open_run = m[1]
            out.append((True, [line]))
        elif open_run:
            out[-1][1].append(line)
            if m and m[1] == open_run:
                open_run = ""
        elif out and not out[-1][0]:
            out[-1][1].append(line)
        else:
            out.append((False, [line]))
    return out


def prose(change: Callable[[Lines], Lines]) -> Callable[[Lines], Lines]:
    """A pass that sees the runs of lines between fences, one after the other."""

    def whole(lines: Lines) -> Lines:
        return [x for code, run in blocks(lines) for x in (run if code else change(run))]

    whole.__name__, whole.__doc__ = change.__name__, change.__doc__
    return whole


def content_from_title(lines: Lines) -> Lines:
    """What comes before the first H1 goes, but for front matter; a text without an H1 stays."""
    start = 0
    if lines and lines[0].strip() == "---":
        start = next((i + 1 for i in range(1, len(lines)) if lines[i].strip() == "---"), 0)
    code = fenced(lines)
    first = next((i for i in range(start, len(lines)) if lines[i].startswith("# ") and not code[i]), None)
    return lines if first is None else lines[:start] + lines[first:]


def spaced(lines: Lines, wants: Callable[[str], bool], after: bool = True) -> Lines:
    out: Lines = []
    for i, line in enumerate(lines):
        if wants(line):
            if out and out[-1].strip():
                out.append("")
            out.append(line)
            if after and i + 1 < len(lines) and lines[i + 1].strip():
                out.append("")
        else:
            out.append(line)
    return out


@prose
def space_around_headings(lines: Lines) -> Lines:
    """Blank lines around headings of levels 1 to 4."""
    return spaced(lines, lambda x: bool(re.match(r"^#{1,4}\s", x)))


@prose
def space_around_bold(lines: Lines) -> Lines:
    """Blank lines around lines that are bold as a whole."""
    return spaced(lines, lambda x: bool(BOLD.match(x.strip())))


@prose
def link_see_also(lines: Lines) -> Lines:
    """Titles under "See also" become bullets that link to their pages, unless they are bullets."""
    out: Lines = []
    at = 0
    while at < len(lines):
        out.append(lines[at])
        bare = lines[at].strip().strip("*#: ").lower()
        at += 1
        if bare != "see also" or lines[at - 1].strip().lower() == "see also" and not lines[at - 1].startswith(("#", "*")):
            continue
        stop = at
        while stop < len(lines) and not (ATX.match(lines[stop]) or BOLD.match(lines[stop].strip()) or lines[stop].lstrip().startswith("|")):
            stop += 1
        named = [" ".join(x.split()) for x in lines[at:stop] if x.strip()]
        if not named or any(BULLET.match(x) for x in lines[at:stop]):
            continue
        items = re.split("[,;]", " ".join(named)) if any(c in x for x in named for c in ",;") else named
        out.append("")
        for item in filter(None, map(str.strip, items)):
            name = re.sub("[^a-z0-9]+", "-", re.sub("['’]", "", item.lower())).strip("-")
            if name:
                out.append(f"- [{item}]({name}.md)")
        if stop < len(lines):
            out.append("")
        at = stop
    return out


def inline_url_fences(lines: Lines) -> Lines:
    """A fence that holds nothing but a URL, also one broken over lines, becomes inline code."""
    out: Lines = []
    for code, run in blocks(lines):
        inner = ["".join(x.split()) for x in run[1:-1] if x.strip()] if code and len(run) > 2 and FENCE.match(run[-1]) else []
        if inner and re.match("https?://", inner[0]) and all(re.fullmatch(r"[\w./?=&%#:+,;~@!$'()*-]+", x) and not x.startswith("http") for x in inner[1:]):
            out.append(f"`{''.join(inner)}`")
        else:
            out += run
    return out


@prose
def single_urls(lines: Lines) -> Lines:
    """Of equal URLs alone on lines that follow each other one stays, in backticks if any is."""
    out: Lines = []
    last: tuple[str, int] | None = None  # the URL and where it stands in ``out``
    for line in lines:
        m = URL.match(line.strip())
        if m and last and m[2] == last[0]:
            if m[1]:
                out[last[1]] = f"`{m[2]}`"
            del out[last[1] + 1 :]
            continue
        if m:
            last = (m[2], len(out))
        elif line.strip():
            last = None
        out.append(line)
    return out


JSON_START = re.compile(r'^\s*[\[{]\s*(?:"|[\[{]|$)')
SHELL = re.compile(r"^\s*(?:\$ |sudo |cd |ls\b|curl |git |npm |pip |export |mkdir |docker )")
RUST = re.compile(r"\bfn \w+\s*[(<]|\blet mut \b|\bimpl\b.*\{|println!\(")
PYTHON = re.compile(r"^\s*(?:def \w+\(|import \w|from \w+ import |class \w+.*:\s*$)", re.M)
SCRIPT = re.compile(r"\bfunction\s*\w*\(|=>\s*\{|\bconst \w+ =|\bvar \w+ =|console\.log\(")
MARKUP = re.compile(r"^\s*<(?:\?xml|!DOCTYPE|[A-Za-z][\w:-]*[\s>/])")
STATEMENTS = re.compile(r"^\s*<(?:MIFFile|Para|TextFlow|Pgf\w*|Units|Document)\b[^=/]*(?:>|$)", re.M)
SHEET = re.compile(r"^[^{};=()]*\{\s*(?:[\w-]+\s*:[^;{}]+;?\s*)+\}", re.M)
NATIVE = (("cpp", re.compile(r"^\s*#include\s*[<\"]|\busing namespace\b", re.M)), ("java", re.compile(r"\bpublic static void main\b|\bSystem\.out\.print")), ("csharp", re.compile(r"\bConsole\.Write|^\s*using System\b", re.M)))
BRACED = ("javascript", "typescript", "css", "c", "cpp", "java", "csharp")
ALIASES = {"js": "javascript", "ts": "typescript", "py": "python", "sh": "bash", "shell": "bash", "console": "bash", "yml": "yaml", "rs": "rust", "c++": "cpp", "htm": "html"}


def guess_language(code: str, tag: str = "") -> str:
    """The language of a code block: its tag under its usual name, else what its text shows; empty if unknown."""
    tag = ALIASES.get(tag.lower(), tag.lower())
    if tag and tag not in ("text", "plaintext", "code"):
        return tag
    body = code.strip()
    if re.match(r'"[^"\n]+"\s*:', body):
        return "json"  # members without their braces
    for name, sign in (("json", JSON_START), ("mif", STATEMENTS), ("xml", MARKUP), ("rust", RUST), *NATIVE, ("python", PYTHON), ("javascript", SCRIPT), ("css", SHEET), ("bash", SHELL)):
        if sign.search(body):
            return "html" if name == "xml" and re.match(r"^\s*<(?:!DOCTYPE html|html\b|div\b|p\b)", body, re.I) else name
    return tag


def tag_fences(lines: Lines) -> Lines:
    """Opening fences get the language of their code."""
    out: Lines = []
    for code, run in blocks(lines):
        m = re.match(r"^(\s*(?:`{3,}|~{3,}))\s*([\w+.#-]*)\s*$", run[0]) if code else None
        out += [m[1] + guess_language("\n".join(run[1:-1]), m[2]), *run[1:]] if m else run
    return out


def drop_prose_copy_of_code(lines: Lines) -> Lines:
    """Lines right above a fence that say the same as its code go."""
    out: Lines = []
    squeeze = lambda xs: re.sub(r"\s+", "", "".join(xs))
    for code, run in blocks(lines):
        want = squeeze(run[1:-1]) if code else ""
        if want:
            end = len(out)
            while end and not out[end - 1].strip():
                end -= 1
            start = end
            while start and out[start - 1].strip() and not ATX.match(out[start - 1]) and not FENCE.match(out[start - 1]) and len(squeeze(out[start:end])) < len(want):
                start -= 1
            if start < end and squeeze(out[start:end]) == want:
                del out[start:end]
        out += run
    return out


def cells(line: str) -> Lines:
    """The cells of a pipe row; escaped pipes are part of a cell."""
    return [c.strip().replace(r"\|", "|") for c in re.split(r"(?<!\\)\|", line.strip().removeprefix("|").removesuffix("|"))]


def is_separator(line: str) -> bool:
    return bool(re.fullmatch(r"\s*\|?\s*:?-+:?\s*(?:\|\s*:?-+:?\s*)*\|?\s*", line)) and "-" in line and "|" in line


@prose
def merge_wrapped_rows(lines: Lines) -> Lines:
    """A table row whose first cell is empty continues the row above it. Separators stay, so that the table is still one."""
    out: Lines = []
    for line in lines:
        row = line.lstrip().startswith("|") and line.rstrip().endswith("|")
        if row and not is_separator(line):
            own = cells(line)
            if not any(own):
                continue
            if not own[0] and out and out[-1].lstrip().startswith("|") and not is_separator(out[-1]) and len(cells(out[-1])) == len(own):
                joined = [" ".join(filter(None, pair)) for pair in zip(cells(out[-1]), own, strict=True)]
                out[-1] = "| " + " | ".join(joined) + " |"
                continue
        out.append(line)
    return out


@prose
def repair_broken_rows(lines: Lines) -> Lines:
    """Rows of a table with a separator that are broken over lines are closed: pieces are joined until the row has its cells."""
    out: Lines = []
    columns = 0
    for i, line in enumerate(lines):
        s = line.strip()
        if is_separator(line) and out and out[-1].lstrip().startswith("|"):
            columns = len(cells(out[-1]))
        elif not s or ATX.match(s) or BOLD.match(s):
            if columns and out and out[-1].lstrip().startswith("|") and not out[-1].rstrip().endswith("|"):
                out[-1] = out[-1].rstrip() + " |"
            columns = 0 if s or not (i + 1 < len(lines) and lines[i + 1].lstrip().startswith("|")) else columns
        elif columns and out and out[-1].lstrip().startswith("|") and not out[-1].rstrip().endswith("|"):
            full = s.startswith("|") and s.endswith("|") and len(cells(s)) >= columns
            if not full:
                part = re.sub(r"^[-*+]\s+", "", s.removeprefix("|").strip())
                glue = " | " if len(cells(out[-1] + " |")) < columns and s.startswith("|") else " "
                out[-1] = out[-1].rstrip() + glue + part
                continue
            out[-1] = out[-1].rstrip() + " |"
        out.append(line)
    if columns and out and out[-1].lstrip().startswith("|") and not out[-1].rstrip().endswith("|"):
        out[-1] = out[-1].rstrip() + " |"
    return out


@prose
def dash_bullets(lines: Lines) -> Lines:
    """Bullets are dashes with blank lines around; ``key=value`` lines right under one belong to it; runs of blanks are one."""
    out: Lines = []
    at = 0
    while at < len(lines):
        line = lines[at]
        at += 1
        if not BULLET.match(line):
            if line.strip() or not out or out[-1].strip():
                out.append(line)
            continue
        if out and out[-1].strip():
            out.append("")
        out.append("- " + re.sub(r"^\s*[*+-]\s+", "", line).strip())
        while at < len(lines) and ASSIGNED.match(lines[at]) and not BULLET.match(lines[at]):
            out.append("  " + lines[at].strip())
            at += 1
        out.append("")
    return out


@prose
def space_ordered_lists(lines: Lines) -> Lines:
    """A blank line before each numbered item."""
    return spaced(lines, lambda x: bool(ORDERED.match(x)), after=False)


@prose
def caution_admonitions(lines: Lines) -> Lines:
    """A line "Caution" with the prose under it becomes an admonition."""
    ends = lambda x: not x.strip() or x.lstrip().startswith(("#", "|")) or BOLD.match(x.strip()) or BULLET.match(x) or ORDERED.match(x)
    out: Lines = []
    at = 0
    while at < len(lines):
        if lines[at].strip().lower() != "caution":
            out.append(lines[at])
            at += 1
            continue
        if out and out[-1].strip():
            out.append("")
        out += ["> [!CAUTION]", ">"]
        at += 1
        while at < len(lines) and not ends(lines[at]):
            out.append(f"> {lines[at].strip()}")
            at += 1
        if at < len(lines) and lines[at].strip():
            out.append("")
    return out


def strip_code_line_numbers(lines: Lines) -> Lines:
    """Code whose every line is numbered in order loses the numbers."""
    out: Lines = []
    for code, run in blocks(lines):
        inner = run[1:-1] if code and len(run) > 2 else []
        found = [re.match(r"^\s*(\d+)[.:)]?(?:\s|$)(.*)$", x) for x in inner if x.strip()]
        if found and all(found) and [int(m[1]) for m in found] == list(range(int(found[0][1]), int(found[0][1]) + len(found))) and int(found[0][1]) <= 1 and len(found) > 1:
            run = [run[0], *(re.sub(r"^\s*\d+[.:)]?(?: |$)", "", x) for x in inner), run[-1]]
        out += run
    return out


@prose
def blank_after_headings(lines: Lines) -> Lines:
    """A blank line after each heading."""
    out: Lines = []
    for i, line in enumerate(lines):
        out.append(line)
        if ATX.match(line) and i + 1 < len(lines) and lines[i + 1].strip():
            out.append("")
    return out


def drop_thin_sections(lines: Lines, least_words: int = 5) -> Lines:
    """Headings stay, bodies of fewer words go."""
    out: Lines = []
    code, body = fenced(lines), []

    def flush(headed: bool) -> None:
        if not headed or sum(len(x.split()) for x in body) >= least_words:
            out.extend(body)
        body.clear()

    headed = False
    for line, c in zip(lines, code, strict=True):
        if ATX.match(line) and not c:
            flush(headed)
            out.append(line)
            headed = True
        else:
            body.append(line)
    flush(headed)
    return out


QUOTED = re.compile(r"\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'|//[^\n]*|/\*.*?\*/", re.S)


def reindented(code: str) -> str:
    """Lines of brace code at two spaces for each open brace; as they are where braces don't match or a text may run over lines."""
    bare = QUOTED.sub(lambda m: "\n" * m[0].count("\n"), code)
    if "`" in code or any("\n" in m[0] for m in QUOTED.finditer(code)):
        return code
    out, depth = [], 0
    for line, plain in zip(code.split("\n"), bare.split("\n"), strict=True):
        first = len(re.match(r"[\s}]*", plain)[0].replace(" ", "").replace("\t", ""))
        out.append(("  " * max(0, depth - first) + line.strip()).rstrip())
        depth += plain.count("{") - plain.count("}")
        if depth < 0:
            return code
    return "\n".join(out) if depth == 0 else code


def nested_statements(code: str) -> str:
    """One angle statement a line, two spaces for each that is open; a statement that holds no other stays on its line."""
    out: Lines = []
    depth, here = 0, ""
    for part in re.findall(r"`[^']*'|#[^\n]*|[<>]|[^<>`#]+|`", code):
        if part == "<":
            if here.strip():
                out.append("  " * depth + " ".join(here.split()))
                depth += here.lstrip().startswith("<")
            here = "<"
        elif part == ">":
            if here.strip():
                out.append("  " * depth + " ".join(here.split()) + ">")
            else:
                depth = max(0, depth - 1)
                out.append("  " * depth + ">")
            here = ""
        elif part[0] == "#":
            if here.strip():
                out.append("  " * depth + " ".join(here.split()))
                depth += here.lstrip().startswith("<")
                here = ""
            if out and out[-1].strip() == ">":
                out[-1] += " " + part.strip()
            else:
                out.append("  " * depth + part.strip())
        elif part[0] == "`":
            here += part
        else:
            here += part if here else part.lstrip()
    if here.strip():
        out.append("  " * depth + " ".join(here.split()))
    return "\n".join(out)


def format_code(code: str, language: str) -> str:
    """Pretty-printed JSON (whole, or members without their braces), XML-like, angle-statement and brace languages; other code as it is."""
    import json

    if language == "json":
        try:
            return json.dumps(json.loads(code), indent=2, ensure_ascii=False)
        except ValueError:
            pass
        try:
            members = json.dumps(json.loads("{" + code.strip().rstrip(",") + "}"), indent=2, ensure_ascii=False)
            return "\n".join(x[2:] for x in members.split("\n")[1:-1]) + ("," if code.rstrip().endswith(",") else "")
        except ValueError:
            return code
    if language == "mif":
        return nested_statements(code)
    if language in BRACED and "\n" in code.strip():
        return reindented(code)
    if language in ("xml", "html"):
        parts, depth, out = re.findall(r"<[^>]+>|[^<]+", code), 0, []
        for p in filter(None, map(str.strip, parts)):
            depth -= p.startswith("</")
            out.append("  " * max(0, depth) + p)
            depth += bool(re.match(r"<[A-Za-z]", p)) and not p.endswith("/>") and not re.match(r"<(?:br|img|hr|input|meta|link)\b", p, re.I)
        return "\n".join(out)
    if language in BRACED:
        out, depth = [], 0
        for p in filter(None, map(str.strip, re.split(r"(?<=[{};])|(?=\})", code))):
            depth -= p.startswith("}")
            out.append("  " * max(0, depth) + p)
            depth += p.endswith("{")
        return "\n".join(out)
    return code


def format_fences(lines: Lines) -> Lines:
    """Code in fences is formatted by its language."""
    out: Lines = []
    for code, run in blocks(lines):
        m = re.match(r"^(\s*(?:`{3,}|~{3,}))\s*([\w+.#-]*)", run[0]) if code and len(run) > 2 and FENCE.match(run[-1]) else None
        if m:
            inner = "\n".join(run[1:-1])
            language = guess_language(inner, m[2])
            out += [m[1] + language, *format_code(inner, language).split("\n"), run[-1]]
        else:
            out += run
    return out


def unwrap_comments(lines: Lines) -> Lines:
    """Consecutive ``//`` comment lines of one indent become one; ``///`` lines are left alone."""
    out: Lines = []
    for line in lines:
        m = re.match(r"^(\s*)//(?!/)\s?(.*)$", line)
        before = re.match(r"^(\s*)//(?!/)", out[-1]) if out else None
        if m and before and before[1] == m[1] and m[2].strip():
            out[-1] = out[-1].rstrip() + " " + m[2].strip()
        else:
            out.append(line)
    return out


EVERY_FILE = [content_from_title]
GATED_FIRST = [space_around_headings, space_around_bold, link_see_also, inline_url_fences, single_urls]
CODE = [tag_fences]
GATED_LAST = [drop_prose_copy_of_code, merge_wrapped_rows, repair_broken_rows, dash_bullets, space_ordered_lists, caution_admonitions]
LAST = [strip_code_line_numbers]


#: Fields of front matter, and the kind of source that gets the gated passes.
GATE_FIELDS = ("category", "title", "description")
GATE_KIND = "adobe connect"


def gated_by_front_matter(text: Column, kind: str = GATE_KIND) -> Column:
    """Whether the front matter names the kind of source in one of its fields."""
    block = F.lower(F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---\n", 1))
    return F.coalesce(F.exists(F.array(*(F.lit(f"{f}: {kind.lower()}") for f in GATE_FIELDS)), lambda x: F.contains(block, x)), F.lit(False))


SINGLE = [*EVERY_FILE, *GATED_FIRST, *CODE, *GATED_LAST, *LAST]


def single_passes(files: DataFrame, key: str = "doc_id", names: Iterable[str] | None = None) -> DataFrame:
    """(key, pass, text): each line machine alone, or those named, on each file.

    A file's row is repeated for each pass in the JVM, a row at a time; Python sees
    one text and makes one of it, so no batch holds a text in all its versions.
    """
    scratch.ship(files.sparkSession)
    steps = {s.__name__: s for s in [*SINGLE, blank_after_headings, drop_thin_sections, format_fences, unwrap_comments]}
    wanted = [n for n in steps if names is None or n in set(names)]
    made = files.select(key, F.explode(F.array(*map(F.lit, wanted))).alias("pass"), F.coalesce("text", F.lit("")).alias("text"))
    return made.select(key, "pass", by_row(lambda name, t: "\n".join(steps[name](t.split("\n"))), "string", "pass", "text").alias("text"))


def run_passes(text: str, gated: bool) -> str:
    lines = text.split("\n")
    for step in [*EVERY_FILE, *(GATED_FIRST if gated else []), *CODE, *(GATED_LAST if gated else []), *LAST]:
        lines = step(lines)
    return "\n".join(lines)


def computed(files: DataFrame, text: Column) -> DataFrame:
    """``files`` with this text. Exploding an array of one keeps the optimizer from copying the expression into every use of the column."""
    return files.withColumn("_clean", F.explode(F.array(text))).withColumn("text", F.col("_clean")).drop("_clean")


def clean(files: DataFrame, gate: Column | None = None, title: Column | None = None, rules: Iterable[Rule] = RULES) -> DataFrame:
    """``files`` with its text cleaned: native structure passes, the line machines in one UDF, then the rewrite rules.

    gate: files that also get the passes for one kind of source, by default those whose front matter names it.
    """
    scratch.ship(files.sparkSession)

    gate = gated_by_front_matter(F.col("text")) if gate is None else F.coalesce(gate, F.lit(False))
    first = computed(files.withColumn("_gated", gate), drop_page_furniture(F.col("text")))
    first = computed(first, blank_short_sections(F.col("text")))
    first = computed(first, fill_empty_h1(F.col("text")))
    first = computed(first, strip_heading_numbers(ensure_top_heading(F.col("text"), F.lit(None).cast("string") if title is None else title)))
    second = first.withColumn("text", by_row(lambda t, gated: None if t is None else run_passes(t, bool(gated)), "string", "text", "_gated")).drop("_gated")
    return second.withColumn("text", apply_rules(F.col("text"), rules))
