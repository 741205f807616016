"""Markdown structure against a plain sequential reading, on random files."""

import random

import pytest
from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import headings, tables
from docquarry.plans import registry


def sequential(text):
    """(ord, level, heading, body, parent, path) by a stack."""
    out, stack, fence = [], [], ""
    for line in text.split("\n"):
        run = next((m for m in ("````", "```", "~~~") if line.startswith(m)), "")
        if fence or run:
            if run and not fence:
                fence = run
            elif run == fence:
                fence = ""
            if out:
                out[-1][3].append(line)
            continue
        marks = len(line) - len(line.lstrip("#"))
        if 1 <= marks <= 6 and line[marks : marks + 1] == " " and line[marks:].strip():
            while stack and stack[-1][1] >= marks:
                stack.pop()
            parent = stack[-1][0] if stack else None
            title = line[marks:].strip()
            path = " > ".join([s[2] for s in stack] + [title])
            out.append([len(out), marks, title, [], parent, path])
            stack.append((len(out) - 1, marks, title))
        elif out:
            out[-1][3].append(line)
    return [(o, lv, h, "\n".join(b).strip(), p, path) for o, lv, h, b, p, path in out]


@pytest.fixture(scope="module")
def files():
    rng = random.Random(4)
    made = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(30)):
            kind = rng.random()
            if kind < 0.4:
                lines.append("#" * rng.randint(1, 6) + f" T{rng.randrange(5)}")
            elif kind < 0.5:
                lines.append(rng.choice(["```", "~~~", "```"]))
            else:
                lines.append(rng.choice(["", "word two", "a, b, c", "#nohead", "  x  "]))
        made.append((i, f"f{i}.md", "\n".join(lines)))
    return made + [(100, "empty.md", ""), (101, "plain.md", "no heading\nat all")]


def test_sections_and_paths_match_a_stack(spark, files):
    df = spark.createDataFrame(files, "doc_id long, filename string, text string")
    got = {}
    for r in headings.with_path(headings.sections(df)).collect():
        got.setdefault(r.filename, []).append((r.ord, r.level, r.heading, r.body, r.parent_ord, r.path))
    for _, name, text in files:
        assert sorted(got.get(name, [])) == sequential(text), name


def test_cumulative_tokens(spark, files):
    df = spark.createDataFrame(files, "doc_id long, filename string, text string")
    rows = headings.sections(df).withColumn("token_count", T.token_count(F.col("body")))
    got = {(r.filename, r.ord): r.cumulative_tokens for r in headings.cumulative_tokens(rows).collect()}
    for _, name, text in files:
        secs = sequential(text)
        for o, lv, *_ in secs:
            stop = next((x[0] for x in secs if x[0] > o and x[1] <= lv), len(secs))
            want = sum(len(x[3].split()) for x in secs[o:stop]) if stop > o + 1 else None
            assert got[name, o] == want


def test_chunk_invariants(spark, files):
    df = spark.createDataFrame(files, "doc_id long, filename string, text string")
    rows = tables.peel(tables.with_components(df), limit=12).collect()
    by_id = {r.id: r for r in rows}
    assert len(by_id) == len(rows)
    for r in rows:
        assert r.embed == (r.token_count > 0)
        for link in (r.parent_id, r.id_prev, r.id_next):
            assert link is None or by_id[link].filename == r.filename
        if r.chunk_type != "heading":
            assert r.id in by_id[r.parent_id].examples
    assert any(r.chunk_type == "example" for r in rows) and any(r.chunk_type == "table" for r in rows)


def test_depth_limit_keeps_bodies(spark):
    df = spark.createDataFrame([(1, "a.md", "# A\nx\n### deep\ny\n## B\nz")], "doc_id long, filename string, text string")
    got = [(r.heading, r.body) for r in headings.sections(df, deepest=2).orderBy("ord").collect()]
    assert got == [("A", "x\ny"), ("B", "z")]


def test_duplicates_and_levels(spark):
    df = spark.createDataFrame([(1, "a.md", "# A\n## X\n## X\n# B\n## X")], "doc_id long, filename string, text string")
    rows = headings.sections(df)
    assert [(r.parent_path, r.heading, r.n, r.lines) for r in headings.duplicate_headings(rows).collect()] == [("A", "X", 2, "2,3")]
    report = {r.level: r.n_sections for r in headings.level_report(rows.withColumn("token_count", F.lit(1))).collect()}
    assert report == {0: 5, 1: 2, 2: 3}


def test_front_matter_and_titles(spark):
    df = spark.createDataFrame([("---\nTitle: 'A b'\nbad line\nx: 1\nx: 2\n---\nbody",), ("no matter",), ("",)], "t string")
    got = [(dict(r.p.meta), r.p.body) for r in df.select(T.parse_front_matter(F.col("t")).alias("p")).collect()]
    assert got == [({"Title": "A b", "x": "2"}, "body"), ({}, "no matter"), ({}, "")]
    page = spark.createDataFrame([("<h1>one</h1><H1 class='a page-title b'> two <b>x</b>&amp;y </H1>",), ("<p>none</p>",)], "h string")
    assert [r.t for r in page.select(T.html_title(F.col("h")).alias("t")).collect()] == ["two x&y", None]


def test_greedy_and_balanced(spark):
    df = spark.createDataFrame([([5, 5, 5, 30, 1],), ([],)], "s array<int>")
    got = [[tuple(p) for p in r.p] for r in df.select(tables.greedy_packs(F.col("s"), 12).alias("p")).collect()]
    assert got == [[(0, 10, 2, False), (1, 5, 1, False), (2, 30, 1, True), (3, 1, 1, False)], []]
    cut = [r.c for r in spark.createDataFrame([([300, 300],), ([100],), ([480, 30, 90],)], "s array<int>").select(tables.balanced_cut(F.col("s"), 490, 900).alias("c")).collect()]
    assert cut == [1, None, 1]


def test_whole_lines_stay_below_their_headings(spark):
    lines = [f"line {i} " + "word " * 30 + f"end{i}" for i in range(12)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.text.split("\n") for r in headings.synthetic_markdown(df).collect()}
    assert [x for x in got[1] if not x.startswith("#")] == lines and sum(x.startswith("#") for x in got[1]) == 3


@pytest.mark.parametrize("name", ["clean_files", "toc_align", "peel_components"])
def test_queries_without_sql_read_whole_lines(spark, tmp_path, name):
    text = "\n".join(f"Line {i} is prose of many plain words before its own ending tail{i}." for i in range(12))
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = " ".join(str(v) for r in registry.queries()[name](spark, str(tmp_path)).collect() for v in r)
    assert all(f"tail{i}." in out for i in range(12))


def test_untagged_code_is_split_by_its_functions():
    code = "x = 1\ndef f():\n    return 1\n# about g\ndef g():\n    return 2"
    assert tables.split_code(code, "") == tables.split_code(code, "python") == ["x = 1", "def f():\n    return 1", "# about g\ndef g():\n    return 2"]
    script = "var a = 1;\nfunction f() {\n}\nexport async function g() {\n}"
    assert len(tables.split_code(script, "")) == len(tables.split_code(script, "extendscript")) == 3 and tables.split_code("plain words", "") == ["plain words"]
