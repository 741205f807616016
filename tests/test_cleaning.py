import pytest
from pyspark.sql import functions as F

from docquarry.operators import cleaning as C
from docquarry.operators import tables as T
from docquarry.operators import toc


def run(step, text):
    return "\n".join(step(text.split("\n")))


def test_preamble_goes_and_front_matter_stays():
    assert run(C.content_from_title, "---\na: 1\n---\nnav\n# T\nx") == "---\na: 1\n---\n# T\nx"
    assert run(C.content_from_title, "```\n# no\n```\nx") == "```\n# no\n```\nx"


def test_lists_and_admonitions():
    assert run(C.dash_bullets, "a\n* one\nk=v\n+ two\nb") == "a\n\n- one\n  k=v\n\n- two\n\nb"
    assert run(C.space_ordered_lists, "a\n1. x\n2. y") == "a\n\n1. x\n\n2. y"
    assert run(C.caution_admonitions, "a\nCaution\nhot\nvery\n\nb") == "a\n\n> [!CAUTION]\n>\n> hot\n> very\n\nb"
    assert run(C.caution_admonitions, "```\ncaution\n```") == "```\ncaution\n```"


def test_links():
    assert run(C.link_see_also, "**See also**\n\nFoo bar, It's x; B\n# N") == "**See also**\n\n- [Foo bar](foo-bar.md)\n- [It's x](its-x.md)\n- [B](b.md)\n\n# N"
    assert run(C.link_see_also, "## See also\n- a") == "## See also\n- a"
    assert run(C.inline_url_fences, "```\nhttps://a.b/\nc?d=1\n```\nx") == "`https://a.b/c?d=1`\nx"
    assert run(C.single_urls, "https://a.b\n\n`https://a.b`\nx") == "`https://a.b`\nx"


def test_tables_are_repaired():
    assert run(C.merge_wrapped_rows, "| a | b |\n| --- | --- |\n| x | one |\n|  | two |\n|  |  |") == "| a | b |\n| --- | --- |\n| x | one two |"
    assert run(C.repair_broken_rows, "| a | b |\n| --- | --- |\n| x | one\ntwo |\n| y | z |") == "| a | b |\n| --- | --- |\n| x | one two |\n| y | z |"


def test_code():
    assert run(C.tag_fences, '```\n{"a": 1}\n```') == '```json\n{"a": 1}\n```'
    assert run(C.tag_fences, "```js\nx\n```") == "```javascript\nx\n```"
    assert run(C.strip_code_line_numbers, "```\n1 a\n2 b\n```") == "```\na\nb\n```"
    assert run(C.strip_code_line_numbers, "```\n1 a\n5 b\n```") == "```\n1 a\n5 b\n```"
    assert run(C.drop_prose_copy_of_code, "x\n\nget it now\n\n```\nget it\nnow\n```") == "x\n\n\n```\nget it\nnow\n```"
    assert C.format_code('{"a":[1]}', "json") == '{\n  "a": [\n    1\n  ]\n}'
    assert C.format_code("a{b:c;}", "css") == "a{\n  b:c;\n}"
    assert run(C.unwrap_comments, "  // a\n  // b\n/// c\n/// d") == "  // a b\n/// c\n/// d"


def test_spacing_and_thin_sections():
    assert run(C.space_around_headings, "a\n## B\nc\n```\n# x\n```") == "a\n\n## B\n\nc\n```\n# x\n```"
    assert run(C.space_around_bold, "a\n**B**\nc") == "a\n\n**B**\n\nc"
    assert run(C.blank_after_headings, "# A\nb") == "# A\n\nb"
    assert run(C.drop_thin_sections, "# A\none two\n# B\na b c d e") == "# A\n# B\na b c d e"


def test_native_passes(spark):
    df = spark.createDataFrame([("# 1.2 One\n## 3D models\n```\n# 1. no\n```\n## 2024 Report\n# 4) Four",)], "t string")
    assert df.select(C.strip_heading_numbers(F.col("t")).alias("x")).first().x == "# One\n## 3D models\n```\n# 1. no\n```\n## Report\n# Four"
    df = spark.createDataFrame([("pre\n# A\nshort\n## B\n" + "long " * 10 + "\n```\n# no\n```",)], "t string")
    assert df.select(C.blank_short_sections(F.col("t")).alias("x")).first().x == "pre\n# A\n## B\n" + "long " * 10 + "\n```\n# no\n```"
    df = spark.createDataFrame([("# T\n\n## A\nx\n## B\ny",)], "t string")
    assert df.select(C.fill_empty_h1(F.col("t")).alias("x")).first().x == "# T\n\nFor information about T, see the following:\n\n- A\n- B\n\n## A\nx\n## B\ny"
    df = spark.createDataFrame([("a &amp;lt; <code>x</code>\r\n\n\n\nCopy\nCopyright\n  * b",)], "t string")
    assert df.select(C.apply_rules(F.col("t"), C.RULES).alias("x")).first().x == "a < x\n\nCopyright\n* b"


def test_whole_file(spark):
    text = "nav\n# T\n\n#### On this page\nlinks\n## 1. Real\n" + "some words that are long enough here\n" + "```\n1 {\n2 }\n```\n"
    df = spark.createDataFrame([("a.md", text), ("n.md", None), ("e.md", "")], "filename string, text string")
    got = {r.filename: r.text for r in C.clean(df, gate=F.lit(True)).collect()}
    assert got["n.md"] is None and got["e.md"] == ""
    assert "nav" not in got["a.md"] and "On this page" not in got["a.md"] and "## Real" in got["a.md"] and "{\n}" in got["a.md"]


def test_find_and_peel_tables():
    pipe = "x\n| a | b |\n| --- | --- |\n| 1 | 2 |\ny"
    assert T.find_tables(pipe) == [(1, 4)]
    assert T.find_tables("a, b\nc, d") == [] and T.find_tables("a, b\nc, d", strict=False) == [(0, 2)]
    assert T.find_tables("h,i,j\n1,2,3\n4,5,6\n\nz") == [(0, 3)]
    left, parts = T.peeled("words\n```python\nx = 1\n\ndef f():\n    return 1\n# c\ndef g():\n    return 2\n```\n" + pipe, "H", 3)
    assert left == "words\n\nx\n\ny" or left.split() == ["words", "x", "y"]
    assert [p[0] for p in parts] == ["example"] * 3 + ["table"]
    assert parts[0][2] == "```python\nx = 1\n```" and parts[2][2].startswith("```python\n# c\ndef g")
    assert parts[3][2] == "Table: H (from 1 to 1: 1 rows)\n\n| a | b |\n| --- | --- |\n| 1 | 2 |"


def test_split_table():
    rows = ["k,v"] + [f"{i},{'w ' * 9}w" for i in range(60)]
    parts = T.split_table(rows, 490, 900)
    assert len(parts) == 2 and [len(p[0]) for p in parts] == [31, 31]
    many = T.split_table(["k,v"] + ["a b c"] * 600, 490, 900)
    assert sum(len(p[0]) - 1 for p in many) == 600 and all(p[1] <= 490 and p[0][0] == "k,v" for p in many)
    assert T.split_table(["h"] + ["w " * 600] + ["x"], 490, 900)[0][2] is True


def test_pipes_to_csv():
    assert run(T.pipes_to_csv, "| a |  |\n|---|---|\n| x, y | p\\|q |") == '<!-- Data Table -->\na,Column 2\n"x, y",p|q'
    assert run(lambda ls: T.move_tables_to_end(ls, "S"), "# S\n| a | b |\n|---|---|\n| 1 | 2 |\ntext\n# Z") == "# S\ntext\n| a | b |\n|---|---|\n| 1 | 2 |\n\n# Z"


def test_toc():
    assert toc.key_of("1.2 A guide") == "a guide" and toc.key_of("Mix it") == "mix it" and toc.key_of("IV. Ends") == "ends"
    lines = "Intro\ntext\nSetup guides\nIntro".split("\n")
    assert toc.aligned(lines, [(1, "Intro"), (2, "Setup guide"), (2, "Never"), (1, "Intro")], 0.9) == ["# Intro", "text", "## Setup guide", "Intro"]


def test_best_level(spark):
    contents = spark.createDataFrame([(1, "Intro"), (3, "Intro"), (2, "Setup guide")], "level int, title string")
    titles = spark.createDataFrame([("1. Intro",), ("Setup guides",), ("zzz",)], "title string")
    assert {r.title: r.level for r in toc.best_level(titles, contents).collect()} == {"1. Intro": 1, "Setup guides": 2, "zzz": None}
    marks = toc.inserted_levels(spark.createDataFrame([(1, 0, 2, "a"), (1, 1, 1, "b"), (1, 2, 3, "c")], "doc_id long, pos int, level int, title string"))
    assert [r.insert_h1 for r in marks.orderBy("pos").collect()] == [True, False, True]


def test_the_gate_opens_by_front_matter(spark):
    body = "# T\n## H\ntext of more than thirty characters here\n* one\n* two"
    rows = [(1, "---\ncategory: Adobe Connect\n---\n" + body), (2, body), (3, "---\nother: adobe connect\n---\n" + body), (4, None)]
    got = {r.k: r.text for r in C.clean(spark.createDataFrame(rows, "k int, text string")).collect()}
    assert "\n\n- one\n\n- two" in got[1] and "* one\n* two" in got[2] and "* one" in got[3] and got[4] is None


def test_front_matter_is_no_content(spark):
    from docquarry.operators import headings

    rows = headings.chunks(spark.createDataFrame([(1, "a.md", "---\n# not a heading: x\ntitle: t\n---\n# A\nbody")], "doc_id long, filename string, text string")).collect()
    assert [(r.heading, r.content) for r in rows] == [("A", "body")]


@pytest.mark.parametrize(("code", "language", "want"), [
    ('"a": 1, "b": {"c": [1]},', "json", '"a": 1,\n"b": {\n  "c": [\n    1\n  ]\n},'),
    ("a {\n    color: red;\n}\nb {\ncolor: '}';\n}", "css", "a {\n  color: red;\n}\nb {\n  color: '}';\n}"),
    ("int f() {\nif (x) {\nreturn 1; // }\n} else {\nreturn 2;\n}\n}", "cpp", "int f() {\n  if (x) {\n    return 1; // }\n  } else {\n    return 2;\n  }\n}"),
    ("int f() {\n  broken", "cpp", "int f() {\n  broken"), ("let a = `{\n  x`;", "javascript", "let a = `{\n  x`;"),
    ("<MIFFile 7.00> # v\n<Para <PgfTag `a > b'> <ParaLine <String `x'> > # end\n>", "mif", "<MIFFile 7.00>\n# v\n<Para\n  <PgfTag `a > b'>\n  <ParaLine\n    <String `x'>\n  > # end\n>"),
])
def test_code_is_formatted(code, language, want):
    assert C.guess_language(code) in (language, "") and C.guess_language(code, language) == language
    assert C.format_code(code, language) == want and C.format_code(want, language) == want


def test_numbered_headings_of_blank_and_fenced_lines_match_the_sql(spark, tmp_path):
    import duckdb

    from docquarry.plans import registry

    texts = [None, "", "a\n```\n## 1 b\nc\nd\ne\n```\n# 2. f", "\n\n\n\n\n \n", "\x0bx\n1\n2\n3\n4\n y", "5. five\n### 1.1 x", "\tz\r", "# 3 # 4\n\n\n\n\n12) x"]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    got = {r.doc_id: r.text for r in registry.queries()["strip_numbering"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert got == dict(con.execute(registry.oracle_sql()["strip_numbering"]).fetchall())
