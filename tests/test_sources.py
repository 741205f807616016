import pytest
from pyspark.sql import functions as F

from docquarry.sources import crawl, documents, files
from docquarry.streaming import ingest

SITE = {
    "http://s/robots.txt": "User-agent: *\nSitemap: http://s/extra.xml",
    "http://s/sitemap.xml": "<sitemapindex xmlns='x'><sitemap><loc>http://s/sub.xml</loc></sitemap></sitemapindex>",
    "http://s/sub.xml": "<urlset xmlns='x'><url><loc> http://s/a </loc></url><url><loc>http://other/b</loc></url></urlset>",
    "http://s/extra.xml": "<urlset><url><loc>http://s/c</loc></url><url><loc>http://s/a</loc></url></urlset>",
    "http://s/": "<a href='/a'>a</a><a href='http://other/x'>x</a>",
    "http://s/a": "<h1>A</h1><a href=\"/c#top\">c</a>",
    "http://s/c": "<p>end</p>",
}


def test_sitemaps_and_crawl(spark):
    site = dict(SITE)
    assert sorted(r.url for r in crawl.discover(spark, "http://s", lambda u: site.get(u)).collect()) == ["http://s/a", "http://s/c"]
    got = {r.url: (r.depth, r.success) for r in crawl.deep_crawl(spark, ["http://s/"], lambda u: site.get(u), ["s"], depth=2).collect()}
    assert got == {"http://s/": (0, True), "http://s/a": (1, True), "http://s/c": (2, True)}


def test_html_to_markdown():
    page = "<html><head><script>x</script></head><nav>n</nav><h2>T&amp;U</h2><ul><li>a<ul><li>b</li></ul></li></ul><p>x <b>y</b><img src=q></p><pre>k\n  v</pre><a href='/z'>w</a></html>"
    assert crawl.html_to_markdown(page) == "## T&U\n\n- a\n\n  - b\n\nx **y**\n\n```\nk\n  v\n```\n\n[w](/z)"
    assert crawl.html_to_markdown("") == "" and crawl.html_to_markdown("<p>a<p>b") == "a\n\nb"


def test_markdown_trees(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "b.md").write_text("# B")
    (tmp_path / "a.md").write_text("# A")
    (tmp_path / "c.mdx").write_text("# C")
    (tmp_path / "x.txt").write_text("no")
    root = str(tmp_path)
    assert sorted(map(tuple, files.read_markdown(spark, root).collect())) == [("a.md", "# A"), ("d/b.md", "# B")]
    assert sorted(r.filename for r in files.read_any_markdown(spark, root).collect()) == ["a.md", "c.mdx", "d/b.md"]
    assert sorted(r.filename for r in documents.list_tree(spark, root).collect()) == ["a.md", "d/b.md"]
    documents.register(spark)
    tree = spark.read.format("docquarry_tree").option("path", root).load()
    assert sorted(map(tuple, tree.collect())) == [("a.md", "# A"), ("d/b.md", "# B")]


def test_chunk_files(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"id": "a", "token_count": 3, "examples": ["x"]}, {"id": "b", "embedding": [1.5]}]')
    rows = files.read_chunks(spark, str(tmp_path / "c.json"))
    assert [(r.id, r.token_count, r.examples, r.embedding) for r in rows.orderBy("id").collect()] == [("a", 3, ["x"], None), ("b", None, None, [1.5])]
    files.write_sidecar(rows, str(tmp_path / "v"), 1)
    side = files.read_sidecar(spark, str(tmp_path / "v"))
    assert [(r.id, r.embedding, r.embedding_summary_page) for r in side.collect()] == [("b", [1.5], None)]
    files.write_chunks(rows, str(tmp_path / "j"), json=True)
    assert "embedding" not in spark.read.json(str(tmp_path / "j")).columns
    (tmp_path / "rules.csv").write_text("pattern,replacement,flags,priority,comment\nb,x,I,20,\na,b,,10,first\n")
    from docquarry.operators.cleaning import apply_rules

    rules = files.read_rules(spark, str(tmp_path / "rules.csv"))
    assert spark.createDataFrame([("aB",)], "t string").select(apply_rules(F.col("t"), rules).alias("t")).first().t == "xx"


def test_parts_and_conversion(spark, tmp_path):
    (tmp_path / "p.pdf").write_bytes(b"one")
    (tmp_path / "q.pdf").write_bytes(b"bad")
    got = {r.filename: r.text for r in documents.converted(spark, str(tmp_path), lambda b: {b"one": "ONE"}[b]).collect()}
    assert got == {"p.pdf": "ONE", "q.pdf": None}
    parts = spark.createDataFrame([(1, 1, "b"), (1, 0, "a")], "doc_id long, part int, text string")
    assert documents.joined_halves(parts).first().text == "a\n\nb"


def test_streaming_ingestion(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.where("doc_id < 50").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        docs.where("doc_id between 40 and 60").write.mode("append").parquet(str(tmp_path / "in"))
    last = spark.read.parquet(str(tmp_path / "out" / "version=1"))
    assert last.groupBy("id").count().where("count > 1").isEmpty() and last.agg(F.max("doc_id")).first()[0] == 60


def test_links_are_resolved(spark):
    cases = {
        "b.html": "https://h/a/b.html", "../x": "https://h/x", "./y/./z": "https://h/a/y/z", "../../../up": "https://h/up", "//o.org/z": "https://o.org/z", "/r?q=1&amp;b": "https://h/r?q=1&b", "?p=2": "https://h/a/c.html?p=2",
        "http://k/l": "http://k/l", "..": "https://h/", "mailto:a@b": None, "javascript:x()": None, "tel:1": None,
    }
    html = "".join(f'<a href="{h}">x</a>' for h in cases)
    df = spark.createDataFrame([("https://h/a/c.html?old=1", html), ("https://bare", '<a href="x">')], "url string, html string")
    got = sorted(r.target for r in crawl.links(df).collect())
    assert got == sorted([*filter(None, cases.values()), "https://bare/x"])


def test_a_missing_version_is_an_error(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "id string, ord int, v string")
    ingest.merge_batch(spark, root, rows(("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")), 0)
    assert {tuple(r) for r in ingest.current(spark, root, 0).collect()} == {("a", 1, "y"), ("b", 0, "z")}
    with pytest.raises(FileNotFoundError):
        ingest.merge_batch(spark, root, rows(("c", 0, "w")), 2)
    for _ in range(2):
        ingest.merge_batch(spark, root, rows(("b", 5, "new")), 1)
    assert {tuple(r) for r in ingest.current(spark, root).collect()} == {("a", 1, "y"), ("b", 5, "new")}
    assert ingest.manifest(spark, root, 1) != ingest.manifest(spark, root, 0) and 0 in ingest.manifest(spark, root, 1).values()  # what was not touched stays
    ingest.merge_batch(spark, root, rows(), 2)
    assert ingest.current(spark, root).count() == 2 and ingest.versions(spark, root) == [0, 1, 2]


def test_provenance_and_vectors_are_persisted(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    files.write_provenance(spark, {"prov_id": "p", "chunk": {"model": "m"}}, at("0"))
    files.update_provenance(spark, at("0"), "embed", {"vector_dim": 2}, at("1"))
    assert files.update_provenance(spark, at("1"), "embed", {"model": "e"}, at("2")) == {"prov_id": "p", "chunk": {"model": "m"}, "embed": {"vector_dim": 2, "model": "e"}}
    assert files.update_provenance(spark, at("none"), "embed", {"a": 1}, at("3")) == {"embed": {"a": 1}}
    with pytest.raises(FileNotFoundError):
        files.update_provenance(spark, at("none"), "embed", {}, at("4"), required=True)
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("b", None)], "id string, embedding array<float>")
    assert files.persist_embeddings(rows, at("e"), 2) == 1 and "embedding" not in spark.read.json(at("e") + "/chunks").columns
    assert files.persist_embeddings(rows, at("f"), 2, sidecar=False) == 1 and "embedding" in spark.read.json(at("f") + "/chunks").columns
    with pytest.raises(ValueError):
        files.persist_embeddings(rows, at("g"), 3)


def test_a_page_that_comes_twice_is_one_file(spark, tmp_path):
    rows = [(1, "https://h/a#x", "<h1>A</h1>", "one"), (2, "https://h/a", "<h1>A</h1>", "two"), (3, "https://h/", "<h1>I</h1>", "root")]
    files.write_pages(spark.createDataFrame(rows, "page_id long, url string, html string, markdown string"), str(tmp_path / "p"))
    got = {r.filename: r.text for r in spark.read.parquet(str(tmp_path / "p")).collect()}
    assert set(got) == {"a.md", "index.md"} and got["a.md"].endswith("one")


def test_selectors_choose_what_is_read():
    page = '<div class="nav x">menu</div><main id="m"><p>one<p>two<div class="ad">buy</div></main><p>out'
    read = crawl.html_to_markdown
    assert read(page, (".ad",), ("#m",)).split() == ["one", "two"]
    assert read(page, ("div.nav", "div.ad")).split() == ["one", "two", "out"] and "menu" in read(page)
    assert read("<article><nav>n</nav>a</article>b", keep=("article",)) == "a"


PDF = rb"""%PDF-1.4
1 0 obj <</Type /Catalog /Outlines 2 0 R>> endobj
2 0 obj <</Type /Outlines /First 3 0 R /Last 5 0 R>> endobj
3 0 obj <</Title (One \(1\)) /Parent 2 0 R /Next 5 0 R /First 4 0 R>> endobj
4 0 obj <</Title (Sub) /Parent 3 0 R>> endobj
5 0 obj <</Title <FEFF00E90032> /Parent 2 0 R /Prev 3 0 R>> endobj"""


def test_bookmarks_and_pdf_stages(spark, tmp_path):
    from docquarry.plans import pdf
    from docquarry.plans.config import PdfConfig

    (tmp_path / "a.pdf").write_bytes(PDF)
    (tmp_path / "bad.pdf").write_bytes(b"nothing")
    rows = documents.bookmarks(spark, str(tmp_path)).orderBy("filename", "pos").collect()
    assert [(r.filename, r.pos, r.level, r.title) for r in rows] == [("a.pdf", 0, 1, "One (1)"), ("a.pdf", 1, 2, "Sub"), ("a.pdf", 2, 1, "\u00e92")]
    convert = lambda b: "One (1)\ntext\nSub\n```json\n{\"a\":1}\n```\n\u00e92\nend" if b.startswith(b"%PDF") else 1 / 0
    got = [(r.heading, r.header_level, r.content) for r in pdf.chunks(spark, str(tmp_path), convert).orderBy("ord").collect()]
    assert got == [("One (1)", 1, "text"), ("Sub", 2, '```json\n{\n  "a": 1\n}\n```'), ("\u00e92", 1, "end")]
    assert pdf.chunks(spark, str(tmp_path), convert, PdfConfig(fix_headings=False, fix_code=False)).count() == 0
    pages = spark.createDataFrame([(i,) for i in range(10)], "page long")
    assert [r.page for r in pdf.kept_pages(spark, pages, PdfConfig(skip_front=2, skip_back=1, skip_ranges=((5, 6),))).orderBy("page").collect()] == [2, 3, 6, 7, 8]


def test_reports_are_ordered(spark, tmp_path):
    from docquarry.operators import headings

    df = spark.createDataFrame([(1, "a.md", "# A\n## B\nx\n## B\n# A\ny z"), (2, "b.md", "# Q\nw")], "doc_id long, filename string, text string")
    files.write_duplicates(headings.duplicate_headings(headings.sections(df)), str(tmp_path / "d"))
    assert [r.value for r in spark.read.text(str(tmp_path / "d")).collect()] == ["a.md |  | H1 A | 2 times, lines 1,5", "a.md | A | H2 B | 2 times, lines 2,4"]
    files.write_token_tree(headings.sections(df).withColumn("token_count", F.lit(3)), str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect())[0].strip().startswith("3")
