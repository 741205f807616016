import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.operators import codenames, filters, summaries
from docquarry.operators import vector_index as VI
from docquarry.operators import vector_table as VT
from docquarry.plans import config, flow, registry

DATA = "/root/testdata/sf0.001"


def test_upsert_and_merge(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    new = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", None, 1), (None, 9, 1), ("", 9, 1)], "id string, v int, at int")
    assert sorted(map(tuple, VT.upsert(old, new, "id", "at").collect())) == [("a", 1), ("b", 4), ("c", None)]
    chunks = spark.createDataFrame([("a",), ("b",), ("z",)], "id string").withColumn("embedding", F.array(F.lit(7.0)).cast("array<float>"))
    side = spark.createDataFrame([("a", [1.0], 0), ("a", [2.0], 1), ("b", [], 0)], "id string, embedding array<float>, pos int")
    got = {r.id: r.embedding for r in VT.merge_embeddings(chunks, side).collect()}
    assert got == {"a": [2.0], "b": None, "z": [7.0]}


def test_dimension_and_top_k(spark):
    rows = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(9)] + [(9, [0.0, 0.0]), (10, None)], "vec_id long, embedding array<float>")
    assert VT.vector_dimension(rows).first().dim == 2
    got = [(r["rank"], r.vec_id) for r in VT.cosine_top_k(rows.where("vec_id = 0"), rows, 3).orderBy("rank").collect()]
    assert got == [(1, 3), (2, 6), (3, 1)]


def test_dictionary_prefers_the_longest(spark):
    df = spark.createDataFrame([(1, "FooBar Foo"), (2, "none"), (3, None)], "k int, text string")
    got = {r.k: r.names for r in codenames.enrich(df, {"Foo": "short", "FooBar": "long"}, "k").collect()}
    assert got == {1: "long; short", 2: None, 3: None}
    names = spark.createDataFrame([("see Constants.FV_FooBar and BigName, FTI_ONE, F_ApiGetId, F_TextLocT, FCodes.KBD_A",)], "t string").select(codenames.camel_names(F.col("t")).alias("c"), codenames.prefixed_names(F.col("t")).alias("p")).first()
    assert names.c == ["BigName"] and names.p == ["Constants.FV_FooBar", "FTI_ONE", "F_ApiGetId", "F_TextLocT", "FCodes.KBD_A"]


def test_filters(spark):
    pages = spark.createDataFrame([("https://a.b:80/x/",), ("https://u@c/y",)], "url string")
    assert [r.url for r in filters.in_domains(pages, ["a.b:80"]).collect()] == ["https://a.b:80/x/"]
    urls = spark.createDataFrame([(1, "http://h/a.md"), (2, "http://k/a.html"), (3, "http://h/a.md#x"), (4, "http://h/")], "page_id long, url string")
    got = {r.url: r.filename for r in filters.page_files(urls).collect()}
    assert got["http://h/a.md"] == "a.md" and got["http://k/a.html"].startswith("a-") and got["http://h/"] == "index.md" and len(got) == 3
    marks = spark.createDataFrame([("", 10), ("x" * 10, 60), (None, 60)], "chunk_summary string, token_count int")
    assert [r.action for r in filters.to_summarise(marks).collect()] == ["empty", "keep", "summarise"]


def test_summaries(spark):
    assert summaries.run_backend("stub", "p\n\na b", wait=lambda s: None) == "a b"
    calls = []

    def broken(prompt):
        calls.append(prompt)
        raise OSError

    summaries.BACKENDS["broken"] = broken
    waits = []
    assert summaries.run_backend("broken", "p", wait=waits.append) == "" and len(calls) == 4 and waits == [2, 4, 8]
    rows = spark.createDataFrame([("P", "", None, "text", 10), ("P", "", None, "P\n\ntext", 10), ("P", "", None, "text", 200)], "concat_header_path string, page_summary string, chunk_summary string, content string, token_count int")
    assert [r.content for r in summaries.small_chunk_prefix(rows).collect()] == ["P\n\ntext", "P\n\ntext", "text"]
    stats = summaries.trimmed_mean(spark.createDataFrame([("a", float(v)) for v in [100, *range(1, 10)]], "k string, v double"), "v", "k").first()
    assert stats.trimmed == pytest.approx(5.5) and stats["mean"] == pytest.approx(14.5)


def test_flow(spark):
    files = spark.createDataFrame([(1, "a.md", "x\n# Top\n" + "word " * 60 + "\n## Sub FooBar\nshort text of at least thirty characters")], "doc_id long, filename string, text string")
    meta = config.RunMetadata(id="m", title="T")
    out = flow.embed(flow.build(files, meta, dictionary={"FooBar": "foo bar"})).collect()
    assert {r.header_level for r in out} == {1, 2} and all(len(r.embedding) == 64 and r.title == "T" and r.prov_id.startswith("prov_") for r in out)
    with pytest.raises(ValueError):
        config.RunMetadata(id="m", parser="crawlpdf", url="https://x")


def same(a, b):
    a, b = a[sorted(a.columns)].astype(str), b[sorted(b.columns)].astype(str)
    return sorted(map(tuple, a.itertuples(index=False))) == sorted(map(tuple, b.itertuples(index=False)))


@pytest.mark.parametrize("name", ["chunk_headings", "page_rollup", "codename_frequency", "upsert_latest_wins", "page_filename_dedupe", "title_levels", "kept_pages", "cosine_topk"])
def test_queries_match_their_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "events", "nation", "orders", "customer", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    assert same(registry.queries()[name](spark, DATA).toPandas(), con.execute(registry.oracle_sql()[name]).df())


def test_exact_search_in_blocks(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((60, 4)))], "vec_id long, embedding array<double>")
    asked = rows.where("vec_id % 3 = 0")
    one, many = (sorted(map(tuple, VT.cosine_top_k(asked, rows, 4, block=b).collect())) for b in (10_000, 16))
    assert one == many and len(one) == 80


def test_vector_index_recall_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 12))
    v = centres[rng.integers(0, 20, 3000)] + 0.3 * rng.standard_normal((3000, 12))
    rows = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(5000, None), (5001, [0.0] * 12), (5002, [])], "vec_id long, embedding array<double>")
    index = VI.build(rows, cells=30)
    asked = rows.where("vec_id % 20 = 0")
    got = {(r.query_id, r.vec_id) for r in VI.search(index, asked, probes=6).collect()}
    want = {(r.query_id, r.vec_id) for r in VT.cosine_top_k(asked, rows).collect()}
    assert index.rows.count() == 3000 and len(got & want) >= 0.9 * len(want)
    whole = {(r.query_id, r.vec_id) for r in VI.search(index, asked, probes=30).collect()}
    assert len(whole & want) >= 0.99 * len(want)  # the index holds unit vectors, so near ties may change places
    assert VI.search(VI.build(rows.limit(0)), asked).count() == 0


def test_dimensions_are_checked(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("b", None)], "id string, embedding array<float>")
    assert VT.checked_dimension(rows, 2) == 2 and VT.checked_dimension(rows, 3, fail=False) is None
    with pytest.raises(ValueError):
        VT.checked_dimension(rows, 3)
    with pytest.raises(ValueError):
        VT.require_vectors(rows.where("embedding is null"))
    assert VT.reconciled(rows.limit(0), 5).columns == ["id", "embedding", "embedding_summary_chunk", "embedding_summary_page"]
    with pytest.raises(ValueError):
        VT.reconciled(rows, 5)
    with pytest.raises(TypeError):
        VT.evolved(rows, spark.createDataFrame([], "id long").schema)


def test_page_summaries_reach_their_members(spark):
    rows = spark.createDataFrame([("f", "r", "r", 0, "top text", ""), ("f", "r", "c", 1, "x", "child one"), ("f", None, "z", 2, "y", "")], "filename string, root_id string, id string, ord int, content string, chunk_summary string")
    got = {r.id: r.page_summary for r in summaries.page_summaries(rows).collect()}
    assert got == {"r": "top text - child one", "c": "top text - child one", "z": ""}


def test_trimmed_means_against_brute_force(spark):
    rng = np.random.default_rng(9)
    values = [("a", float(x)) for x in rng.integers(0, 7, 501)] + [("b", float(x)) for x in rng.standard_normal(83)] + [("c", 1.0), ("a", None)]
    df = spark.createDataFrame(values, "k string, v double")
    for share in (0.0, 0.1, 0.3, 0.5):
        for r in summaries.trimmed_mean(df, "v", "k", share).collect():
            x = np.sort([v for k, v in values if k == r.k and v is not None])
            cut = int(len(x) * share)
            want = np.median(x) if share >= 0.5 else x[cut : len(x) - cut].mean() if 2 * cut < len(x) else x.mean()
            assert r.trimmed == pytest.approx(want) and r["mean"] == pytest.approx(x.mean()) and r.percentile == pytest.approx(np.quantile(x, 0.2))


def test_exact_search_is_by_matrices_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    made = [(int(i), [float(x) for x in rng.integers(0, 3, 3)]) for i in range(500)] + [(7, [1.0, 2.0]), (600, [float("nan"), 1.0, 1.0]), (601, [1.0, None, 1.0]), (602, None), (603, [1e-170, 0.0, 0.0])]
    rows = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    found = VT.cosine_top_k(rows.where("vec_id % 20 = 0"), rows)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()  # pairs were scored one by one in interpreted lambdas
    pairs = rows.alias("v").crossJoin(rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))).where("vec_id <> query_id")
    want: dict = {}
    for r in pairs.select("query_id", "vec_id", VT.V.cosine(F.col("q"), F.col("embedding")).alias("s")).where("s is not null").collect():
        want.setdefault(r.query_id, []).append((0 if np.isnan(r.s) else 1, -r.s if not np.isnan(r.s) else 0, r.vec_id))
    want = {(q, n + 1, v) for q, near in want.items() for n, (_, _, v) in enumerate(sorted(near)[:10])}
    assert {(r.query_id, r["rank"], r.vec_id) for r in found.collect()} == want


def test_index_search_is_by_matrices_in_blocks(spark):
    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(np.r_[rng.standard_normal((300, 4)), np.ones((100, 4))])], "vec_id long, embedding array<double>")
    index, asked = VI.build(rows, cells=4), rows.where("vec_id % 20 = 0")
    one, many = (VI.search(index, asked, probes=2, block=b) for b in (10_000, 40))
    assert "SortMergeJoin" not in one._jdf.queryExecution().toString()
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and one.count() == 200
