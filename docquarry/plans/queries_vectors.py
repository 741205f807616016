"""Queries on embeddings, upserts, provenance, evaluation and relational previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.functions import vectors as V
from docquarry.operators import filters, summaries
from docquarry.operators import vector_table as VT

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


SIDE = """side AS (SELECT 'c' || (vec_id - CASE WHEN vec_id % 50 = 49 THEN 1 ELSE 0 END) AS id, CASE WHEN vec_id % 9 = 0 THEN [] ELSE embedding END AS embedding, vec_id AS pos FROM embeddings),
last AS (SELECT id, arg_max(embedding, pos) AS embedding FROM side GROUP BY id),
chunks AS (SELECT 'c' || doc_id AS id, source FROM documents)"""


def sidecar(spark, d):
    """A vector for each id, for one in fifty another that comes later."""
    e = table(spark, d, "embeddings")
    return e.select(F.concat(F.lit("c"), (F.col("vec_id") - (F.col("vec_id") % 50 == 49).cast("int")).cast("string")).alias("id"), F.when(F.col("vec_id") % 9 == 0, F.array().cast("array<float>")).otherwise(F.col("embedding")).alias("embedding"), F.col("vec_id").alias("pos"))


def merged(spark, d):
    chunks = table(spark, d, "documents").select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("id"), "source")
    return VT.merge_embeddings(chunks, sidecar(spark, d))


@query("embedding_merge", f"WITH {SIDE} SELECT id, source, CASE WHEN len(embedding) > 0 THEN round(embedding[1]::DOUBLE, 6) ELSE 9 END AS first_component, CASE WHEN len(embedding) > 0 THEN len(embedding) ELSE 0 END AS dim FROM chunks LEFT JOIN last USING (id)")
def embedding_merge(spark, d):
    return merged(spark, d).select("id", "source", F.coalesce(F.round(F.get("embedding", F.lit(0)).cast("double"), 6), F.lit(9.0)).alias("first_component"), F.when(F.col("embedding").isNotNull(), F.size("embedding").cast("long")).otherwise(0).alias("dim"))


@query("embedding_stats", f"WITH {SIDE} SELECT count(CASE WHEN len(embedding) > 0 THEN 1 END) AS n_embedding, 0::BIGINT AS n_embedding_summary_chunk, 0::BIGINT AS n_embedding_summary_page FROM chunks LEFT JOIN last USING (id)")
def embedding_stats(spark, d):
    return VT.vector_counts(merged(spark, d))


@query("vector_dim", "SELECT min(len(embedding))::INTEGER AS least_dim, max(len(embedding))::INTEGER AS most_dim, count(embedding) AS n_vectors, CASE WHEN min(len(embedding)) = max(len(embedding)) THEN min(len(embedding)) END::INTEGER AS dim FROM embeddings")
def vector_dim(spark, d):
    return VT.vector_dimension(table(spark, d, "embeddings"))


COS = "list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) / (sqrt(list_inner_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_inner_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[])))"


@query("cosine_topk", f"""WITH c AS (SELECT q.vec_id AS query_id, v.vec_id, {COS} AS s FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM c) SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(s, 6) AS similarity FROM r WHERE rank <= 10""")  # fmt: skip
def cosine_topk(spark, d):
    """Every row whose id is divisible by 20 as a query, exactly, over every vector."""
    e = table(spark, d, "embeddings")
    return VT.cosine_top_k(e.where("vec_id % 20 = 0"), e).withColumn("similarity", F.round("similarity", 6))


@query("l2_normalize", "SELECT vec_id, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS norm_before, 1.0::DOUBLE AS norm_after FROM embeddings")
def l2_normalize(spark, d):
    v = V.l2_normalised(F.col("embedding"))
    return table(spark, d, "embeddings").select("vec_id", F.round(V.norm(F.col("embedding")), 5).alias("norm_before"), F.round(V.norm(v), 5).alias("norm_after"))


@query("valid_embeddings", "SELECT vec_id FROM embeddings WHERE vec_id % 7 <> 0")
def valid_embeddings(spark, d):
    e = table(spark, d, "embeddings")
    rows = e.select("vec_id", F.col("vec_id").cast("string").alias("id"), F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 3)).otherwise(F.col("embedding")).alias("embedding"))
    return VT.valid_embeddings(rows, 64).select("vec_id")


@query("vector_slices", "SELECT vec_id, array_to_string(list_transform(embedding[1:5], lambda x: CAST(CAST(round(x::DOUBLE * 1000) AS BIGINT) AS VARCHAR)), ' ') AS head FROM embeddings")
def vector_slices(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.array_join(F.transform(F.slice("embedding", 1, 5), lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string")), " ").alias("head"))


@query("embeddable_chunks", "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0")
def embeddable_chunks(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(False)).when(F.col("doc_id") % 3 == 1, F.lit(True)).alias("embed"))
    return filters.embeddable(rows).select("doc_id")


@query("chunks_with_id", "SELECT doc_id FROM documents WHERE doc_id % 5 > 1")
def chunks_with_id(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 > 1, F.col("doc_id").cast("string")).alias("id"))
    return filters.with_id(rows).select("doc_id")


@query("embed_counters", "SELECT count(*) AS total, count(*) FILTER (n_chars > 500) AS embedded, count(*) FILTER (NOT n_chars > 500) AS skipped FROM documents")
def embed_counters(spark, d):
    long = F.col("n_chars") > 500
    return table(spark, d, "documents").agg(F.count("*").alias("total"), F.count_if(long).alias("embedded"), F.count_if(~long).alias("skipped"))


@query("distinct_text_encoding", "SELECT d.doc_id, len(d.source) AS k FROM documents d")
def distinct_text_encoding(spark, d):
    """Each distinct text is encoded once and fanned out; the stand-in for a vector is the text's length."""
    made = VT.distinct_encoded(table(spark, d, "documents").select("doc_id", "source"), "source", lambda t: t.withColumn("vector", F.char_length("text").cast("long")), "k")
    return made.select("doc_id", "k")


@query("upsert_latest_wins", """WITH old AS (SELECT doc_id AS id, lang, 0::BIGINT AS version FROM documents WHERE doc_id % 2 = 0),
new AS (SELECT doc_id // 3 AS id, arg_max(source, doc_id) AS lang, max(doc_id) AS version FROM documents GROUP BY 1)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE id NOT IN (SELECT id FROM new)""")  # fmt: skip
def upsert_latest_wins(spark, d):
    docs = table(spark, d, "documents")
    old = docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("id"), "lang", F.lit(0).cast("long").alias("version"))
    new = docs.select(F.floor(F.col("doc_id") / 3).cast("long").alias("id"), F.col("source").alias("lang"), F.col("doc_id").alias("version"), F.col("doc_id").alias("at"))
    return VT.upsert(old, new, "id", "at")


@query("provenance_upsert", """WITH p AS (SELECT 'prov_' || substr(sha1(lang || '|' || source), 1, 12) AS prov_id, lang AS chunk_model, source AS embed_model, max(doc_id) AS version FROM documents GROUP BY lang, source)
SELECT prov_id, chunk_model, embed_model, version FROM p""")  # fmt: skip
def provenance_upsert(spark, d):
    rows = table(spark, d, "documents").select(VT.provenance_id([F.col("lang"), F.col("source")]).alias("prov_id"), F.col("lang").alias("chunk_model"), F.col("source").alias("embed_model"), F.col("doc_id").alias("version"), F.col("doc_id").alias("at"))
    return VT.upsert(rows.drop("at").limit(0), rows, "prov_id", "at")


@query("delete_by_id", "SELECT doc_id, lang FROM documents WHERE doc_id % 10 <> 4")
def delete_by_id(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return VT.delete_ids(docs, docs.where("doc_id % 10 = 4"), "doc_id")


@query("stamped_provenance", "SELECT doc_id, 'prov_x' AS prov_id FROM documents")
def stamped_provenance(spark, d):
    return VT.stamped(table(spark, d, "documents").select("doc_id", F.col("source").alias("prov_id")), spark.createDataFrame([("prov_x",)], "prov_id string"))


@query("flat_provenance", "SELECT 'p' || n_nationkey AS prov_id, TIMESTAMP '2024-01-02 03:04:05' AS created_at, n_name AS chunk_model, '1-500' AS chunk_size_range, 0.5::DOUBLE AS keyword_density, n_name AS summary_model, 'x' AS summary_prompt, NULL::INTEGER AS summary_size, NULL::DOUBLE AS summary_temperature, 'e' AS embed_model, 64 AS embed_vectorsize FROM nation")
def flat_provenance(spark, d):
    n = F.col("n_name")
    nested = table(spark, d, "nation").select(
        F.concat(F.lit("p"), F.col("n_nationkey").cast("string")).alias("prov_id"), F.to_timestamp(F.lit("2024-01-02 03:04:05")).alias("timestamp"),
        F.struct(n.alias("model"), F.lit("1-500").alias("chunk_size_range"), F.lit(0.5).alias("keyword_density")).alias("chunk"),
        F.struct(n.alias("model"), F.lit("x").alias("prompt"), F.lit(None).cast("int").alias("size"), F.lit(None).cast("double").alias("temperature")).alias("summary"),
        F.struct(F.lit("e").alias("model"), F.lit(64).alias("vectorsize")).alias("embed"),
    )
    return VT.flat_provenance(nested)


@query("three_way_join_preview", """WITH c AS (SELECT 'c' || doc_id AS id, 'prov_' || (doc_id % 3) AS prov_id FROM documents), p AS (SELECT DISTINCT 'prov_' || (doc_id % 2) AS prov_id FROM documents), v AS (SELECT 'c' || vec_id AS id, embedding FROM embeddings)
SELECT id, prov_id, array_to_string(list_transform(embedding[1:5], lambda x: CAST(CAST(round(x::DOUBLE * 1000) AS BIGINT) AS VARCHAR)), ' ') AS head FROM c JOIN p USING (prov_id) JOIN v USING (id) ORDER BY id LIMIT 3""")  # fmt: skip
def three_way_join_preview(spark, d):
    """The first chunks with their provenance and the start of their vectors; a chunk whose provenance is not there has no row."""
    rows = table(spark, d, "documents")
    prov = lambda n: F.concat(F.lit("prov_"), (F.col("doc_id") % n).cast("string")).alias("prov_id")
    chunks = rows.select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("id"), prov(3))
    vectors = table(spark, d, "embeddings").select(F.concat(F.lit("c"), F.col("vec_id").cast("string")).alias("id"), "embedding")
    made = VT.three_way_preview(chunks, rows.select(prov(2)).distinct(), vectors)
    return made.select("id", "prov_id", F.array_join(F.transform("head", lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string")), " ").alias("head"))


@query("examples_attached", """WITH kids AS (SELECT l_orderkey, string_agg(l_orderkey || '-' || l_linenumber, ',' ORDER BY l_linenumber) AS examples FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(examples, '') AS examples FROM orders LEFT JOIN kids ON o_orderkey = l_orderkey""")  # fmt: skip
def examples_attached(spark, d):
    """Parents with the ids of their children in order."""
    kids = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id")))).alias("k"))
    joined = table(spark, d, "orders").select("o_orderkey").join(kids, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", F.coalesce(F.array_join(F.transform("k", lambda x: x["id"]), ","), F.lit("")).alias("examples"))


@query("eval_trimmed_mean", """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.2), 6) AS percentile, round(avg(value) FILTER (i > floor(n * 0.1) AND i <= n - floor(n * 0.1)), 6) AS trimmed FROM r GROUP BY event_type""")  # fmt: skip
def eval_trimmed_mean(spark, d):
    out = summaries.trimmed_mean(table(spark, d, "events"), "value", "event_type")
    return out.select("event_type", *(F.round(c, 6).alias(c) for c in ("mean", "percentile", "trimmed")))


@query("eval_minmax", "SELECT round(avg(value), 6) AS avg_value, min(value) AS min_value, max(value) AS max_value FROM events")
def eval_minmax(spark, d):
    return summaries.score_range(table(spark, d, "events"), "value").withColumn("avg_value", F.round("avg_value", 6))


@query("eval_consistency", "SELECT event_id, round(greatest(value, 3.0) - greatest(value / 2, 1.0), 6) AS score FROM events")
def eval_consistency(spark, d):
    entail, contradict = F.array(F.array("value", F.lit(3.0))), F.array(F.array(F.col("value") / 2, F.lit(1.0)))
    return table(spark, d, "events").select("event_id", F.round(summaries.consistency(entail, contradict)[0], 6).alias("score"))


@query("scorable_summaries", "SELECT doc_id FROM documents WHERE doc_id % 4 IN (2, 3)")
def scorable_summaries(spark, d):
    s = F.when(F.col("doc_id") % 4 == 0, "").when(F.col("doc_id") % 4 == 1, "[ERROR] none").when(F.col("doc_id") % 4 == 2, "[note] fine").otherwise("fine")
    return filters.scorable(table(spark, d, "documents").select("doc_id", s.alias("chunk_summary"))).select("doc_id")


#: The stand-in's answer: the first twelve words after the prompt's last blank line.
STUB = "array_to_string(list_slice(regexp_extract_all(list_extract(string_split({}, chr(10) || chr(10)), -1), '\\S+'), 1, 12), ' ')"


@query("summaries_made", f"SELECT doc_id, CASE WHEN len(regexp_extract_all(coalesce(text, ''), '\\S+')) >= 50 THEN {STUB.format('text')} ELSE '' END AS chunk_summary FROM documents")
def summaries_made(spark, d):
    """Summaries by the stand-in model for all documents of 50 tokens or more."""
    from docquarry.functions.text import token_count

    rows = table(spark, d, "documents").select("doc_id", F.lit("Docs").alias("concat_header_path"), F.col("text").alias("content"), F.lit("").alias("chunk_summary"), token_count(F.col("text")).alias("token_count"))
    return summaries.summarise(rows).select("doc_id", "chunk_summary")


@query("stub_embeddings")
def stub_embeddings(spark, d):
    """Vectors by the stand-in encoder for the distinct sources, fanned out to all documents."""
    return VT.distinct_encoded(table(spark, d, "documents").select("doc_id", "source"), "source", summaries.encode, "embedding")


@query("page_summary_members", f"""WITH c AS (SELECT doc_id, source AS filename, lang AS root_id, 'd' || doc_id AS id, n_chars, substr(coalesce(text, ''), 1, 30) AS head FROM documents),
p AS (SELECT filename, root_id, string_agg('- ' || head, chr(10) ORDER BY doc_id) FILTER (head <> '') AS page_text FROM c GROUP BY 1, 2)
SELECT c.doc_id, CASE WHEN coalesce(page_text, '') = '' THEN '' ELSE {STUB.format('page_text')} END AS page_summary FROM c JOIN p USING (filename, root_id)""")  # fmt: skip
def page_summary_members(spark, d):
    """Documents of a source and language as members of a page, each with the page's summary."""
    rows = table(spark, d, "documents").select("doc_id", F.col("source").alias("filename"), F.col("lang").alias("root_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("doc_id").alias("ord"), F.lit("").alias("content"), F.substring(F.coalesce("text", F.lit("")), 1, 30).alias("chunk_summary"))
    return summaries.page_summaries(rows).select("doc_id", "page_summary")


@query("code_summaries", f"SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND coalesce(text, '') <> '' THEN {STUB.format('text')} ELSE 'kept' END AS chunk_summary FROM documents")
def code_summaries(spark, d):
    code = (F.col("doc_id") % 3 == 0) & (F.coalesce("text", F.lit("")) != "")
    rows = table(spark, d, "documents").select("doc_id", F.lit("Docs").alias("concat_header_path"), F.col("text").alias("content"), F.when(code, "example").otherwise("heading").alias("chunk_type"), F.when(code, "").otherwise("kept").alias("chunk_summary"))
    return summaries.code_summaries(rows).select("doc_id", "chunk_summary")


@query("summary_scores", """WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '\\S+')) AS words, list_distinct(regexp_extract_all(lower('zz ' || lang || ' ' || substr(text, 1, 60)), '\\S+')) AS s FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL)
SELECT doc_id, round(len(list_intersect(s, words)) / len(s), 6) AS score FROM w""")  # fmt: skip
def summary_scores(spark, d):
    rows = table(spark, d, "documents").where("text is not null and lang is not null").select("doc_id", F.col("text").alias("content"), F.concat(F.lit("zz "), "lang", F.lit(" "), F.substring("text", 1, 60)).alias("chunk_summary"))
    return summaries.scored(rows).select("doc_id", F.round("score", 6).alias("score"))


@query("dimension_check", "SELECT min(len(embedding))::INTEGER AS dim FROM embeddings HAVING min(len(embedding)) = max(len(embedding))")
def dimension_check(spark, d):
    """The vectors' one dimension, which must be the configured one."""
    e = table(spark, d, "embeddings")
    dim = VT.checked_dimension(e, e.select(F.size("embedding").alias("n")).first().n)
    return spark.createDataFrame([(dim,)], "dim int")


@query("table_evolved", "SELECT doc_id AS id, lang, CASE WHEN doc_id % 2 = 0 THEN source END AS source FROM documents")
def table_evolved(spark, d):
    """Rows of before a column was there, and of after."""
    rows = table(spark, d, "documents")
    old, new = rows.where("doc_id % 2 = 1").select(F.col("doc_id").alias("id"), "lang"), rows.where("doc_id % 2 = 0").select(F.col("doc_id").alias("id"), "lang", "source")
    return VT.evolved(old, new.schema).unionByName(new)


@query("vector_index")
def vector_index(spark, d):
    """Every row whose id is divisible by 20 against an inverted-file index of all rows: approximate, so without SQL; a test measures its recall."""
    from docquarry.operators import vector_index as VI

    e = table(spark, d, "embeddings")
    return VI.search(VI.build(e), e.where("vec_id % 20 = 0"))
