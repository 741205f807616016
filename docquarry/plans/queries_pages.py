"""Queries on pages, URLs, filters, dictionaries and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import codenames, filters, tables
from docquarry.sources import crawl

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: A small dictionary for the synthetic prose: frequent words as codes, with plain names.
DICTIONARY = {"The": "opener", "Thea": "opener of a", "Der": "german opener", "Les": "french plural", "El": "spanish opener", "And": "joiner", "Of": "relation", "Oring": "gilding", "Une": "one", "Las": "spanish plural"}
DOMAINS = ["spam-farm.example.org", "ththth.example.net", "m.ththth.example.net"]


def docs(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def pages(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet")


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


@query("page_length_filter", "SELECT doc_id, len(text) AS chars FROM documents WHERE len(text) >= 100 AND len(text) - len(replace(text, chr(10), '')) + 1 >= 2")
def page_length_filter(spark, d):
    return filters.long_enough(docs(spark, d)).select("doc_id", F.char_length("text").cast("long").alias("chars"))


@query("language_filter", "SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def language_filter(spark, d):
    return docs(spark, d).where(F.col("lang") == "en").select("doc_id", "lang")


_MARKED = ", ".join(f"len(list_filter(words, lambda w: w IN ({', '.join(repr(w) for w in words)}))) AS {lang}" for lang, words in T.MARKERS.items())


@query("language_detected", f"WITH c AS (SELECT doc_id, {_MARKED} FROM (SELECT doc_id, regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}]+') AS words FROM documents)) SELECT doc_id, CASE greatest(en, de, fr, es) WHEN 0 THEN 'und' WHEN en THEN 'en' WHEN de THEN 'de' WHEN fr THEN 'fr' ELSE 'es' END AS lang FROM c")
def language_detected(spark, d):
    return docs(spark, d).select("doc_id", T.detected_language(F.coalesce("text", F.lit(""))).alias("lang"))


@query("pluggable_token_counts", "SELECT doc_id, CAST(coalesce(len(text) // 4, 0) AS INTEGER) AS tokens FROM documents")
def pluggable_token_counts(spark, d):
    """Any counter can stand in for words; here the usual estimate of four characters a token."""
    return docs(spark, d).select("doc_id", T.counted_tokens(F.col("text"), lambda t: len(t) // 4).alias("tokens"))


URLS = "'^[A-Za-z][A-Za-z0-9+.-]*://"


@query("page_domain", f"SELECT page_id, regexp_extract(url, {URLS}([^/?#]*)', 1) AS domain, regexp_extract(url, {URLS}[^/?#]*([^?#]*)', 1) AS path FROM pages")
def page_domain(spark, d):
    return pages(spark, d).select("page_id", T.authority(F.col("url")).alias("domain"), T.url_path(F.col("url")).alias("path"))


@query("domain_filter", f"SELECT page_id, url FROM pages WHERE regexp_extract(url, {URLS}([^/?#]*)', 1) IN ('{DOMAINS[0]}', '{DOMAINS[1]}', '{DOMAINS[2]}')")
def domain_filter(spark, d):
    return filters.in_domains(pages(spark, d), DOMAINS).select("page_id", "url")


STEM = f"""CASE WHEN regexp_matches(l, '^.+\\.[^.]+$') THEN regexp_replace(l, '\\.[^.]*$', '') ELSE l END"""


@query("page_filename_dedupe", f"""WITH u AS (SELECT regexp_replace(url, '#.*$', '') AS url, min(page_id) AS page_id FROM pages GROUP BY 1),
p AS (SELECT *, regexp_extract(regexp_replace(regexp_extract(url, {URLS}[^/?#]*([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1) AS l FROM u),
s AS (SELECT url, page_id, CASE WHEN {STEM} = '' THEN 'index' ELSE {STEM} END AS stem FROM p)
SELECT url, page_id, CASE WHEN row_number() OVER (PARTITION BY stem ORDER BY page_id, url) = 1 THEN stem || '.md' ELSE stem || '-' || substr(sha1(url), 1, 8) || '.md' END AS filename FROM s""")  # fmt: skip
def page_filename_dedupe(spark, d):
    return filters.page_files(pages(spark, d))


def _decoded(x: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x


@query("page_title", f"""SELECT page_id, nullif(trim(regexp_replace({_decoded("regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')")}, '\\s+', ' ', 'g')), '') AS title FROM pages""")
def page_title(spark, d):
    return pages(spark, d).select("page_id", T.html_title(F.col("html")).alias("title"))


def _stripped() -> str:
    x = "html"
    for tag in ("script", "style", "nav", "footer", "header", "aside"):
        x = f"regexp_replace({x}, '(?is)<{tag}\\b[^>]*>.*?</{tag}>', '', 'g')"
    return f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"


@query("html_strip_blocks", f"SELECT page_id, {_stripped()} AS html FROM pages")
def html_strip_blocks(spark, d):
    return pages(spark, d).select("page_id", T.html_without(F.col("html")).alias("html"))


@query("url_prefix_filter", "SELECT page_id FROM pages WHERE starts_with(url, 'https://spam-farm.example.org/')")
def url_prefix_filter(spark, d):
    return filters.under_prefix(pages(spark, d), "https://spam-farm.example.org").select("page_id")


@query("url_glob_filter", "SELECT page_id FROM pages WHERE regexp_matches(url, '^.*/en/.*$') OR regexp_matches(url, '^http://blog\\..*$')")
def url_glob_filter(spark, d):
    return filters.matching_globs(pages(spark, d), ["*/en/*", "http://blog.*"]).select("page_id")


@query("url_list_lines", "SELECT trim(line) AS url FROM (SELECT CASE page_id % 4 WHEN 0 THEN '# ' || url WHEN 1 THEN '  ' ELSE '  ' || url || ' ' END AS line FROM pages) WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')")
def url_list_lines(spark, d):
    r = F.col("page_id") % 4
    line = F.when(r == 0, F.concat(F.lit("# "), "url")).when(r == 1, "  ").otherwise(F.concat(F.lit("  "), "url", F.lit(" ")))
    return filters.listed_urls(pages(spark, d).select(line.alias("value")))


@query("url_schemes", "SELECT page_id, regexp_matches(url, '^(?:https?://|file://|raw:)') AS fetchable, regexp_replace(url, '#.*$', '') AS url FROM pages")
def url_schemes(spark, d):
    return pages(spark, d).select("page_id", filters.fetchable(F.col("url")).alias("fetchable"), T.without_fragment(F.col("url")).alias("url"))


@query("url_limit", "SELECT page_id, url FROM pages ORDER BY page_id LIMIT 25")
def url_limit(spark, d):
    return filters.within_url_limit(pages(spark, d), 25, "page_id").select("page_id", "url")


@query("git_location", """WITH g AS (SELECT page_id, 'https://git.example.org/' || split_part(split_part(url, '//', 2), '.', 1) || '/repo' || page_id || CASE WHEN page_id % 2 = 0 THEN '.git' ELSE '/tree/dev/docs/a' END AS u, page_id % 2 AS k FROM pages)
SELECT page_id, split_part(u, '/', 4) AS owner, 'repo' || page_id AS repo, CASE k WHEN 0 THEN 'main' ELSE 'dev' END AS branch, CASE k WHEN 0 THEN '' ELSE 'docs/a' END AS subpath FROM g""")  # fmt: skip
def git_location(spark, d):
    owner = F.split_part(F.split_part("url", F.lit("//"), F.lit(2)), F.lit("."), F.lit(1))
    u = F.concat(F.lit("https://git.example.org/"), owner, F.lit("/repo"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".git").otherwise("/tree/dev/docs/a"))
    return pages(spark, d).select("page_id", T.git_location(u).alias("g")).select("page_id", "g.owner", "g.repo", "g.branch", "g.subpath")


@query("sitemap_urls", "SELECT page_id % 10 AS sitemap, count(*) AS n_urls, min(replace(url, '&', '')) AS first_url FROM pages GROUP BY 1")
def sitemap_urls(spark, d):
    """Sitemaps made of the pages, parsed again without regard to their namespace."""
    entry = F.concat(F.lit("<url><loc> "), F.replace("url", F.lit("&"), F.lit("")), F.lit(" </loc></url>"))
    maps = pages(spark, d).groupBy((F.col("page_id") % 10).alias("sitemap")).agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("xml"))
    found = crawl.parsed_sitemaps(maps, "xml").where(F.col("kind") == "urlset")
    return found.select("sitemap", F.explode("locs").alias("url")).groupBy("sitemap").agg(F.count("*").alias("n_urls"), F.min("url").alias("first_url"))


@query("sitemap_union", "WITH a AS (SELECT url, 0 AS list, page_id AS pos FROM pages WHERE page_id % 3 = 0), b AS (SELECT url, 1, page_id FROM pages WHERE page_id % 3 <> 0 OR page_id % 2 = 0) SELECT url, min_by(list, list * 1000000000 + pos) AS list, min_by(pos, list * 1000000000 + pos) AS pos FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY url")
def sitemap_union(spark, d):
    rows = pages(spark, d).select("url", F.col("page_id").alias("pos"))
    return filters.ordered_distinct(rows.where("pos % 3 = 0"), rows.where("pos % 3 <> 0 or pos % 2 = 0"))


@query("kept_pages", "SELECT page_id AS page FROM pages WHERE page_id >= 3 AND page_id < greatest(3, (SELECT max(page_id) + 1 FROM pages) - 5) AND NOT (page_id + 1 BETWEEN 10 AND 20) AND NOT (page_id + 1 BETWEEN 40 AND 45)")
def kept_pages(spark, d):
    ranges = spark.createDataFrame([(20, 10), (40, 45)], "first long, last long")
    return filters.kept_pages(pages(spark, d).select(F.col("page_id").alias("page")), 3, 5, ranges)


@query("crawl_counts", """WITH r AS (SELECT page_id % 11 <> 0 AS success, CASE WHEN page_id % 5 = 0 THEN 'short' ELSE html END AS markdown FROM pages)
SELECT count(*) FILTER (success AND len(markdown) >= 100) AS saved, count(*) FILTER (NOT success) AS failed, count(*) FILTER (success AND len(markdown) < 100) AS skipped, round(count(*) FILTER (success AND len(markdown) >= 100) / count(*), 6) AS save_rate FROM r""")  # fmt: skip
def crawl_counts(spark, d):
    return filters.crawl_counts(pages(spark, d).select((F.col("page_id") % 11 != 0).alias("success"), F.when(F.col("page_id") % 5 == 0, "short").otherwise(F.col("html")).alias("markdown")))


@query("failed_pages", "SELECT page_id, 'error  code ' || page_id AS error FROM pages WHERE page_id % 11 = 0")
def failed_pages(spark, d):
    results = pages(spark, d).withColumn("success", F.col("page_id") % 11 != 0)
    return results.where(~F.col("success")).select("page_id", filters.error_text(F.concat(F.lit("error| code "), F.col("page_id").cast("string"))).alias("error"))


@query("pages_not_done", "SELECT page_id FROM pages WHERE page_id NOT IN (SELECT page_id FROM pages WHERE page_id % 3 = 1)")
def pages_not_done(spark, d):
    return filters.not_done(pages(spark, d).select("page_id"), pages(spark, d).where("page_id % 3 = 1"), "page_id")


@query("front_matter_pages", "SELECT page_id, '---' || chr(10) || 'title: Page ' || page_id || chr(10) || 'source: ' || url || chr(10) || '---' || chr(10) AS block FROM pages")
def front_matter_pages(spark, d):
    return pages(spark, d).select("page_id", T.front_matter({"title": F.concat(F.lit("Page "), F.col("page_id").cast("string")), "author": F.lit(""), "source": F.col("url")}).alias("block"))


@query("forced_h1", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '# Title ' || doc_id || chr(10) || 'x' ELSE '# Title ' || doc_id || chr(10) || chr(10) || 'plain' END AS text FROM documents")
def forced_h1(spark, d):
    body = F.when(F.col("doc_id") % 2 == 0, "\n # Old title\nx").otherwise("plain")
    return docs(spark, d).select("doc_id", T.force_h1(F.regexp_replace(body, r"(?m)^ #", "#"), F.concat(F.lit("Title "), F.col("doc_id").cast("string"))).alias("text"))


@query("html_tables_csv", "SELECT page_id, 'n,url' || chr(10) || page_id || ',\"a, b\"' || chr(10) || 'last,' AS csv FROM pages")
def html_tables_csv(spark, d):
    page = F.concat(F.lit("<p>x</p><TABLE><tr><th>n</th><th>url</th></tr><tr><td>"), F.col("page_id").cast("string"), F.lit("</td><td><b>a,  b</b></td></tr><tr><td>last</td></tr></TABLE>"))
    return pages(spark, d).select("page_id", F.explode(tables.html_tables(page)).alias("csv"))


@query("merged_tags", "SELECT doc_id, lang || ';' || CASE WHEN source <> 'src1' THEN source || ';' ELSE '' END || 'src1' AS tags FROM documents")
def merged_tags(spark, d):
    made = T.merged_tags(F.concat(F.lit(" "), "lang", F.lit(" , "), "source"), F.concat("lang", F.lit(",src1,,")))
    return docs(spark, d).select("doc_id", F.array_join(made, ";").alias("tags"))


@query("merged_title", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 3 = 1 THEN lang || ' - ' || source ELSE source || ' guide' END AS title FROM documents")
def merged_title(spark, d):
    old = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.col("lang")).otherwise(F.concat("source", F.lit(" guide")))
    return docs(spark, d).select("doc_id", T.merged_title(old, F.col("source")).alias("title"))


@query("merged_metadata", """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Guide - Page ' || doc_id ELSE 'Guide' END AS title, CASE WHEN doc_id % 2 = 0 THEN 'about ' || source ELSE 'general' END AS description,
'one, two' || CASE WHEN doc_id % 2 = 0 THEN ', lang=' || lang || ' x' ELSE '' END AS tags, coalesce(text, '') AS body FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL""")  # fmt: skip
def merged_metadata(spark, d):
    rows = docs(spark, d).where("source is not null and lang is not null")
    head = F.concat(F.lit("---\ntitle: Page "), F.col("doc_id").cast("string"), F.lit("\ndescription: about "), "source", F.lit("\nlang: "), "lang", F.lit(",x\nempty: \n---\n"))
    text = F.concat(F.when(F.col("doc_id") % 2 == 0, head).otherwise(""), F.coalesce("text", F.lit("")))
    return rows.select("doc_id", T.merged_metadata(text, F.lit("Guide"), F.lit("general"), F.lit("one;two|one")).alias("m")).select("doc_id", "m.*")


@query("name_hashes", "SELECT page_id, substr(sha1(url), 1, 8) AS sha1_8, substr(md5(url), 1, 8) AS md5_8, substr(sha256(url), 1, 12) AS sha256_12 FROM pages")
def name_hashes(spark, d):
    u = F.col("url")
    return pages(spark, d).select("page_id", T.short_hash(u).alias("sha1_8"), T.short_hash(u, "md5").alias("md5_8"), T.short_hash(u, "sha256", 12).alias("sha256_12"))


@query("slugs", "SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM pages")
def slugs(spark, d):
    return pages(spark, d).select("page_id", T.slug(F.col("url")).alias("slug"))


@query("collapsed_space", r"SELECT doc_id, trim(regexp_replace(replace(text, ' ', '  ' || chr(9)), '\s+', ' ', 'g')) AS text FROM documents")
def collapsed_space(spark, d):
    return docs(spark, d).select("doc_id", T.collapse_space(F.replace("text", F.lit(" "), F.lit("  \t"))).alias("text"))


@query("human_sizes", """WITH n AS (SELECT doc_id, n_chars * CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 100000000 END AS n FROM documents)
SELECT doc_id, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN round(n / 1024.0, 1) || ' KB' WHEN n < 1073741824 THEN round(n / 1048576.0, 1) || ' MB' ELSE round(n / 1073741824.0, 1) || ' GB' END AS size FROM n""")  # fmt: skip
def human_sizes(spark, d):
    """The documents' sizes, three of four scaled up so that every unit occurs."""
    scale = F.element_at(F.array(*(F.lit(x).cast("long") for x in (1, 1000, 1_000_000, 100_000_000))), (F.col("doc_id") % 4 + 1).cast("int"))
    return docs(spark, d).select("doc_id", T.human_size(F.col("n_chars") * scale).alias("size"))


@query("safe_ints", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS INTEGER) ELSE -1 END AS n FROM documents")
def safe_ints(spark, d):
    return docs(spark, d).select("doc_id", F.coalesce(T.safe_int(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), F.col("doc_id").cast("string"))).otherwise("n/a")), F.lit(-1)).alias("n"))


@query("chunk_kinds", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'example' WHEN 1 THEN 'table' ELSE 'heading' END AS kind FROM documents")
def chunk_kinds(spark, d):
    content = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("  \n```py\n"), "text")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("Table: x\n"), "text")).otherwise(F.concat(F.lit("x"), "text"))
    return docs(spark, d).select("doc_id", T.chunk_kind(content).alias("kind"))


@query("dated_names", "SELECT event_id, 'prov_' || strftime(ts, '%m_%d_%y') AS name, strftime(ts, '%m-%d %H:%M') AS stamp FROM events")
def dated_names(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", F.concat(F.lit("prov_"), F.date_format("ts", "MM_dd_yy")).alias("name"), F.date_format("ts", "MM-dd HH:mm").alias("stamp"))


@query("json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '[\"' || event_type || '\",\"' || user_id || '\"]' AS examples FROM events")
def json_fields(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"), F.to_json(F.array("event_type", F.col("user_id").cast("string"))).alias("examples"))


# --- dictionaries

CAPITALS = r"[A-Z][a-z]+"


@query("codename_frequency", f"SELECT w AS codename, count(*) AS count, 'identifier' AS type FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '{CAPITALS}'))) AS w FROM documents) GROUP BY 1")
def codename_frequency(spark, d):
    return codenames.document_frequency(docs(spark, d), F.regexp_extract_all("text", F.lit(CAPITALS), 0), "doc_id")


@query("codename_types", """WITH n AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'FV_K' || doc_id WHEN 1 THEN 'FP_P' || doc_id WHEN 2 THEN 'F_ApiGetId' WHEN 3 THEN 'F_TextLocT' WHEN 4 THEN 'KBD_F' || doc_id WHEN 5 THEN 'FTI_X' || doc_id ELSE 'BigNameXy' END AS c FROM documents),
f AS (SELECT c, CASE WHEN starts_with(c, 'FV_') THEN 'value' WHEN starts_with(c, 'FP_') THEN 'property' WHEN starts_with(c, 'F_Api') THEN 'function' WHEN c = 'F_TextLocT' THEN 'struct' WHEN starts_with(c, 'KBD_') THEN 'keyboard' WHEN starts_with(c, 'FTI_') THEN 'text_item' ELSE 'identifier' END AS type FROM n GROUP BY c)
SELECT coalesce(type, 'TOTAL') AS type, count(*) AS n FROM f GROUP BY ROLLUP (type)""")  # fmt: skip
def codename_types(spark, d):
    i, r = F.col("doc_id").cast("string"), F.col("doc_id") % 7
    name = F.when(r == 0, F.concat(F.lit("Constants.FV_K"), i)).when(r == 1, F.concat(F.lit("FP_P"), i)).when(r == 2, "F_ApiGetId").when(r == 3, "F_TextLocT").when(r == 4, F.concat(F.lit("FCodes.KBD_F"), i)).when(r == 5, F.concat(F.lit("FTI_X"), i)).otherwise("BigNameXy")
    text = docs(spark, d).select("doc_id", F.concat(F.lit("see "), name, F.lit(" here")).alias("t"))
    names = F.concat(codenames.prefixed_names(F.col("t")), codenames.camel_names(F.col("t")))
    return codenames.type_counts(codenames.document_frequency(text, names, "doc_id"))


_TERMS = codenames.alternation([*DICTIONARY])
_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in DICTIONARY.items()) + "}"


@query("dictionary_enrich", f"""WITH h AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '{_TERMS}')) AS terms FROM documents)
SELECT doc_id, CASE WHEN len(terms) > 0 THEN array_to_string(list_sort(list_distinct(list_transform(terms, lambda t: {_MAP}[t]))), '; ') END AS names FROM h""")  # fmt: skip
def dictionary_enrich(spark, d):
    return codenames.enrich(docs(spark, d), DICTIONARY, "doc_id")


@query("excluded_codenames", f"""WITH n AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{CAPITALS}')) AS codename FROM documents)
SELECT codename FROM n WHERE len(codename) >= 5 AND codename NOT IN ('Theronment', 'Ereaing') AND NOT (starts_with('Theronment', codename)) AND NOT (starts_with('Ereaing', codename))""")  # fmt: skip
def excluded_codenames(spark, d):
    names = docs(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit(CAPITALS), 0)).alias("codename")).distinct()
    return filters.excluded_codenames(names, ["Theronment", "Ereaing"])


@query("long_expansions", "SELECT doc_id, source AS friendlyname FROM documents WHERE len(trim(source)) >= 5")
def long_expansions(spark, d):
    return filters.long_expansions(docs(spark, d).select("doc_id", F.col("source").alias("friendlyname")), least=5)


@query("friendly_names", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'table title ' || source WHEN 1 THEN 'first paragraph in ' || source WHEN 2 THEN 'get id' WHEN 3 THEN 'text location' ELSE 'footnote ' || source END AS name FROM documents")
def friendly_names(spark, d):
    up, kind = F.upper("source"), F.col("doc_id") % 5
    code = F.when(kind == 0, F.concat(F.lit("Constants.FV_TBL_TITLE_"), up)).when(kind == 1, F.concat(F.lit("FP_FirstPgfIn"), F.initcap("source"))).when(kind == 2, "F_ApiGetId").when(kind == 3, "F_TextLocT").otherwise(F.concat(F.lit("FCodes.KBD_FOOTNOTE_"), up))
    return docs(spark, d).select("doc_id", codenames.friendly(code, {"Tbl": "table", "Pgf": "paragraph", "Loc": "location"}).alias("name"))


@query("like_search", "SELECT doc_id, source FROM documents WHERE text LIKE '%tion%'")
def like_search(spark, d):
    return docs(spark, d).where(F.col("text").like("%tion%")).select("doc_id", "source")


@query("sample_head", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 50")
def sample_head(spark, d):
    return filters.head_sample(docs(spark, d).select("doc_id", "lang"), 50, "doc_id")


@query("sample_random", "SELECT doc_id, lang FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 50")
def sample_random(spark, d):
    return filters.hash_sample(docs(spark, d).select("doc_id", "lang"), 50, "doc_id")


@query("row_count", "SELECT count(*) AS n FROM documents")
def row_count(spark, d):
    return docs(spark, d).agg(F.count("*").alias("n"))


@query("token_totals", "SELECT source, count(*) AS n_docs, CAST(sum(len(regexp_extract_all(text, '\\S+'))) AS BIGINT) AS total_tokens, count(*) FILTER (len(regexp_extract_all(text, '\\S+')) >= 200) AS n_long FROM documents GROUP BY source")
def token_totals(spark, d):
    counted = docs(spark, d).select("source", T.token_count(F.col("text")).alias("k"))
    return counted.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("k").alias("total_tokens"), F.count_if(F.col("k") >= 200).alias("n_long"))


@query("conversation_turns", "SELECT conv_id, count(*) AS n_turns, string_agg(role, ' > ' ORDER BY turn, role) AS roles FROM conversations GROUP BY conv_id")
def conversation_turns(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    return c.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), " > ").alias("roles"))


@query("pages_markdown")
def pages_markdown(spark, d):
    return crawl.as_markdown(pages(spark, d)).select("page_id", "markdown")


@query("page_links", """WITH p AS (SELECT url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1) AS scheme, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, html FROM pages),
f AS (SELECT *, CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS folder FROM p)
SELECT DISTINCT url, host || replace(trim(h), '&amp;', '&') AS target FROM (SELECT url, host, unnest(regexp_extract_all(html, '<a\\b[^>]*\\bhref\\s*=\\s*[\"'']([^\"''#]+)', 1)) AS h FROM f)
UNION SELECT url, host || folder || 'next.html?a=1&b=2' FROM f UNION SELECT url, scheme || '//cdn.example.org/x' FROM f UNION SELECT url, host || path || '?page=2' FROM f
UNION SELECT url, 'http://other.example.org/' FROM f UNION SELECT url, host || regexp_replace(folder, '[^/]+/$', '') || 'up/y' FROM f""")  # fmt: skip
def page_links(spark, d):
    """The pages' links, and on each page one of every other form."""
    more = '<a href="next.html?a=1&amp;b=2"><a href="//cdn.example.org/x"><a href="?page=2"><a href="http://other.example.org/"><a href="./../up/./y"><a href="mailto:a@b.example"><a href="javascript:go()">'
    return crawl.links(pages(spark, d).withColumn("html", F.concat("html", F.lit(more))))
