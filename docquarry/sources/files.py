"""Readers and writers of the document engine's files: markdown trees, chunk JSON, sidecars, dictionaries, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions import text as X
from docquarry.operators.vector_table import valid_embeddings, with_missing_vectors

CHUNK = (
    "id string, filename string, parent_id string, id_prev string, id_next string, heading string, header_level int, concat_header_path string, chunk_type string, content string, "
    "code_friendly_name string, examples array<string>, chunk_summary string, page_summary string, code_summary string, title string, author string, category string, description string, "
    "language string, token_count int, embed boolean, embedding array<float>, embedding_summary_chunk array<float>, embedding_summary_page array<float>, prov_id string"
)
PROVENANCE = (
    "prov_id string, timestamp timestamp, chunk struct<model:string,chunk_size_range:string,keyword_density:double>, "
    "summary struct<model:string,prompt:string,size:int,temperature:double>, embed struct<model:string,vectorsize:int>"
)
RULES = "pattern string, replacement string, flags string, priority int, comment string"
CODENAMES = "count int, type string, codename string, friendlyname string, review string"
TOC = "level int, title string, page int"


def relative_name(root: str):
    """The path below ``root`` with forward slashes, without a scheme."""
    base = root.split("://")[-1].removeprefix("file:").rstrip("/")
    return F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:(//[^/]*)?", ""), f"^/*{base.lstrip('/')}/", "")


def read_markdown(spark: SparkSession, root: str, pattern: str = "*.md") -> DataFrame:
    """(filename, text) of every file below ``root``; unreadable files are left out."""
    files = spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    return files.select(relative_name(root).alias("filename"), F.col("value").alias("text"))


def read_any_markdown(spark: SparkSession, root: str) -> DataFrame:
    """All markdown extensions, each file once."""
    return read_markdown(spark, root, "*.{md,markdown,mdx}").distinct()


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array or JSON lines of chunks, by the fixed schema; nothing is inferred."""
    return spark.read.schema(CHUNK).json(path, multiLine=path.endswith(".json"))


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Embedding vectors by id; vector columns that are missing are null; id and embedding must be there."""
    rows = spark.read.parquet(path)
    missing = {"id", "embedding"} - {*rows.columns}
    if missing:
        raise ValueError(f"the sidecar lacks {sorted(missing)}")
    return with_missing_vectors(rows)


def read_codenames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CODENAMES).csv(path, header=True)


MOST_RULES = 10_000


def read_rules(spark: SparkSession, path: str):
    """Rewrite rules in order. The file is a user's list, so it is read to the driver."""
    from docquarry.operators.cleaning import Rule

    rows = spark.read.schema(RULES).csv(path, header=True, escape='"').limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    flag = {"I": "i", "M": "m", "S": "s"}
    return [Rule("".join(f"(?{flag[c]})" for c in (r["flags"] or "").upper() if c in flag) + r["pattern"], r["replacement"] or "", 100 if r["priority"] is None else r["priority"]) for r in rows if r["pattern"]]


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    from docquarry.operators.filters import listed_urls

    return listed_urls(spark.read.text(path))


def read_toc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOC).json(path, multiLine=True)


def read_provenance(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(PROVENANCE).json(path, multiLine=True)
    if rows.isEmpty():
        raise ValueError("no provenance")
    return rows


def write_provenance(spark: SparkSession, provenance: dict, path: str) -> None:
    """The one provenance of a run, as a dataset of one JSON line. What was there is replaced only once the new one is written."""
    import json

    spark.createDataFrame([(json.dumps(provenance, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def update_provenance(spark: SparkSession, path: str, stage: str, fields: dict, target: str, required: bool = False) -> dict:
    """The provenance under ``path`` with what a stage adds, written to ``target``; without one there it starts anew, or is an error if ``required``."""
    import json

    try:
        lines = [r.value for r in spark.read.text(path).limit(2).collect()]
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        lines = []
    if not lines and required:
        raise FileNotFoundError(path)
    held = json.loads(lines[0]) if lines else {}
    held[stage] = held.get(stage, {}) | fields
    write_provenance(spark, held, target)
    return held


def persist_embeddings(chunks: DataFrame, root: str, dim: int, sidecar: bool = True, inline: bool = False) -> int:
    """How many vectors were written. Chunks go to ``root``/chunks, without vectors unless ``inline`` or there is no sidecar; vectors to ``root``/vectors.

    If there were vectors and none was written, that is an error.
    """
    made = chunks.where(F.col("embedding").isNotNull()).count()
    spark, kept = chunks.sparkSession, 0
    with_vectors = inline or not sidecar
    (chunks if with_vectors else chunks.drop("embedding", "embedding_summary_chunk", "embedding_summary_page")).write.json(f"{root}/chunks")
    if with_vectors:
        kept = made
    if sidecar:
        write_sidecar(chunks, f"{root}/vectors", dim)
        kept = max(kept, spark.read.parquet(f"{root}/vectors").count())
    if made and not kept:
        raise ValueError(f"{made} vectors were made and none was written")
    return kept


def write_chunks(chunks: DataFrame, path: str, json: bool = False) -> None:
    """Chunks as Parquet, or as JSON lines without their vectors."""
    if json:
        chunks.drop("embedding", "embedding_summary_chunk", "embedding_summary_page").write.json(path)
    else:
        chunks.write.parquet(path)


def write_sidecar(chunks: DataFrame, path: str, dim: int) -> None:
    """Vectors of chunks with an id and a vector of ``dim`` numbers, zstd-compressed; summary vectors may be null."""
    rows = valid_embeddings(with_missing_vectors(chunks), dim)
    rows.select("id", "embedding", "embedding_summary_chunk", "embedding_summary_page").write.option("compression", "zstd").parquet(path)


def write_token_report(chunks: DataFrame, path: str) -> None:
    chunks.select("header_level", "heading", "token_count").write.csv(path, header=True)


def write_codenames(names: DataFrame, path: str) -> None:
    """One sorted file: by type, then the most frequent, then the name. Dictionaries are small."""
    names.select("count", "type", "codename", "friendlyname", "review").orderBy("type", F.desc("count"), "codename").coalesce(1).write.csv(path, header=True)


def write_token_tree(sections: DataFrame, path: str) -> None:
    """The token report as lines, of each file in its order; files stay whole."""
    tree = sections.select("filename", "ord", X.tree_line(F.col("level"), F.col("heading"), F.col("token_count")).alias("value"))
    tree.repartitionByRange("filename").sortWithinPartitions("filename", "ord").select("value").write.text(path)


def write_duplicates(duplicates: DataFrame, path: str) -> None:
    """Headings that are there more than once, by their parents' path, level and heading."""
    line = F.format_string("%s | %s | H%d %s | %d times, lines %s", "filename", "parent_path", "level", "heading", "n", "lines")
    duplicates.orderBy("parent_path", "level", "heading", "filename").select(line.alias("value")).write.text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select(F.col(lines.columns[0]).alias("value")).write.text(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Pages as (filename, text) with their front matter and a forced H1; one row stands for one file."""
    from docquarry.operators.filters import page_files

    pages = pages.groupBy(X.without_fragment(F.col("url")).alias("url")).agg(F.min("page_id").alias("page_id"), F.min_by(F.struct("html", "markdown"), "page_id").alias("_p")).select("url", "page_id", "_p.html", "_p.markdown")
    names = page_files(pages)
    title = X.html_title(F.col("html"))
    head = X.front_matter({"title": title, "source": F.col("url")})
    rows = pages.join(names.select("url", "filename"), "url")
    rows.select("filename", F.concat(head, F.lit("\n"), X.force_h1(F.col("markdown"), title)).alias("text")).write.parquet(path)


def write_tree(files: DataFrame, path: str, prefix: str = "") -> None:
    """Files under their folder below ``prefix``, one partition for each folder."""
    import re

    name = F.regexp_replace("filename", f"^{re.escape(prefix)}/?", "")
    folder = F.regexp_extract(name, "^(.*)/", 1)
    files.select(F.when(folder == "", ".").otherwise(folder).alias("folder"), F.regexp_extract(name, "([^/]*)$", 1).alias("filename"), "text").write.partitionBy("folder").parquet(path)


def write_rewritten(files: DataFrame, path: str) -> None:
    """Cleaned files as a new dataset with LF line ends; the input is never overwritten."""
    files.withColumn("text", F.regexp_replace("text", "\r\n?", "\n")).write.parquet(path)


def write_version(chunks: DataFrame, root: str, version: str) -> str:
    """A new version beside the old ones, which stay as backups."""
    path = f"{root.rstrip('/')}/version={version}"
    chunks.write.parquet(path)
    return path
