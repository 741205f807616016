"""The whole flow from markdown files to the keyed vector table, as one plan per stage boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.operators import cleaning, codenames, summaries, tables
from docquarry.operators import vector_table as VT
from docquarry.plans.config import RunMetadata, Settings


def build(files: DataFrame, meta: RunMetadata, settings: Settings = Settings(), dictionary: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, filename, text) to chunks: cleaned, cut by heading, peeled to size, enriched, summarised, stamped."""
    rows = tables.peel(cleaning.clean(files), settings.chunk.max_tokens)
    if dictionary:
        names = codenames.enrich(rows.select("id", F.col("content").alias("text")), dictionary, "id").withColumnRenamed("names", "code_friendly_name")
        rows = rows.join(names, "id", "left")
    else:
        rows = rows.withColumn("code_friendly_name", F.lit(None).cast("string"))
    rows = rows.withColumns({"chunk_summary": F.lit(None).cast("string"), "page_summary": F.lit(None).cast("string")})
    if settings.summary.code_summaries:
        rows = summaries.code_summaries(rows, settings.summary.backend)
    rows = summaries.summarise(rows, settings.summary.backend, settings.summary.min_tokens)
    if settings.summary.page_summaries:
        rows = summaries.page_summaries(rows, settings.summary.backend)
    rows = summaries.small_chunk_prefix(rows, settings.summary.small_below, settings.summary.prefix_path, settings.summary.prefix_page, settings.summary.prefix_chunk)
    prov = VT.provenance_id([F.lit(str(v)) for v in settings.flat().values()])
    stamp = {k: F.lit(getattr(meta, k)) for k in ("title", "author", "category", "description")}
    return rows.withColumns(stamp | {"prov_id": prov})


def embed(chunks: DataFrame, settings: Settings = Settings(), encoder: summaries.Encoder = summaries.hashed_ngrams) -> DataFrame:
    """Chunks to embed with their vectors; equal texts are encoded once."""
    text = summaries.embedding_text(F.col("concat_header_path"), F.col("content"), F.col("code_friendly_name"))
    rows = chunks.where(F.coalesce(F.col("embed"), F.lit(True))).withColumn("_text", text)
    made = VT.distinct_encoded(rows, "_text", lambda t: summaries.encode(t, encoder, settings.embed.batch), "embedding").drop("_text")
    made = scratch.materialize(made, "embedded")  # the model runs once
    VT.checked_dimension(VT.require_vectors(made), settings.embed.dim, settings.embed.fail_on_dim)
    return made
