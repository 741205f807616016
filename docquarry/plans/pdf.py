"""From PDF files to chunks: trimmed, converted, headed by their contents, their code formatted, cut. Each step can be switched off."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators import cleaning, filters, headings, tables, toc
from docquarry.plans.config import PdfConfig
from docquarry.sources import documents


def kept_pages(spark: SparkSession, pages: DataFrame, config: PdfConfig = PdfConfig()) -> DataFrame:
    """Pages (page, from 0) without the front, the back and the ranges that the settings leave out."""
    ranges = spark.createDataFrame(list(config.skip_ranges), "first long, last long")
    return filters.kept_pages(pages, config.skip_front, config.skip_back, ranges)


def structured(files: DataFrame, contents: DataFrame | None = None, config: PdfConfig = PdfConfig()) -> DataFrame:
    """Converted files (filename, text) with headings as their contents (filename, pos, level, title) say, and with formatted code."""
    if config.fix_headings and contents is not None:
        ours, entries = files.withColumnRenamed("filename", "doc_id"), contents.withColumnRenamed("filename", "doc_id")
        files = toc.align(ours, entries, config.title_cutoff, key="string").select(F.col("doc_id").alias("filename"), "text")
    if config.fix_code:
        files = tables.rewritten(files, cleaning.format_fences)
    return files


def chunks(spark: SparkSession, root: str, convert: documents.Converter, config: PdfConfig = PdfConfig(), outline: documents.Outline = documents.plain_outline) -> DataFrame:
    """The chunks of every PDF under ``root``; the contents are its own bookmarks. A file that can't be converted gives none."""
    files = documents.converted(spark, root, convert).where(F.col("text").isNotNull())
    made = structured(files, documents.bookmarks(spark, root, outline) if config.fix_headings else None, config)
    return headings.chunks(made.withColumn("doc_id", F.xxhash64("filename")))
