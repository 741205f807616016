"""From raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and works
on all rows that the stage before it kept. All but the last return the columns
of ``documents``, further ones included. An empty table gives an empty result at
every stage, and texts of any length are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.llm import mixing, packing, pii, quality, simhash
from docquarry.llm.common import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the learned decision list go.

    A null text, and one of fewer than 20 words, fails; without labels only the
    base rules hold; rows without a doc_id and repeated rows are judged each.
    """
    return quality.keep_good(docs, quality.learn_rules(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest doc_id stays, and of equal ids the text of the smallest hash.

    Texts without words are copies of each other; a row repeated as a whole stays
    once; rows of one doc_id with unlike texts all stay, and so do rows without one.
    """
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars, where there is one, follows the text.

    Null and empty texts stay as they are; every row stays.
    """
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources have their target weights, and shuffled globally.

    A null source is one of the others; rows without a doc_id are told apart by
    source and text; a source without rows is not made up for.
    """
    return mixing.mix(docs).select(*(f"`{c}`" for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, packed from pieces of the documents.

    A null or empty text is the end-of-text id alone; repeated rows are packed each.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The learned rules, the fingerprints' components and the tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
