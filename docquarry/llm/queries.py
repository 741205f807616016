"""Queries of this subpackage, one for each operator, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docquarry.llm import ann, langid, licenses, mixing, packing, pii, quality, simhash, token_counts, toxicity
from docquarry.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text by the library's rules. Null and empty texts have 0; null doc_ids and repeated rows give a row each; an empty table gives none; further columns are ignored."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every row whose vec_id is divisible by 50, by cosine.

    Vectors null, empty, zero, with null or non-finite components, or not of the
    table's most common dimension take no part; ties go to the smaller vec_id; rows
    of one query id are one query, that of its least vector; with fewer candidates
    all are returned; an empty table gives an empty result.
    """
    return ann.search(table(spark, sf_dir, "embeddings"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and packed into sequences of at most 1024 tokens. A null or empty text is the end id alone; null doc_ids and repeated rows are packed each; an empty table gives an empty result."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: base counts and digest, and all spans with the disguised ones. A null or empty text has none; null doc_ids and repeated rows give a row each; an empty table gives none."""
    return pii.find(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document repeated or left out so that sources have their weights, shuffled globally. A null source is one of the others; rows without a doc_id are told apart by source and text; an empty table gives an empty result; copy_number is replaced if it is there."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict for every whole text. A null or text without words has none and fails; without labels only the base rules hold; null doc_ids and repeated rows give a row each; an empty table gives none."""
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn_rules(docs, table(spark, sf_dir, "labels")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row. Texts without words have fingerprint zero and are linked like any other; null doc_ids are passed on and name a component only if it has no other; repeated rows are linked; an empty table gives an empty result."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every whole text and the known notices in its lines. Null, empty and wordless texts have none; null doc_ids and repeated rows give a row each; an empty table gives none."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and posterior of every whole text. Null and letterless texts, and all where no language was learned, are und with score 0; ties go to the language that sorts first; null doc_ids are not held out; repeated rows give a row each; an empty table gives none."""
    return langid.identify(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every whole text. Null and empty texts have the score of one without hits; without labels of both kinds every row has the base rate; null doc_ids are not held out; repeated rows give a row each; an empty table gives none."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_nearest_neighbours": op2_nearest_neighbours,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_pii": op4_pii,
        "op5_mix_sources": op5_mix_sources,
        "op6_quality_rules": op6_quality_rules,
        "op7_simhash": op7_simhash,
        "op8_license_scan": op8_license_scan,
        "op9_language_id": op9_language_id,
        "op10_toxicity": op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_mix_sources": mixing.oracle(), "op8_license_scan": licenses.oracle()}
